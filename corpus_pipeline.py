"""Documents to packed sequences in five stages, each written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from beforehand.llm import mixing, packing, quality, secrets, simhash
from beforehand.llm.queries import vocabulary
from beforehand.session import discard, scratch, shared_dir


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fixed rules and the model keep."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.kept(docs, quality.fit(docs, labels))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least doc_id of each group of near copies."""
    return simhash.one_of_each(docs, shingle=3, k=2)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated as their source's rate asks, and each copy's place in one global shuffle."""
    return mixing.replicate(docs).drop("rate", "copies")


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids in which every window holds the sources as the whole corpus does, each source as the
    shuffle left it, and the pieces of documents and copies that each sequence is made of."""
    pieces = packing.pack(docs, vocabulary(), order=None, with_ids=True, carry=("copy",))
    return packing.sequences(pieces, carry=("copy",))


STAGES = [
    ("quality rules", keep_quality),
    ("simhash near-dedup", drop_near_copies),
    ("secret scans", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

# The first stage applies a trained model, which SQL cannot express; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage writes on its way goes when it is done, its rows when the next one is."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = shared_dir(spark, name.replace(" ", "-"))
        with scratch(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        if last:
            discard(spark, last)
        docs, last = spark.read.schema(out.schema).parquet(path), path
    return docs
