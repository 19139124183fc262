"""One query for each operator, with production parameters, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from . import (
    filter_audit, hilbert, merkle, mixing, packing, quality, secrets, simhash, spelling, token_counts, transcripts,
    url_lists, warc,
)
from .common import ranked


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Where a public vocabulary lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc_members(spark, sf):
    mono, members = shared_dir(spark, "warc-mono"), shared_dir(spark, "warc")
    warc.write_monolithic(warc.revisits(table(spark, sf, "pages")), mono)
    warc.normalise(spark, mono, members)
    read = warc.read_records(spark, members)
    number = lambda c: F.regexp_extract(c, f"<{warc.ID_PREFIX}(-?[0-9]+)>", 1).try_cast("long")
    response = F.col("record_type") == "response"
    return read.select(
        number("record_id").alias("page_id"),
        F.when(response, F.octet_length("payload").cast("long")).otherwise(F.col("payload_length")).alias("payload_bytes"),
        F.when(response, F.sha1("payload")).otherwise(F.regexp_replace("payload_digest", "^sha1:", "")).alias("payload_digest"),
        "record_type",
        F.when(~response, number("refers_to")).alias("refers_to"),
    )


def op2_simhash_pigeonring(spark, sf):
    return simhash.near_duplicates(table(spark, sf, "documents"), shingle=3, k=2)


def op3_merkle_fingerprints(spark, sf):
    return merkle.next_edits(table(spark, sf, "documents"))


LIST_START = 1_704_067_200
LIST_DAYS = 30


def captures(spark, sf):
    """Pages with a fetch time: spread over the 30 days of ``events`` by a multiple of the page_id."""
    seconds = F.lit(LIST_START) + F.pmod(F.col("page_id") * 7919, F.lit(LIST_DAYS * 86_400))
    return table(spark, sf, "pages").select("page_id", "url", (seconds * 1_000_000).alias("fetched_at"))


def list_changes(spark, sf):
    """Dated entries: every event lists or delists the host, domain or first path of a page, event after event
    going round all pages in the order of their numbers."""
    pages, n = ranked(table(spark, sf, "pages").select("page_id", "url"), ["page_id"], "page-numbers")
    events = table(spark, sf, "events").select("event_id", "ts", "event_type", "user_id")
    rows = events.join(pages, F.pmod(events["event_id"], F.lit(max(n, 1))) == pages["rank"])
    host, first = url_lists.host_of("url"), F.regexp_extract(F.regexp_extract("url", url_lists.PATH, 1), "^/([^/]+)", 1)
    parent = F.regexp_extract(host, r"([^.]+\.[^.]+\.[^.]+)$", 1)
    kind = F.pmod("user_id", F.lit(3))
    key = (
        F.when(kind == 0, F.concat(F.lit("h:"), host))
        .when(kind == 1, F.concat(F.lit("d:"), F.when(parent == "", host).otherwise(parent)))
        .otherwise(F.concat(F.lit("p:"), host, F.lit("/"), first))
    )
    return rows.select(
        key.alias("key"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("at"),
        F.col("event_type").isin("click", "error", "purchase").alias("active"),
    )


def op4_url_list_asof(spark, sf):
    return url_lists.judge(captures(spark, sf), list_changes(spark, sf)).drop("url")


def op5_hilbert_shards(spark, sf):
    return hilbert.shards(table(spark, sf, "documents"), 8).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )


def op6_transcript_roles(spark, sf):
    turns = transcripts.raw_turns(table(spark, sf, "conversations"))
    model = transcripts.fit(turns)
    return transcripts.parse(turns.select("conv_id", F.col("turn").alias("part"), "text"), model)


def op7_secret_trigrams(spark, sf):
    return secrets.scan(table(spark, sf, "documents"))


def op8_quality_ngrams(spark, sf):
    docs = table(spark, sf, "documents")
    return quality.verdicts(docs, quality.fit(docs, table(spark, sf, "labels")))


def op9_poisson_mixing(spark, sf):
    rows = mixing.replicate(table(spark, sf, "documents"), keep=("doc_id", "source"))
    return rows.select("doc_id", "source", F.round("rate", 6).alias("rate"), "copies", "copy", "shuffle_key")


def op10_drr_packing(spark, sf):
    return packing.pack(table(spark, sf, "documents"), vocabulary()).drop("ids")


def op11_spelling_tiles(spark, sf):
    return spelling.variants(table(spark, sf, "documents"))


def op12_filter_audit(spark, sf):
    return filter_audit.audit(filter_audit.outcomes(table(spark, sf, "documents"), table(spark, sf, "labels")))


def op13_token_counts(spark, sf):
    return token_counts.token_counts(table(spark, sf, "documents"), vocabulary("piece_bpe_32k.model"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_warc_members, op2_simhash_pigeonring, op3_merkle_fingerprints, op4_url_list_asof, op5_hilbert_shards,
        op6_transcript_roles, op7_secret_trigrams, op8_quality_ngrams, op9_poisson_mixing, op10_drr_packing,
        op11_spelling_tiles, op12_filter_audit, op13_token_counts,
    )
}
