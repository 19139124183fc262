"""Time the headline queries: one warm-up, then the median of three, in one session.

Every query is written to the ``noop`` sink, so all of its columns are computed. The joins
and the last entry, a whole build from scan to written table, run over the events widened
to 22 times their number. ``naive`` holds plain forms timed for comparison only. Prints
one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beforehand.operators import evaluation, joins
from beforehand.operators.buckets import bucket_counts, rolling_buckets
from beforehand.operators.encoding import target_encoding_asof
from beforehand.operators.rolling import DAY, WEEK, Rolling, rolling
from beforehand.operators.skew import profile_keys
from beforehand.plans import features, queries
from beforehand.session import build_session, shared_dir
from beforehand.sources import standin, tables
from beforehand.sources.schemas import Timeline

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3
COPIES = 22
MERCHANT = [
    Rolling("merch_cnt_7d", "count", WEEK),
    Rolling("merch_ncards_24h", "distinct", DAY, "card_id"),
]


def cases(spark, wide_transactions: str, wide_merchants: str) -> dict:
    sf = SF_DIR
    txns, full = standin.transactions(spark, sf, country=False), standin.transactions(spark, sf)
    dim = tables.read_merchants(spark, wide_merchants).drop("mcc")
    many = tables.read_transactions(spark, wide_transactions).select("txn_id", "merchant_id", "amount")
    scored = evaluation.temporal_split(txns, "txn_time", standin.TIMELINE.ranges)

    def hourly() -> DataFrame:
        return rolling_buckets(bucket_counts(txns, "merchant_id", "txn_time", "card_id"), "merchant_id")

    return {
        "card_windows": lambda: features.card_history(full),
        "merchant_auto": lambda: rolling(txns, "merchant_id", "txn_time", MERCHANT),
        "merchant_sweep": lambda: rolling(txns, "merchant_id", "txn_time", MERCHANT, route="sweep"),
        "merchant_buckets": hourly,
        "encoding_row_asof": lambda: target_encoding_asof(
            txns, "merchant_id", "txn_time", "is_fraud", "label_confirmed_at"
        ),
        "join_sort_merge": lambda: joins.merge_join(many, dim, "merchant_id"),
        "join_salted": lambda: joins.salted_join(
            many, dim, "merchant_id", profile_keys(many, "merchant_id"), ["txn_id"], rows_per_salt=40_000
        ),
        "join_broadcast": lambda: joins.lookup_join(many, dim, "merchant_id", how="inner"),
        "asof_lookup": lambda: queries.asof_lookup(spark, sf),
        "metric_curve": lambda: evaluation.ranking_metrics(
            evaluation.score_curve(scored, "score", "is_fraud", ["split"]), ["split"]
        ),
        "cost_sweep": lambda: evaluation.best_threshold(
            evaluation.cost_curve(scored.where(F.col("split") == "test"), "score", "is_fraud", "amount")
        ),
        "feature_table": lambda: features.feature_table(full, standin.merchants(spark, sf), standin.TIMELINE),
    }


def widened(spark) -> tuple[str, str]:
    """The events repeated to 22 times their number: more cards, 22 merchants for each but the hot
    one, and 90 days instead of 30. Merchants are repeated alike, so every row finds its own.
    Written once, by day."""
    k = F.col("k")
    shift = F.expr("make_dt_interval(cast(k % 3 as int) * 30)")
    merchant = F.when(F.col("merchant_id") == 0, F.col("merchant_id")).otherwise(F.col("merchant_id") * COPIES + k)
    t = standin.transactions(spark, SF_DIR).drop("score", "txn_date")
    t = t.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1)))).withColumns(
        {
            "txn_id": F.col("txn_id") * COPIES + k,
            "card_id": F.col("card_id") * COPIES + k,
            "txn_time": F.col("txn_time") + shift,
            "label_confirmed_at": F.col("label_confirmed_at") + shift,
            "merchant_id": merchant,
        }
    )
    root = shared_dir(spark, "widened")
    tables.write_partitioned(tables.normalise(t.drop("k")), f"{root}/transactions")
    known = standin.merchants(spark, SF_DIR)
    own = known.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    own = own.where((F.col("merchant_id") != 0) | (F.col("k") == 0)).withColumn("merchant_id", merchant).drop("k")
    missing = t.where(F.col("merchant_id") == 0).select("merchant_id").distinct().join(known, "merchant_id", "left_anti")
    hot = missing.select([F.col(c) if c == "merchant_id" else F.lit(None).cast(own.schema[c].dataType).alias(c) for c in own.columns])
    own.unionByName(hot).write.parquet(f"{root}/merchants")
    return f"{root}/transactions", f"{root}/merchants"


def built(spark, transactions: str, merchants: str) -> tuple[float, int]:
    """Seconds and rows of a whole build, from scan to written and counted table."""
    start = time.perf_counter()
    line = Timeline(hist_end="2024-02-01", label_cutoff="2024-03-21")
    out = shared_dir(spark, "features")
    df = features.feature_table(
        tables.read_transactions(spark, transactions), tables.read_merchants(spark, merchants), line
    )
    tables.write_partitioned(df, out)
    rows = tables.read_features(spark, out).count()
    return time.perf_counter() - start, rows


def timed(build) -> float:
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def median(build) -> float:
    timed(build)
    return round(statistics.median(timed(build) for _ in range(RUNS)), 3)


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory="16g",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="64k",
        spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="bench-warehouse-"),
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    paths = widened(spark)
    took = {name: median(build) for name, build in cases(spark, *paths).items()}
    txns = standin.transactions(spark, SF_DIR, country=False)
    naive = {
        "merchant_row_window": median(
            lambda: rolling(txns, "merchant_id", "txn_time", MERCHANT, route="window")
        )
    }
    rows = standin.table(spark, SF_DIR, "events").count()
    built(spark, *paths)
    whole, whole_rows = built(spark, *paths)
    took["feature_build_widened"] = round(whole, 3)
    print(
        json.dumps(
            {
                "metric": "total of median query times",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "naive": naive,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
                "feature_rows": rows,
                "feature_rows_per_sec": round(rows / took["feature_table"]),
                "widened_rows": whole_rows,
                "widened_rows_per_sec": round(whole_rows / whole),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
