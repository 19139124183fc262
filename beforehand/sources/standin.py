"""Card transactions and merchants as a view over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import lookup_join
from .schemas import Timeline
from .tables import normalise

TIMELINE = Timeline(
    hist_end="2024-01-11",
    label_cutoff="2024-01-25",
    train=("2024-01-11", "2024-01-18"),
    valid=("2024-01-18", "2024-01-21"),
    test=("2024-01-25", "2024-01-31"),
)
EARLY_CUTOFF = "2024-01-21"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str, country: bool = True) -> DataFrame:
    """Events as card transactions. The country needs a customer lookup, so it is optional."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    e = table(spark, sf_dir, "events")
    if country:
        home = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_nationkey")
        e = lookup_join(e, home, "user_id", row_key=["event_id"])
    event_id = F.col("event_id")
    merchant = F.when(event_id % 4 == 0, F.lit(0).cast("long")).otherwise(
        F.regexp_extract("props", "[0-9]+", 0).cast("long")
    )
    e = e.withColumn("merchant_id", merchant)
    fraud = (event_id % 29 == 0) | (
        (F.col("event_type") == "error") & (F.col("merchant_id") % 7 == 3)
    )
    e = e.withColumn("is_fraud", F.when(fraud, 1).otherwise(0))
    away = (F.col("c_nationkey") + 1 + event_id % 24) % 25 if country else None
    score = ((event_id * 7919) % 1000 * 7 + F.col("is_fraud") * 3000).cast("double") / 10000
    confirmed = F.expr("ts + make_dt_interval(cast(1 + event_id % 9 as int))")
    return normalise(
        e.select(
            event_id.alias("txn_id"),
            F.col("user_id").alias("card_id"),
            F.col("ts").alias("txn_time"),
            F.col("value").alias("amount"),
            "merchant_id",
            (F.col("merchant_id") % 10).alias("mcc"),
            *([F.when(event_id % 33 == 0, away).otherwise(F.col("c_nationkey")).alias("txn_country")]
              if country else []),
            F.when(F.col("event_type").isin("click", "signup"), "ecom").otherwise("card_present").alias("channel"),
            F.when(F.col("event_type") == "error", 1).otherwise(0).alias("declined"),
            "is_fraud",
            F.when(F.col("is_fraud") == 1, confirmed).alias("label_confirmed_at"),
            score.alias("score"),
        )
    )


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        s.alias("merchant_id"),
        (s % 10).alias("mcc"),
        F.col("s_nationkey").alias("merchant_country"),
        F.when(s % 20 == 0, "high").when(s % 20 <= 3, "med").otherwise("low").alias("merchant_risk_tier"),
    )


def skewed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with a quarter of all rows moved onto one merchant."""
    hot = F.when(F.col("l_orderkey") % 4 == 0, F.lit(0).cast("long")).otherwise(F.col("l_suppkey"))
    return table(spark, sf_dir, "lineitem").withColumn("merchant_id", hot)
