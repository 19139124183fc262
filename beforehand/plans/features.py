"""The point-in-time feature table."""

from __future__ import annotations

import inspect
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    cross_border,
    epoch_seconds,
    flag_equals,
    in_range,
    ordinal,
    ratio_to_baseline,
    share_with_current,
    weekend_flag,
)
from ..operators.buckets import bucket_counts, join_buckets, rolling_buckets
from ..operators.encoding import apply_encoding, known_history, prior_rate, tally, target_encoding
from ..operators.joins import lookup_join
from ..operators.rolling import DAY, HOUR, MINUTE, WEEK, Rolling, rolling, since_last
from ..operators.skew import KeyProfile, profile_keys, profile_many
from ..sources.schemas import Timeline
from ..sources.tables import kept, prune_dates

ENCODED = ["merchant_id", "mcc"]
RISK_CODES = {"high": 2, "med": 1}


def card_specs(approximate: bool = False) -> list[Rolling]:
    distinct = "approx_distinct" if approximate else "distinct"
    return [
        Rolling("card_cnt_1h", "count", HOUR),
        Rolling("card_cnt_24h", "count", DAY),
        Rolling("card_cnt_7d", "count", WEEK),
        Rolling("card_sum_24h", "sum", DAY, "amount"),
        Rolling("card_sum_7d", "sum", WEEK, "amount"),
        Rolling("card_mean_7d", "mean", WEEK, "amount"),
        Rolling("card_nmerch_24h", distinct, DAY, "merchant_id"),
        Rolling("card_ncountry_1h", distinct, HOUR, "txn_country"),
        Rolling("card_declines_10m", "sum", 10 * MINUTE, "declined"),
    ]


def card_history(
    txns: DataFrame, profile: KeyProfile | None = None, approximate: bool = False, route: str = "auto"
) -> DataFrame:
    """Per-card counts, sums, velocity and time since the last transaction.

    Light and heavy cards part ways first, so all windows of the light ones share one
    shuffle, and ordering by (second, id) lets the rolling frames reuse the sort.
    """
    profile = profile or profile_keys(txns, "card_id", "txn_time")

    def windows(rows: DataFrame, route: str, profile: KeyProfile | None = None) -> DataFrame:
        seen = since_last(
            rows, "card_id", "_ts", "txn_id", changed={"txn_country": "country_changed"}, profile=profile
        )
        return rolling(seen, "card_id", "_ts", card_specs(approximate), route, profile)

    rows = txns.withColumn("_ts", epoch_seconds("txn_time"))
    # approximate counts have one meaning for all cards, so all take one route
    if route == "auto" and not profile.truncated and not approximate:
        light, heavy = profile.split(rows)
        df = windows(light, "window")
        if heavy is not None:
            df = df.unionByName(windows(heavy, "sweep", profile))
    else:
        df = windows(rows, "sweep" if route == "auto" else route, profile)
    return df.drop("_ts").withColumns(
        {
            "amt_ratio_7d": ratio_to_baseline("amount", "card_mean_7d"),
            "amt_over_card_sum_24h": share_with_current("amount", "card_sum_24h"),
        }
    )


def merchant_history(
    df: DataFrame, txns: DataFrame, profile: KeyProfile | None = None, distinct: str = "exact"
) -> DataFrame:
    """Per-merchant history over hourly buckets, counted from the raw rows."""
    buckets = bucket_counts(txns, "merchant_id", "txn_time", "card_id", distinct=distinct)
    rolled = rolling_buckets(
        buckets, "merchant_id", "merch_cnt_7d", "merch_ncards_24h", sketched=distinct == "sketch"
    )
    return join_buckets(df, rolled, "merchant_id", "txn_time", profile=profile, row_key=["txn_id"])


def context(df: DataFrame, merchants: DataFrame, profile: KeyProfile | None = None) -> DataFrame:
    """Merchant attributes and calendar flags."""
    dim = merchants.select("merchant_id", "merchant_country", "merchant_risk_tier")
    return lookup_join(df, dim, "merchant_id", profile=profile, row_key=["txn_id"]).withColumns(
        {
            "cross_border": cross_border("txn_country", "merchant_country"),
            "is_ecom": flag_equals("channel", "ecom"),
            "risk_tier_num": ordinal("merchant_risk_tier", RISK_CODES),
            "hour_of_day": F.hour("txn_time"),
            "is_weekend": weekend_flag("txn_time"),
        }
    ).drop("merchant_country", "merchant_risk_tier")


def history_tally(txns: DataFrame, timeline: Timeline) -> DataFrame:
    """Rows and known frauds per merchant and category of the history that encodings are made of."""
    history = known_history(
        txns, "txn_time", "is_fraud", "label_confirmed_at", timeline.hist_end, timeline.label_cutoff
    )
    return tally(history, ENCODED)


def encodings(
    df: DataFrame,
    txns: DataFrame,
    timeline: Timeline,
    profiles: dict[str, KeyProfile],
    prior: float | None = None,
    tallied: DataFrame | None = None,
    bounds: dict[str, int] | None = None,
) -> DataFrame:
    """Fraud rate per merchant and per category, from history known at the label cutoff.

    ``tallied`` is the tally of that history, where it is at hand; ``bounds`` are upper bounds on its
    keys, where the profiles don't cover it.
    """
    tallied = history_tally(txns, timeline) if tallied is None else tallied
    g = prior_rate(tallied) if prior is None else F.lit(float(prior))
    for key in ENCODED:
        # an encoding has at most one row per distinct key, which the profile counted
        known = profiles[key]
        keys = bounds[key] if bounds else known.keys
        df = apply_encoding(df, target_encoding(tallied, key, prior=g), key, g, keys, known, ["txn_id"])
    return df


def feature_table(
    txns: DataFrame,
    merchants: DataFrame,
    timeline: Timeline,
    approximate: bool = False,
    prior: float | None = None,
    profiles: dict[str, KeyProfile] | None = None,
) -> DataFrame:
    """All feature families joined to the transactions, one row per transaction.

    ``profiles`` of the card, merchant and category columns save the counting pass.
    """
    profiles = profiles or profile_many(txns, ["card_id", *ENCODED], "txn_time")
    sellers = profiles["merchant_id"]
    df = card_history(txns, profiles["card_id"], approximate)
    df = merchant_history(df, txns, sellers, "approx" if approximate else "exact")
    df = encodings(df, txns, timeline, profiles, prior)
    return context(df, merchants, sellers)


def lead_in_days() -> int:
    """Days the longest frame reaches back, and the one in which its first bucket may start."""
    merchant = inspect.signature(rolling_buckets).parameters
    frames = [s.seconds for s in card_specs()]
    frames += [merchant[name].default for name in ("count_seconds", "member_seconds")]
    return -(-max(frames) // DAY) + 1


def last_rows(txns: DataFrame) -> DataFrame:
    """A card's last transaction: all that the time since the last one looks at."""
    last = F.max_by(
        F.struct("txn_id", "txn_time", "txn_country"), F.struct(epoch_seconds("txn_time"), F.col("txn_id"))
    )
    return txns.groupBy("card_id").agg(last.alias("_t")).select("card_id", "_t.*")


def _before(txns: DataFrame, end: str) -> DataFrame:
    rows = txns.where(F.col("txn_time") < F.to_timestamp(F.lit(end)))
    return rows.where(F.col("txn_date") <= F.lit(end).cast("date")) if "txn_date" in txns.columns else rows


def feature_range(
    txns: DataFrame,
    merchants: DataFrame,
    timeline: Timeline,
    start: str,
    end: str,
    approximate: bool = False,
    prior: float | None = None,
    state: str | None = None,
) -> DataFrame:
    """Features of the days [start, end) alone, equal to those of a full build.

    Only ``lead_in_days()`` of rows before the range are read whole. Of everything older,
    one row per card, its last, is kept for the time since the last transaction. With a folder
    ``state`` those rows are carried from range to range: a range that begins where an earlier one
    ended reads its days and the lead-in only, and leaves the cards' last rows at its own end.
    The tallies of the history, the same for all ranges of a timeline, are kept there too. The
    first range, and one that begins where none ended, reads what is older. A range that is built again
    hands on anew what it finds; ranges after it are to be built again too if their first rows changed.
    """
    spark = txns.sparkSession
    lead = str(date.fromisoformat(start) - timedelta(days=lead_in_days()))
    near = prune_dates(txns, lead, end).where(in_range("txn_time", lead, end))
    if state is None:
        tails, tallied = last_rows(_before(txns, lead)), history_tally(txns, timeline)
        profiled = profile_many(txns, ENCODED)
        bounds = {key: profiled[key].keys for key in ENCODED}
    else:
        name = f"{timeline.hist_end}-{timeline.label_cutoff}".translate(str.maketrans(": ", "__"))
        tallied = kept(spark, f"{state}/tally-{name}", lambda: history_tally(txns, timeline))
        tails = kept(spark, f"{state}/last-{start}", lambda: last_rows(_before(txns, start)))
        seen = tallied.agg(*[F.count_distinct(key).alias(key) for key in ENCODED]).first()
        bounds = {key: seen[key] + 1 for key in ENCODED}
        own = near.where(in_range("txn_time", start, end)).select(*tails.columns)
        last_rows(tails.unionByName(own)).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
            f"{state}/last-{end}"
        )
        # those within the lead-in are read with it
        tails = _before(tails, lead)
    profiles = profile_many(near, ["card_id", *ENCODED], "txn_time")
    sellers = profiles["merchant_id"]
    df = card_history(near.unionByName(tails, allowMissingColumns=True), profiles["card_id"], approximate).where(in_range("txn_time", start, end))
    df = merchant_history(df, near, sellers, "approx" if approximate else "exact")
    df = encodings(df, txns, timeline, profiles, prior, tallied, bounds)
    return context(df, merchants, sellers)
