"""Logical tables and the time points of a build."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

TRANSACTIONS = T.StructType(
    [
        T.StructField("txn_id", T.StringType()),
        T.StructField("card_id", T.StringType()),
        T.StructField("txn_time", T.TimestampType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("mcc", T.LongType()),
        T.StructField("txn_country", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("declined", T.LongType()),
        T.StructField("is_fraud", T.LongType()),
        T.StructField("label_confirmed_at", T.TimestampType()),
    ]
)

MERCHANTS = T.StructType(
    [
        T.StructField("merchant_id", T.StringType()),
        T.StructField("merchant_country", T.StringType()),
        T.StructField("merchant_risk_tier", T.StringType()),
    ]
)

# The model's inputs.
MODEL_INPUTS = [
    "amount", "card_cnt_1h", "card_cnt_24h", "card_cnt_7d", "card_sum_24h", "card_sum_7d",
    "card_nmerch_24h", "card_ncountry_1h", "card_declines_10m", "amt_ratio_7d",
    "amt_over_card_sum_24h", "secs_since_last", "country_changed", "merch_cnt_7d",
    "merch_ncards_24h", "merchant_id_te", "mcc_te", "cross_border", "is_ecom",
    "risk_tier_num", "hour_of_day", "is_weekend",
]


@dataclass(frozen=True)
class Timeline:
    """The dates that drive a build. All ranges are half-open; labels count up to ``hist_end`` unless a cutoff is given."""

    hist_end: str | None = None
    label_cutoff: str | None = None
    train: tuple[str, str] | None = None
    valid: tuple[str, str] | None = None
    test: tuple[str, str] | None = None

    def __post_init__(self):
        if self.label_cutoff is None:
            object.__setattr__(self, "label_cutoff", self.hist_end)

    @property
    def ranges(self) -> dict[str, tuple[str, str]]:
        given = {"train": self.train, "valid": self.valid, "test": self.test}
        return {name: days for name, days in given.items() if days}


class SchemaError(ValueError):
    """A table lacks a column or holds it under another kind of type."""


def _kind(t: T.DataType) -> str:
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return "time"
    if isinstance(t, T.NumericType):
        return "number"
    return t.typeName()


def check_schema(df: DataFrame, expected: T.StructType, any_type: tuple[str, ...] = ()) -> DataFrame:
    """Return ``df`` if it has every expected column; extra columns are allowed.

    ``any_type`` names key columns that may be of any type.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    for f in expected.fields:
        if f.name not in have:
            raise SchemaError(f"missing column {f.name}")
        if f.name not in any_type and _kind(have[f.name]) != _kind(f.dataType):
            raise SchemaError(f"{f.name} is {have[f.name].simpleString()}, not {f.dataType.simpleString()}")
    return df
