"""Row-grain rolling state, exact distinct counters and the closing of a stream."""

import random
from datetime import timezone

import pytest
from pyspark.sql import functions as F

from beforehand.operators.buckets import bucket_counts
from beforehand.operators.rolling import DAY, HOUR, Rolling, rolling
from beforehand.streaming import counters
from beforehand.streaming.rolling import rolling_rows

from .helpers import TXN, frame, txn

SPECS = [
    Rolling("n_1h", "count", HOUR), Rolling("n_24h", "count", DAY), Rolling("sum_1h", "sum", HOUR, "amount"),
    Rolling("sum_24h", "sum", DAY, "amount"), Rolling("mean_24h", "mean", DAY, "amount"),
    Rolling("declines", "sum", 600, "declined"),
]
NAMES = [s.name for s in SPECS]


def write_batches(spark, path, *batches):
    for rows in batches:
        frame(spark, TXN, *rows).coalesce(1).write.mode("append").parquet(path)


def drained(spark, tmp_path, path, made, closed=True, files=1):
    files = counters.file_stream(spark, spark.read.parquet(path), path, files_per_batch=files)
    stream, close = counters.closing(files, "txn_time")
    df = made(stream)
    if closed:
        query = counters.run_closed(df, close, str(tmp_path / "o"), str(tmp_path / "c"))
    else:
        query = counters.run_available(df, str(tmp_path / "o"), str(tmp_path / "c"))
    return spark.read.parquet(str(tmp_path / "o")), query


def told(df):
    return sorted(map(tuple, df.select("txn_id", "card_id", *NAMES).collect()), key=str)


def shuffled_rows(n, late, seed=1):
    """Rows of some cards that arrive up to ``late`` seconds out of order; NULL cards and amounts, ties, a hot card."""
    rng = random.Random(seed)
    rows, at = [], 0.0
    for i in range(n):
        at += rng.choice([0, 0, 0.4, 30, 900, 4000])
        card = rng.choice(["hot", "hot", "hot", "a", "b", None])
        amount = rng.choice([0.1, 0.2, 1e9 + 0.37, 12.34, None, -5.0])
        rows.append((at + rng.uniform(0, late), txn(i, at, card=card, amount=amount, declined=int(i % 3 == 0))))
    return [r for _, r in sorted(rows, key=lambda x: x[0])]


@pytest.mark.parametrize("seed,batches", [(1, 1), (2, 4)])
def test_rows_of_a_stream_equal_the_batch(spark, tmp_path, seed, batches):
    path, rows = str(tmp_path / "in"), shuffled_rows(160, 3_000, seed)
    size = -(-len(rows) // batches)
    write_batches(spark, path, *(rows[i : i + size] for i in range(0, len(rows), size)))
    got, _ = drained(spark, tmp_path, path, lambda s: rolling_rows(s, "card_id", "txn_time", SPECS, ["txn_id"]))
    want = rolling(spark.read.parquet(path), "card_id", "txn_time", SPECS, route="window")
    assert told(got) == told(want)


def test_only_rows_behind_the_watermark_are_out(spark, tmp_path):
    path = str(tmp_path / "in")
    write_batches(spark, path, [txn(1, 0), txn(2, 100), txn(3, 90_000)], [txn(5, 90_500)], [txn(4, 5), txn(6, 95_000)])
    made = lambda s: rolling_rows(s, "card_id", "txn_time", SPECS, ["txn_id"])
    got, _ = drained(spark, tmp_path, path, made, closed=False)
    # row 4 came after rows up to 86,400 were given out: it is late; row 6 waits
    assert sorted(r.txn_id for r in got.collect()) == [1, 2, 3, 5]
    assert {r.txn_id: (r.n_24h, r.n_1h) for r in got.collect()} == {1: (0, 0), 2: (1, 1), 3: (0, 0), 5: (1, 1)}


def test_a_key_without_rows_in_reach_holds_no_state(spark, tmp_path):
    path = str(tmp_path / "in")
    write_batches(spark, path, [txn(1, 0, card="a"), txn(2, 50, card="a")], [txn(3, 200_000, card="b")], [txn(4, 400_000, card="c")])
    made = lambda s: rolling_rows(s, "card_id", "txn_time", SPECS, ["txn_id"])
    _, query = drained(spark, tmp_path, path, made)
    states = spark.read.format("statestore").option("stateVarName", "seconds").load(str(tmp_path / "c"))
    waiting = spark.read.format("statestore").option("stateVarName", "waiting").load(str(tmp_path / "c"))
    assert states.count() == 0 and waiting.count() == 0


def test_streams_keep_sums_only(spark, tmp_path):
    path = str(tmp_path / "in")
    write_batches(spark, path, [txn(1, 0)])
    stream = counters.file_stream(spark, spark.read.parquet(path), path)
    with pytest.raises(ValueError, match="counts, sums and means"):
        rolling_rows(stream, "card_id", "txn_time", [Rolling("x", "distinct", HOUR, "merchant_id")], ["txn_id"])


def test_closed_buckets_equal_batch_buckets(spark, tmp_path):
    """Rows and exact distinct members of all hours, the last included."""
    path = str(tmp_path / "in")
    rows = [txn(i, i * 700, merchant=f"m{i % 3}", card=None if i % 11 == 0 else f"c{i % 4}") for i in range(90)]
    write_batches(spark, path, rows[:30], rows[30:60], rows[60:])
    got, _ = drained(spark, tmp_path, path, lambda s: counters.bucket_stream(s, "merchant_id", "txn_time", member="card_id"))
    want = bucket_counts(spark.read.parquet(path), "merchant_id", "txn_time", "card_id")
    key = lambda df: sorted(map(tuple, df.select("merchant_id", "hr_ts", "n", "nc").collect()))
    assert key(got) == key(want) and got.agg(F.sum("n")).first()[0] == 90


def test_a_closed_stream_takes_no_more(spark, tmp_path):
    path = str(tmp_path / "in")
    write_batches(spark, path, [txn(i, i * 100) for i in range(10)])
    files = counters.file_stream(spark, spark.read.parquet(path), path)
    stream, close = counters.closing(files, "txn_time")
    df = counters.bucket_stream(stream, "merchant_id", "txn_time")
    counters.run_closed(df, close, str(tmp_path / "o"), str(tmp_path / "c"))
    assert [r.n for r in spark.read.parquet(str(tmp_path / "o")).collect()] == [10]
    write_batches(spark, path, [txn(99, 5_000)])
    counters.run_available(df, str(tmp_path / "o"), str(tmp_path / "c"))
    assert [r.n for r in spark.read.parquet(str(tmp_path / "o")).collect()] == [10]


def test_a_bucket_is_kept_once_for_all_its_windows(spark, tmp_path):
    """State of a window's rows used to be one entry a window: 24 for each of these rows."""
    path = str(tmp_path / "in")
    write_batches(spark, path, [txn(i, i * 3_600 + 5, merchant=None if i % 3 == 0 else f"m{i}") for i in range(40)])
    files = counters.file_stream(spark, spark.read.parquet(path), path)
    made = counters.rolling_stream(files, "merchant_id", "txn_time", DAY)
    query = counters.run_available(made, str(tmp_path / "o"), str(tmp_path / "c"))
    assert max(s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]) <= 4 * 40


@pytest.mark.parametrize("batches", [1, 5])
def test_rolling_windows_equal_counts_of_rows(spark, tmp_path, monkeypatch, batches):
    """All windows whose end the watermark has passed, once each, NULL keys and unordered rows included."""
    path, n = str(tmp_path / "in"), 150
    rows = [txn(i, (i * 700) - (i * 7919) % 3_000, merchant=[None, "a", "b"][i % 7 % 3]) for i in range(n)]
    write_batches(spark, path, *(rows[i : i + n // batches] for i in range(0, n, n // batches)))
    files = counters.file_stream(spark, spark.read.parquet(path), path, files_per_batch=1)
    monkeypatch.setattr(counters, "WINDOWS", 50)
    made = counters.rolling_stream(files, "merchant_id", "txn_time", DAY)
    counters.run_available(made, str(tmp_path / "o"), str(tmp_path / "c"))
    got = sorted((str(r.merchant_id), r.hr_ts, r.n) for r in spark.read.parquet(str(tmp_path / "o")).collect())
    base = int(rows[0][2].replace(tzinfo=timezone.utc).timestamp())
    when = [(str(r[4]), int(r[2].replace(tzinfo=timezone.utc).timestamp())) for r in rows]
    last = (max(t for _, t in when) - HOUR) // HOUR * HOUR
    ends = range((base // HOUR - 2) * HOUR, last + 1, HOUR)
    want = [(k, e, sum(1 for m, t in when if m == k and e - DAY <= t < e)) for k in ("None", "a", "b") for e in ends]
    assert got == sorted(w for w in want if w[2])


def test_a_late_row_counts_in_the_windows_that_are_open(spark, tmp_path):
    path = str(tmp_path / "in")
    write_batches(spark, path, [txn(1, 10 * HOUR)], [txn(2, 20 * HOUR)], [txn(3, 2 * HOUR + 1)], [txn(4, 60 * HOUR)])
    files = counters.file_stream(spark, spark.read.parquet(path), path, files_per_batch=1)
    made = counters.rolling_stream(files, "merchant_id", "txn_time", DAY)
    counters.run_available(made, str(tmp_path / "o"), str(tmp_path / "c"))
    base = int(txn(0, 0)[2].replace(tzinfo=timezone.utc).timestamp())
    got = {(r.hr_ts - base) // HOUR: r.n for r in spark.read.parquet(str(tmp_path / "o")).collect()}
    # row 3 came when the watermark was about to pass 19 h, and windows up to 9 h were out
    assert min(got) == 10 and (got[10], got[11], got[20], got[21], got[26], got[27], got[35]) == (1, 2, 2, 3, 3, 2, 1)


def test_rows_of_many_keys_share_a_group(spark, tmp_path):
    """Two groups of 60 keys: values beyond a double and doubles that are no numbers pass unchanged."""
    path = str(tmp_path / "in")
    big = 2**53 + 1
    rows = [txn(big + i, 30 * i, card=f"c{i % 60}", merchant=None if i % 2 else "m", declined=None if i % 5 == 0 else big) for i in range(300)]
    rows = [(*r[:5], None if i % 3 == 0 else big, *r[6:]) for i, r in enumerate(rows)]
    write_batches(spark, path, rows[:150], rows[150:])
    specs = [Rolling("n", "count", HOUR), Rolling("total", "sum", DAY, "declined"), Rolling("mean", "mean", DAY, "amount")]
    keep = ["txn_id", "mcc", "merchant_id", "txn_time", "score"]
    with_score = lambda d: d.withColumn("score", F.when(F.col("txn_id") % 2 == 0, F.lit("NaN").cast("double")))
    got, query = drained(spark, tmp_path, path, lambda s: rolling_rows(with_score(s), "card_id", "txn_time", specs, keep))
    names = [*keep, "card_id", "n", "total", "mean"]
    want = rolling(with_score(spark.read.parquet(path)), "card_id", "txn_time", specs, route="window")
    same = lambda d: sorted(map(str, d.select(*names).collect()))
    assert same(got) == same(want)
