import random
import re
from urllib.parse import urlsplit

from pyspark.sql import functions as F

from beforehand.llm import url_lists

from .helpers import clashing

DAY = url_lists.DAY


def keys(url):
    if not url or not re.match(r"[A-Za-z][A-Za-z0-9+.-]*://", url):
        return []
    host = (urlsplit(url).hostname or "").lower()
    if not host:
        return []
    labels = host.split(".")
    out = [f"h:{host}"] + ["d:" + ".".join(labels[i:]) for i in range(max(1, len(labels) - 1))]
    segs = [s for s in urlsplit(url).path.split("/") if s]
    return out + [f"p:{host}/" + "/".join(segs[: i + 1]) for i in range(len(segs))]


def brute(captures, changes):
    state = {}
    for key, at, active in changes:
        if key is not None and at is not None:
            state.setdefault(key, {})[at] = state.get(key, {}).get(at, False) or active
    out = []
    for page, url, t in captures:
        hits = []
        for key in keys(url) if t is not None else []:
            before = [a for a in state.get(key, {}) if a <= t]
            if before and state[key][max(before)]:
                hits.append((len(key), key, max(before)))
        best = max(hits, default=(None, None, None))
        out.append((page, url, t, len(hits), bool(hits), best[1], best[2]))
    return sorted(out, key=str)


def judged(spark, captures, changes):
    c = spark.createDataFrame(captures, "page_id long, url string, fetched_at long")
    l = spark.createDataFrame(changes, "key string, at long, active boolean")
    got = url_lists.judge(clashing(c).withColumn("n_active", F.lit(7)), l)
    return sorted(
        (tuple(r[c] for c in ("page_id", "url", "fetched_at", "n_active", "blocked", "rule", "valid_from")) for r in got.collect()),
        key=str,
    )


def test_against_brute_force(spark):
    rng = random.Random(2)
    hosts = ["a.example.org", "b.a.example.org", "x.net", "deep.sub.x.net", "localhost"]
    urls = [f"{rng.choice(['http', 'HTTPS'])}://{rng.choice(['', 'me:pw@'])}{h.upper() if rng.random() < 0.3 else h}{rng.choice(['', ':80'])}{p}"
            for h in hosts for p in ("", "/", "/one", "/one/two?q=/x", "//one/#f")]
    urls += [None, "", "no url", "http:///path", "mailto:a@b.c"]
    captures = [(i, rng.choice(urls), rng.randrange(6 * DAY)) for i in range(400)]
    captures += [(1, urls[0], 5), (1, urls[0], 5), (None, urls[0], None), (None, None, 3)]
    pool = sorted({k for u in urls for k in keys(u)})
    changes = [(rng.choice(pool), rng.randrange(-DAY, 6 * DAY), rng.random() < 0.6) for _ in range(150)]
    changes += [("h:x.net", d * DAY, d % 2 == 0) for d in range(6)]
    changes += [("h:x.net", 100, True), ("h:x.net", 100, False), (None, 5, True), ("h:x.net", None, True)]
    changes += [("d:example.org", 3 * DAY + i, i % 3 == 0) for i in range(300)]
    assert judged(spark, captures, changes) == brute(captures, changes)


def test_a_hot_key_and_day_is_cut_without_pairs(spark):
    rng = random.Random(3)
    u = "http://a.x.net/"
    changes = [("d:x.net", rng.randrange(DAY), rng.random() < 0.5) for _ in range(900)] + [("h:a.x.net", 5, True)]
    captures = [(i, f"{u}{i % 7}", rng.randrange(-9, DAY)) for i in range(900)] + [(i, f"{u}{i}", DAY // 2) for i in range(900, 1100)]
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        assert judged(spark, captures, changes) == brute(captures, changes)
        probes = spark.createDataFrame([(u, t, "d:x.net") for _, _, t in captures], "url string, fetched_at long, key string")
        found = url_lists.states(spark.createDataFrame(changes, "key string, at long, active boolean"), probes)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert not re.search("Join.*[<>]", plan)
        slices = spark.read.parquet(next(f for f in found.inputFiles()).rsplit("/", 1)[0])
        assert slices.where("key = 'd:x.net'").select("_slice").distinct().count() == 8
    finally:
        spark.conf.unset(setting)


def test_boundaries(spark):
    u = "http://x.net/"
    times = [DAY - 1, DAY, DAY + 1, 5 * DAY - 1, 5 * DAY, 9 * DAY]
    changes = [("h:x.net", DAY, True), ("h:x.net", 5 * DAY, False)]
    got = judged(spark, [(i, u, t) for i, t in enumerate(times)], changes)
    assert [r[4] for r in got] == [False, True, True, True, False, False]


def test_empty_tables(spark):
    assert judged(spark, [], [("h:x.net", 1, True)]) == []
    assert judged(spark, [(1, "http://x.net", 2)], []) == [(1, "http://x.net", 2, 0, False, None, None)]
