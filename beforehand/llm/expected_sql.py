"""DuckDB SQL with the rows of the queries that SQL can express.

SimHash, Merkle trees, the Hilbert curve, Viterbi paths, the trained model, tokens and words chosen by a
CRC have no SQL form; tests hold those queries against brute force.
"""

from __future__ import annotations

from itertools import permutations

from .filter_audit import FILTERS
from .secrets import BASE, RULES
from .url_lists import HOST, PATH

WARC = """
WITH d AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
k AS (SELECT payload_digest, max(page_id) AS keep FROM d WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
  CASE WHEN keep <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN keep <> page_id THEN keep END AS refers_to
FROM d LEFT JOIN k ON k.payload_digest = d.payload_digest AND payload_bytes >= 1000
"""

URL_LISTS = f"""
WITH pg AS (
  SELECT page_id, nullif(lower(regexp_extract(url, '{HOST}', 1)), '') AS host,
    [s FOR s IN string_split(regexp_extract(url, '{PATH}', 1), '/') IF s <> ''] AS segs,
    regexp_extract(regexp_extract(url, '{PATH}', 1), '^/([^/]+)', 1) AS first,
    (1704067200 + (page_id * 7919) % 2592000) * 1000000 AS fetched_at
  FROM pages),
parts AS (SELECT *, string_split(host, '.') AS labels FROM pg),
keys AS (
  SELECT page_id, fetched_at, unnest(list_concat(['h:' || host],
    ['d:' || array_to_string(labels[i:], '.') FOR i IN range(1, greatest(len(labels) - 1, 1) + 1)],
    ['p:' || host || '/' || array_to_string(segs[:i], '/') FOR i IN range(1, len(segs) + 1)])) AS key
  FROM parts WHERE host IS NOT NULL),
changes AS (
  SELECT key, since, bool_or(active) AS active FROM (
    SELECT CASE user_id % 3 WHEN 0 THEN 'h:' || host
        WHEN 1 THEN 'd:' || coalesce(nullif(regexp_extract(host, '([^.]+\\.[^.]+\\.[^.]+)$', 1), ''), host)
        ELSE 'p:' || host || '/' || first END AS key,
      epoch_us(ts) AS since, event_type IN ('click', 'error', 'purchase') AS active
    FROM events JOIN (SELECT *, row_number() OVER (ORDER BY page_id) - 1 AS number FROM parts) numbered
      ON event_id % (SELECT count(*) FROM pages) = number)
  WHERE key IS NOT NULL GROUP BY 1, 2),
hits AS (
  SELECT k.page_id, c.key, c.since, row_number() OVER (PARTITION BY k.page_id ORDER BY length(c.key) DESC, c.key DESC) AS n,
    count(*) OVER (PARTITION BY k.page_id) AS n_active
  FROM (SELECT k.page_id, k.key, c.since, c.active FROM keys k ASOF JOIN changes c ON k.key = c.key AND k.fetched_at >= c.since) k
  JOIN changes c ON c.key = k.key AND c.since = k.since WHERE k.active)
SELECT pg.page_id, pg.fetched_at, pg.host, coalesce(n_active, 0) AS n_active, n_active IS NOT NULL AS blocked,
  hits.key AS rule, hits.since AS valid_from
FROM pg LEFT JOIN hits ON hits.page_id = pg.page_id AND hits.n = 1
"""

MIXING = """
WITH s AS (SELECT source, sum(coalesce(strlen(text), 0) + 1) AS bytes FROM documents GROUP BY 1),
r AS (
  SELECT source, pow(bytes, 0.7) / (SELECT sum(pow(bytes, 0.7)) FROM s) * (SELECT sum(bytes) FROM s) / bytes AS rate FROM s),
b AS (
  SELECT *, CAST(greatest(0, floor(rate - 12 * sqrt(rate) - 20)) AS BIGINT) AS low,
    CAST(ceil(rate + 12 * sqrt(rate) + 20) AS BIGINT) AS high FROM r),
k AS (SELECT source, rate, unnest(range(low, high + 1)) AS k FROM b),
p AS (
  SELECT source, sum(exp(-rate + k * ln(rate) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS p FROM k),
d AS (
  SELECT doc_id, source, (CAST('0x' || substr(md5('mix|' || doc_id), 1, 13) AS BIGINT) + 0.5) / pow(2, 52) AS u FROM documents),
c AS (
  SELECT d.doc_id, d.source, rate, low + (SELECT count(*) FROM p WHERE p.source = d.source AND p.p <= d.u) AS copies
  FROM d JOIN b ON b.source = d.source),
e AS (SELECT *, unnest(range(1, copies + 1)) AS copy FROM c)
SELECT doc_id, source, round(rate, 6) AS rate, copies, copy,
  CAST('0x' || substr(md5('mix-order|' || doc_id || '|' || copy), 1, 13) AS BIGINT) AS shuffle_key
FROM e
"""


def _secrets() -> str:
    """For each rule: matches, the counted group, the pieces between, and spans from running lengths."""
    quoted = [r.pattern.replace("'", "''") for r in RULES]
    found = ", ".join(
        f"regexp_extract_all(t, '{q}') AS f{i}, regexp_extract_all(t, '{q}', {r.group}) AS v{i}, "
        f"string_split_regex(t, '{q}') AS p{i}"
        for i, (r, q) in enumerate(zip(RULES, quoted))
    )
    spans = ", ".join(
        f"[{{'start': list_sum([length(x) FOR x IN p{i}[:n]]) + coalesce(list_sum([length(x) FOR x IN f{i}[:n - 1]]), 0), "
        f"'kind': {i}, 'size': length(f{i}[n])}} FOR n IN range(1, len(f{i}) + 1) IF length(v{i}[n]) >= {r.least}] AS s{i}"
        for i, r in enumerate(RULES)
    )
    kinds = "[" + ", ".join(f"'{r.kind}'" for r in RULES) + "]"

    def told(lists: str) -> str:
        each = f"[{kinds}[x.kind + 1] || ':' || x.start || ':' || (x.start + x.size) FOR x IN list_sort({lists})]"
        return f"coalesce(array_to_string({each}, ','), '')"

    base = "s0 || s1 || s2"
    every = " || ".join(f"s{i}" for i in range(len(RULES)))
    counts = ", ".join(f"CAST(len(s{i}) AS BIGINT) AS n_{r.kind}" for i, r in enumerate(BASE))
    return (
        f"WITH f AS (SELECT doc_id, {found} FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)), "
        f"s AS (SELECT doc_id, {spans} FROM f) "
        f"SELECT doc_id, {counts}, sha256({told(base)}) AS base_sha256, {told(every)} AS spans FROM s"
    )


_STEPS = ", ".join(
    f"('{''.join(order)}', {step}, {1 << FILTERS.index(f)}, {sum(1 << FILTERS.index(e) for e in order[: step - 1])})"
    for order in permutations(FILTERS)
    for step, f in enumerate(order, 1)
)

FILTER_AUDIT = f"""
WITH t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
marks AS (
  SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY 1),
f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    (len(words) < 200)::INT + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
      + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t))::INT
      + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY t), false)::INT AS mask
  FROM t LEFT JOIN marks ON marks.doc_id = t.doc_id),
cells AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY 1, 2),
steps(filter_order, step, own, earlier) AS (VALUES {_STEPS}),
sums AS (
  SELECT part, filter_order, step, own,
    coalesce(sum(n) FILTER (mask & (own | earlier) = 0), 0) AS kept,
    coalesce(sum(n) FILTER (mask & own > 0 AND mask & earlier = 0), 0) AS removed,
    coalesce(sum(n) FILTER (mask & own > 0 AND mask & earlier > 0), 0) AS redundant,
    coalesce(sum(n) FILTER (mask = own), 0) AS unique_fails,
    coalesce(sum(good) FILTER (mask & own > 0 AND mask & earlier = 0), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (mask & own > 0 AND mask & earlier = 0), 0) AS toxic_lost
  FROM cells CROSS JOIN steps GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM sums
"""

SQL = {
    "op1_warc_members": WARC,
    "op4_url_list_asof": URL_LISTS,
    "op7_secret_trigrams": _secrets(),
    "op9_poisson_mixing": MIXING,
    "op12_filter_audit": FILTER_AUDIT,
}
