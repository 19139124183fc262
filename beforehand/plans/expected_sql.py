"""The named queries as plain SQL over the same tables, for checking results."""

from __future__ import annotations

TXN = """
b AS (
 SELECT e.event_id, e.user_id, e.ts, e.value, e.event_type,
   CASE WHEN e.event_id % 4 = 0 THEN 0
        ELSE CAST(regexp_extract(e.props, '[0-9]+', 0) AS BIGINT) END AS merchant_id,
   c.c_nationkey
 FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id),
f AS (
 SELECT *, CASE WHEN event_id % 29 = 0 OR (event_type = 'error' AND merchant_id % 7 = 3)
                THEN 1 ELSE 0 END AS is_fraud FROM b),
txn AS (
 SELECT event_id AS txn_id, user_id AS card_id, ts AS txn_time,
   CAST(floor(epoch(ts)) AS BIGINT) AS ts, epoch_us(ts) AS us, value AS amount,
   merchant_id, merchant_id % 10 AS mcc,
   CASE WHEN event_id % 33 = 0 THEN (c_nationkey + 1 + event_id % 24) % 25 ELSE c_nationkey END AS txn_country,
   CASE WHEN event_type IN ('click', 'signup') THEN 'ecom' ELSE 'card_present' END AS channel,
   CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS declined, is_fraud,
   CASE WHEN is_fraud = 1 THEN ts + INTERVAL '1' DAY * (1 + event_id % 9) END AS label_confirmed_at,
   CAST((event_id * 7919) % 1000 * 7 + is_fraud * 3000 AS DOUBLE) / 10000 AS score
 FROM f),
dim AS (
 SELECT s_suppkey AS merchant_id, s_suppkey % 10 AS mcc, s_nationkey AS merchant_country,
   CASE WHEN s_suppkey % 20 = 0 THEN 'high' WHEN s_suppkey % 20 <= 3 THEN 'med' ELSE 'low' END
     AS merchant_risk_tier
 FROM supplier),
lines AS (
 SELECT l_orderkey, l_linenumber, l_extendedprice,
   CASE WHEN l_orderkey % 4 = 0 THEN 0 ELSE l_suppkey END AS merchant_id FROM lineitem)
"""

CARD = """
card AS (
 SELECT *, count(*) OVER w1h AS card_cnt_1h, count(*) OVER w24h AS card_cnt_24h,
   count(*) OVER w7d AS card_cnt_7d, coalesce(sum(amount) OVER w24h, 0.0) AS card_sum_24h,
   coalesce(sum(amount) OVER w7d, 0.0) AS card_sum_7d, avg(amount) OVER w7d AS card_mean_7d,
   count(DISTINCT merchant_id) OVER w24h AS card_nmerch_24h,
   count(DISTINCT txn_country) OVER w1h AS card_ncountry_1h,
   CAST(coalesce(sum(declined) OVER w10m, 0) AS BIGINT) AS card_declines_10m,
   CAST(coalesce(ts - lag(ts) OVER seq, -1) AS BIGINT) AS secs_since_last,
   CASE WHEN lag(txn_country) OVER seq IS NULL THEN 0
        WHEN lag(txn_country) OVER seq <> txn_country THEN 1 ELSE 0 END AS country_changed
 FROM txn
 WINDOW w10m AS (PARTITION BY card_id ORDER BY ts RANGE BETWEEN 600 PRECEDING AND 1 PRECEDING),
        w1h AS (PARTITION BY card_id ORDER BY ts RANGE BETWEEN 3600 PRECEDING AND 1 PRECEDING),
        w24h AS (PARTITION BY card_id ORDER BY ts RANGE BETWEEN 86400 PRECEDING AND 1 PRECEDING),
        w7d AS (PARTITION BY card_id ORDER BY ts RANGE BETWEEN 604800 PRECEDING AND 1 PRECEDING),
        seq AS (PARTITION BY card_id ORDER BY ts, txn_id)),
ratios AS (
 SELECT *, CASE WHEN card_mean_7d IS NULL THEN -1.0 ELSE amount / (card_mean_7d + 1e-6) END AS amt_ratio_7d,
   CASE WHEN card_sum_24h + amount = 0 THEN NULL ELSE amount / (card_sum_24h + amount) END
     AS amt_over_card_sum_24h
 FROM card)
"""

BUCKETS = """
hourly AS (
 SELECT merchant_id, ts - ts % 3600 AS hr_ts, count(*) AS n, count(DISTINCT card_id) AS nc
 FROM txn GROUP BY 1, 2),
rolled AS (
 SELECT merchant_id, hr_ts,
   CAST(coalesce(sum(n) OVER (PARTITION BY merchant_id ORDER BY hr_ts
     RANGE BETWEEN 604800 PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS merch_cnt_7d,
   CAST(coalesce(sum(nc) OVER (PARTITION BY merchant_id ORDER BY hr_ts
     RANGE BETWEEN 86400 PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS merch_ncards_24h
 FROM hourly)
"""

TE = """
hist AS (
 SELECT *, CASE WHEN is_fraud = 1 AND label_confirmed_at < TIMESTAMP '2024-01-25' THEN 1 ELSE 0 END AS known
 FROM txn WHERE txn_time < TIMESTAMP '2024-01-11'),
g AS (SELECT avg(known) AS g FROM hist),
m_te AS (
 SELECT merchant_id, (count(*) * avg(known) + 20 * max(g)) / (count(*) + 20) AS merchant_id_te
 FROM hist, g GROUP BY merchant_id),
c_te AS (
 SELECT mcc, (count(*) * avg(known) + 20 * max(g)) / (count(*) + 20) AS mcc_te
 FROM hist, g GROUP BY mcc)
"""

FEATURES = """
feat AS (
 SELECT r.*, k.merch_cnt_7d, k.merch_ncards_24h, coalesce(m.merchant_id_te, g) AS merchant_id_te,
   coalesce(c.mcc_te, g) AS mcc_te, CAST(r.txn_country <> d.merchant_country AS INT) AS cross_border,
   CAST(r.channel = 'ecom' AS INT) AS is_ecom,
   CASE d.merchant_risk_tier WHEN 'high' THEN 2 WHEN 'med' THEN 1 ELSE 0 END AS risk_tier_num,
   CAST(hour(r.txn_time) AS INT) AS hour_of_day,
   CAST(dayofweek(r.txn_time) IN (0, 6) AS INT) AS is_weekend
 FROM ratios r
 LEFT JOIN rolled k ON k.merchant_id = r.merchant_id AND k.hr_ts = r.ts - r.ts % 3600
 LEFT JOIN m_te m ON m.merchant_id = r.merchant_id
 LEFT JOIN c_te c ON c.mcc = r.mcc
 LEFT JOIN dim d ON d.merchant_id = r.merchant_id
 CROSS JOIN g)
"""

SPLIT = """
s AS (
 SELECT *, CASE WHEN txn_time >= TIMESTAMP '2024-01-11' AND txn_time < TIMESTAMP '2024-01-18' THEN 'train'
                WHEN txn_time >= TIMESTAMP '2024-01-18' AND txn_time < TIMESTAMP '2024-01-21' THEN 'valid'
                WHEN txn_time >= TIMESTAMP '2024-01-25' AND txn_time < TIMESTAMP '2024-01-31' THEN 'test'
           END AS split FROM txn)
"""


def _curve(source: str, by: str = "") -> str:
    part = f"PARTITION BY {by}" if by else ""
    lead = f"{by}, " if by else ""
    return f"""
pts AS (SELECT {lead}score, sum(is_fraud) AS pos, sum(1 - is_fraud) AS neg FROM {source} GROUP BY {lead}score),
curve AS (
 SELECT *, sum(pos) OVER d AS tp, sum(neg) OVER d AS fp, sum(pos) OVER a AS p, sum(neg) OVER a AS nn
 FROM pts WINDOW d AS ({part} ORDER BY score DESC), a AS ({part}))
"""


AP = "sum(pos * (tp / (tp + fp))) / nullif(max(p), 0)"
AUC = "sum(neg * (tp - pos / 2.0)) / nullif(max(p) * max(nn), 0)"


def _costs(split: str) -> str:
    return f"""
rows_ AS (SELECT * FROM s WHERE split = '{split}'),
thr AS (
 SELECT CASE WHEN i = 90 THEN CAST(0.95 AS DOUBLE) ELSE CAST(0.05 AS DOUBLE)
   + i * ((CAST(0.95 AS DOUBLE) - CAST(0.05 AS DOUBLE)) / 90) END AS threshold
 FROM range(91) r(i)),
sweep AS (
 SELECT threshold, coalesce(sum(CASE WHEN score < threshold AND is_fraud = 1 THEN amount END), 0) AS missed,
   sum(CASE WHEN score >= threshold AND is_fraud = 0 THEN CAST(5 AS DOUBLE) ELSE 0 END) AS false_decline_cost,
   sum(CASE WHEN score >= threshold AND is_fraud = 1 THEN 1 ELSE 0 END) AS tp,
   sum(CASE WHEN score >= threshold AND is_fraud = 0 THEN 1 ELSE 0 END) AS fp, sum(is_fraud) AS positives
 FROM thr, rows_ GROUP BY threshold),
costs AS (
 SELECT *, round(missed + false_decline_cost, 2) AS cost, tp / positives AS recall,
   tp / greatest(tp + fp, 1) AS precision FROM sweep)
"""


def q(*parts: str) -> str:
    *ctes, body = parts
    return "WITH " + ",".join([TXN, *ctes]) + body


def _rounded(names: list[str], digits: int = 4) -> str:
    return ", ".join(f"round({n}, {digits}) AS {n}" for n in names)


COUNTS = "card_cnt_1h, card_cnt_24h, card_cnt_7d, card_nmerch_24h, card_ncountry_1h, card_declines_10m"
AMOUNTS = _rounded(["card_sum_24h", "card_sum_7d", "card_mean_7d"], 8)
ROLLING_ALL = q(CARD, f"SELECT txn_id, {COUNTS}, {AMOUNTS} FROM card")
JOIN_INNER = q("SELECT l.l_orderkey, l.l_linenumber, l.merchant_id, l.l_extendedprice, d.merchant_country, "
               "d.merchant_risk_tier FROM lines l JOIN dim d ON d.merchant_id = l.merchant_id")


def _asof(by: str) -> str:
    return q(f"""SELECT l.txn_id, r.txn_id AS last_txn_id, r.amount AS last_amount
 FROM txn l ASOF LEFT JOIN txn r ON l.{by} = r.{by} AND l.txn_time > r.txn_time""")


ASOF_TE_PARTS = """
hits AS (SELECT txn_id, merchant_id, epoch_us(greatest(label_confirmed_at, txn_time)) AS at,
  CAST(greatest(label_confirmed_at, txn_time) AS DATE) AS day FROM txn WHERE is_fraud = 1),
known AS (SELECT t.txn_id, count(*) AS p FROM txn t JOIN hits h ON h.merchant_id = t.merchant_id AND h.at < t.us
  GROUP BY t.txn_id),
seen AS (SELECT txn_id, merchant_id, CAST(txn_time AS DATE) AS day, count(*) OVER (PARTITION BY merchant_id ORDER BY us
  RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS n FROM txn),
days AS (SELECT DISTINCT day FROM seen),
prior AS (SELECT d.day, coalesce((SELECT count(*) FROM hits h WHERE h.day < d.day)
  / nullif((SELECT count(*) FROM txn t WHERE CAST(t.txn_time AS DATE) < d.day), 0), 0) AS g FROM days d)
"""

WEEKLY = """
ev AS (
 SELECT merchant_id, date_trunc('week', txn_time) + INTERVAL '7' DAY AS period, 1 AS n, 0 AS p FROM txn
 UNION ALL
 SELECT merchant_id, date_trunc('week', greatest(label_confirmed_at, txn_time)) + INTERVAL '7' DAY, 0, 1
 FROM txn WHERE is_fraud = 1),
v AS (SELECT merchant_id, period, sum(n) AS n, sum(p) AS p FROM ev GROUP BY 1, 2),
gl AS (SELECT period, sum(p) OVER (ORDER BY period) / sum(n) OVER (ORDER BY period) AS g
       FROM (SELECT period, sum(n) AS n, sum(p) AS p FROM ev GROUP BY 1)),
acc AS (SELECT merchant_id, period, sum(n) OVER w AS n, sum(p) OVER w AS hits FROM v
        WINDOW w AS (PARTITION BY merchant_id ORDER BY period)),
versions AS (SELECT merchant_id, acc.period, n, hits, (hits + 20 * g) / (n + 20) AS te
             FROM acc JOIN gl ON gl.period = acc.period)
"""

SQL = {
    "feature_table_full": q(
        CARD, BUCKETS, TE, FEATURES,
        f"""SELECT txn_id, card_id, merchant_id, is_fraud, amount, {COUNTS}, secs_since_last, country_changed,
 merch_cnt_7d, merch_ncards_24h, cross_border, is_ecom, risk_tier_num, hour_of_day, is_weekend, {AMOUNTS},
 {_rounded(['amt_ratio_7d', 'amt_over_card_sum_24h', 'merchant_id_te', 'mcc_te'], 8)} FROM feat""",
    ),
    "card_rolling_counts": q(CARD, "SELECT txn_id, card_cnt_1h, card_cnt_24h, card_cnt_7d FROM card"),
    "card_rolling_amounts": q(CARD, f"SELECT txn_id, {AMOUNTS} FROM card"),
    "card_rolling_sweep": ROLLING_ALL,
    "card_rolling_hot_split": ROLLING_ALL,
    "card_rolling_micros": q("""SELECT txn_id, count(*) OVER (PARTITION BY card_id ORDER BY us
 RANGE BETWEEN 3600000000 PRECEDING AND 1 PRECEDING) AS card_cnt_1h,
 round(coalesce(sum(amount) OVER (PARTITION BY card_id ORDER BY us
 RANGE BETWEEN 86400000000 PRECEDING AND 1 PRECEDING), 0), 4) AS card_sum_24h FROM txn"""),
    "merchant_rolling_micros_sweep": q("""SELECT txn_id, count(*) OVER (PARTITION BY merchant_id ORDER BY us
 RANGE BETWEEN 3600000000 PRECEDING AND 1 PRECEDING) AS merch_cnt_1h,
 count(DISTINCT card_id) OVER (PARTITION BY merchant_id ORDER BY us
 RANGE BETWEEN 86400000000 PRECEDING AND 1 PRECEDING) AS merch_ncards_24h FROM txn"""),
    "card_distinct_exact": q(CARD, "SELECT txn_id, card_nmerch_24h, card_ncountry_1h FROM card"),
    "card_declines_10m": q(CARD, "SELECT txn_id, card_declines_10m FROM card"),
    "card_velocity_ratios": q(
        CARD, f"SELECT txn_id, {_rounded(['amt_ratio_7d', 'amt_over_card_sum_24h'])} FROM ratios"
    ),
    "time_since_last": q(CARD, "SELECT txn_id, secs_since_last FROM card"),
    "country_changed": q(CARD, "SELECT txn_id, country_changed FROM card"),
    "since_last_hot_split": q(CARD, "SELECT txn_id, secs_since_last, country_changed FROM card"),
    "secs_since_decline": q("""SELECT l.txn_id, CAST(coalesce(l.ts - r.ts, -1) AS BIGINT) AS secs_since_decline
 FROM txn l ASOF LEFT JOIN (SELECT * FROM txn WHERE declined = 1) r
 ON l.card_id = r.card_id AND l.txn_time > r.txn_time"""),
    "merchant_hourly_buckets": q(BUCKETS, "SELECT merchant_id, hr_ts, n, nc FROM hourly"),
    "merchant_rolling_bucketed": q(BUCKETS, "SELECT * FROM rolled"),
    # the sketches are exact up to some 400 members, which holds at small scale
    "merchant_distinct_hll": q(BUCKETS, """SELECT r.merchant_id, r.hr_ts, r.merch_cnt_7d,
 count(DISTINCT t.card_id) AS merch_ncards_24h FROM rolled r
 LEFT JOIN txn t ON t.merchant_id = r.merchant_id AND t.ts >= r.hr_ts - 86400 AND t.ts < r.hr_ts
 GROUP BY ALL"""),
    "merchant_bucket_joinback": q(BUCKETS, """SELECT t.txn_id, k.merch_cnt_7d, k.merch_ncards_24h FROM txn t
 LEFT JOIN rolled k ON k.merchant_id = t.merchant_id AND k.hr_ts = t.ts - t.ts % 3600"""),
    "merchant_rolling_count_sweep": q("""SELECT txn_id, count(*) OVER w24h AS merch_cnt_24h,
 count(*) OVER w7d AS merch_cnt_7d, round(coalesce(sum(CAST(amount AS DECIMAL(18,2))) OVER w24h, 0)::DOUBLE, 4)
   AS merch_sum_24h FROM txn
 WINDOW w24h AS (PARTITION BY merchant_id ORDER BY ts RANGE BETWEEN 86400 PRECEDING AND 1 PRECEDING),
        w7d AS (PARTITION BY merchant_id ORDER BY ts RANGE BETWEEN 604800 PRECEDING AND 1 PRECEDING)"""),
    "merchant_rolling_distinct_sweep": q("""SELECT txn_id, count(DISTINCT card_id) OVER (PARTITION BY merchant_id
 ORDER BY ts RANGE BETWEEN 86400 PRECEDING AND 1 PRECEDING) AS merch_ncards_24h FROM txn"""),
    "te_merchant_build": q(TE, "SELECT merchant_id, round(merchant_id_te, 6) AS merchant_id_te FROM m_te"),
    "te_mcc_build": q(TE, "SELECT mcc, round(mcc_te, 6) AS mcc_te FROM c_te"),
    "te_applied_with_prior": q(TE, """SELECT t.txn_id, round(coalesce(m.merchant_id_te, g), 6) AS merchant_id_te,
 round(coalesce(c.mcc_te, g), 6) AS mcc_te FROM txn t LEFT JOIN m_te m ON m.merchant_id = t.merchant_id
 LEFT JOIN c_te c ON c.mcc = t.mcc CROSS JOIN g"""),
    "te_merchant_row_asof": q(ASOF_TE_PARTS, """SELECT s.txn_id,
 round((coalesce(k.p, 0) + 20 * r.g) / (s.n + 20), 6) AS merchant_id_te
 FROM seen s LEFT JOIN known k ON k.txn_id = s.txn_id JOIN prior r ON r.day = s.day"""),
    "te_row_asof_hot_split": q(ASOF_TE_PARTS, """SELECT s.txn_id,
 round((coalesce(k.p, 0) + 20 * 0.05::DOUBLE) / (s.n + 20), 6) AS merchant_id_te
 FROM seen s LEFT JOIN known k ON k.txn_id = s.txn_id"""),
    "te_weekly_versions": q(WEEKLY, """
SELECT merchant_id, CAST(epoch(period) AS BIGINT) AS period_ts, CAST(n AS BIGINT) AS n,
 CAST(hits AS BIGINT) AS hits, round(te, 6) AS merchant_id_te FROM versions"""),
    "te_weekly_applied": q(WEEKLY, """SELECT t.txn_id, round(v.te, 6) AS merchant_id_te
 FROM txn t ASOF LEFT JOIN versions v ON v.merchant_id = t.merchant_id AND t.txn_time >= v.period"""),
    "dim_enrich_context": q("""SELECT t.txn_id, CAST(t.txn_country <> d.merchant_country AS INT) AS cross_border,
 CAST(t.channel = 'ecom' AS INT) AS is_ecom,
 CASE d.merchant_risk_tier WHEN 'high' THEN 2 WHEN 'med' THEN 1 ELSE 0 END AS risk_tier_num
 FROM txn t LEFT JOIN dim d ON d.merchant_id = t.merchant_id"""),
    "calendar_context": q("""SELECT txn_id, ts, ts - ts % 3600 AS hr_ts, strftime(txn_time, '%Y-%m-%d') AS txn_date,
 CAST(hour(txn_time) AS INT) AS hour_of_day, CAST(dayofweek(txn_time) IN (0, 6) AS INT) AS is_weekend FROM txn"""),
    "join_sort_merge": JOIN_INNER,
    "join_salted": JOIN_INNER,
    "join_salted_all_keys": JOIN_INNER,
    "join_broadcast": JOIN_INNER,
    "join_lookup_left": JOIN_INNER.replace("lines l JOIN dim", "lines l LEFT JOIN dim"),
    "asof_lookup": _asof("card_id"),
    "asof_lookup_hot_split": _asof("merchant_id"),
    "key_skew_report": q("""SELECT merchant_id, count(*) AS n,
 round(count(*) / (SELECT count(*) FROM txn), 6) AS share FROM txn GROUP BY merchant_id"""),
    "key_skew_topk": q("SELECT merchant_id, count(*) AS n FROM lines GROUP BY 1 ORDER BY n DESC, merchant_id LIMIT 3"),
    "ranked_share_report": q("""SELECT CAST(mcc AS VARCHAR) AS feature, count(*) AS n,
 round(count(*) * 100.0 / (SELECT count(*) FROM txn), 1)::DOUBLE AS n_pct FROM txn GROUP BY mcc"""),
    "key_attribute_lookup": q("""SELECT d.mcc, count(*) AS n,
 round(CAST(sum(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE), 2) AS total
 FROM lines l LEFT JOIN dim d ON d.merchant_id = l.merchant_id GROUP BY d.mcc"""),
    "dedup_transactions": q("SELECT txn_id, card_id, merchant_id, amount, is_fraud FROM txn"),
    "dedup_missing_keys": q("""SELECT txn_id, card_id, merchant_id, amount FROM txn WHERE merchant_id % 10 <> 3
 UNION ALL SELECT NULL, card_id, merchant_id, amount FROM txn CROSS JOIN (VALUES (1), (2)) WHERE merchant_id % 10 = 3"""),
    "land_late_rows": q("""SELECT txn_id, card_id, amount, strftime(txn_time, '%Y-%m-%d') AS txn_date FROM txn
 UNION ALL SELECT txn_id + 1000000000000, card_id, amount, NULL FROM txn WHERE txn_id % 50 = 0"""),
    "quality_checks": q("""c AS (SELECT count(*) AS n, count(DISTINCT txn_id) AS d,
 sum(CASE WHEN label_confirmed_at IS NULL THEN 1 ELSE 0 END) / count(*) AS a,
 sum(CASE WHEN merchant_id IS NULL THEN 1 ELSE 0 END) / count(*) AS m
 FROM (SELECT * FROM txn UNION ALL SELECT * FROM txn))""", """
SELECT 'rows' AS metric, CAST(n AS DOUBLE) AS value FROM c
UNION ALL SELECT 'distinct_keys', CAST(d AS DOUBLE) FROM c
UNION ALL SELECT 'duplicate_rows', CAST(n - d AS DOUBLE) FROM c
UNION ALL SELECT 'null_rate_label_confirmed_at', round(a, 6) FROM c
UNION ALL SELECT 'null_rate_merchant_id', round(m, 6) FROM c"""),
    "quality_gate": q(_curve("txn"), f"""SELECT 'duplicate_rows' AS metric, 'max' AS op, CAST(0 AS DOUBLE) AS bound,
 CAST(count(*) AS DOUBLE) AS value FROM txn HAVING count(*) > 0
UNION ALL SELECT 'pr_auc', 'min', CAST(0.6 AS DOUBLE), round({AP}, 6) FROM curve HAVING {AP} < 0.6"""),
    "dataset_profile": q("""SELECT count(*) AS rows, CAST(sum(is_fraud) AS BIGINT) AS positives,
 round(avg(is_fraud), 6) AS rate, min(ts) AS first_ts, max(ts) AS last_ts FROM txn"""),
    "label_maturity": q(SPLIT, """SELECT CAST(sum(is_fraud) AS BIGINT) AS positives, CAST(sum(k) AS BIGINT) AS known,
 round(sum(k) / nullif(sum(is_fraud), 0), 6) AS known_share FROM (SELECT *, CASE WHEN is_fraud = 1
 AND label_confirmed_at < TIMESTAMP '2024-01-21' THEN 1 ELSE 0 END AS k FROM s WHERE split = 'train')"""),
    "temporal_split_counts": q(SPLIT, """SELECT split, count(*) AS n, CAST(sum(is_fraud) AS BIGINT) AS positives
 FROM s GROUP BY split"""),
    "union_splits": q(SPLIT, "SELECT txn_id, split, amount FROM s WHERE split IS NOT NULL"),
    "class_weight": q(SPLIT, """SELECT CAST(sum(is_fraud) AS BIGINT) AS n_pos, CAST(sum(1 - is_fraud) AS BIGINT) AS n_neg,
 round(sqrt(sum(1 - is_fraud) / nullif(sum(is_fraud), 0)), 6) AS pos_weight FROM s WHERE split = 'train'"""),
    "honest_labels": q("""SELECT txn_id, CASE WHEN is_fraud = 1 AND label_confirmed_at < TIMESTAMP '2024-01-25'
 THEN 1 ELSE 0 END AS y_honest, is_fraud AS y_oracle FROM txn"""),
    "class_profile": q(CARD, BUCKETS, TE, FEATURES, """SELECT is_fraud, round(avg(card_cnt_24h), 4) AS cnt_24h,
 round(avg(secs_since_last), 2) AS secs_since_last, round(avg(amt_ratio_7d), 4) AS amt_ratio_7d,
 round(avg(card_declines_10m), 4) AS declines_10m, round(avg(merchant_id_te), 4) AS merchant_te
 FROM feat GROUP BY is_fraud"""),
    "psi_drift": q(SPLIT, """
e AS (SELECT list_distinct(quantile_disc(amount, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS edges
      FROM s WHERE split = 'train'),
r AS (SELECT split, CAST(len(list_filter(edges, lambda x: x < amount)) AS INT) AS bin FROM s, e
      WHERE split IN ('train', 'test') AND amount IS NOT NULL),
c AS (SELECT bin, count(*) FILTER (split = 'train') AS n_ref, count(*) FILTER (split = 'test') AS n_act
      FROM r GROUP BY bin),
z AS (SELECT *, greatest(n_ref, 0.5) / sum(n_ref) OVER () AS e, greatest(n_act, 0.5) / sum(n_act) OVER () AS a FROM c)
""", "SELECT bin, n_ref, n_act, round((a - e) * ln(a / e), 6) AS psi FROM z"),
    "average_precision": q(_curve("txn"), f"SELECT round({AP}, 6) AS pr_auc FROM curve"),
    "roc_auc": q(_curve("txn"), f"SELECT round({AUC}, 6) AS roc_auc FROM curve"),
    "metrics_by_split": q(SPLIT, _curve("s", "split"), f"""SELECT split, round({AP}, 6) AS pr_auc,
 round({AUC}, 6) AS roc_auc, CAST(max(p) + max(nn) AS BIGINT) AS n, CAST(max(p) AS BIGINT) AS n_pos
 FROM curve GROUP BY split"""),
    "cost_curve": q(SPLIT, _costs("test"), f"""SELECT
 {_rounded(['threshold', 'missed', 'false_decline_cost', 'cost'])}, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
 {_rounded(['recall', 'precision'], 6)} FROM costs"""),
    "cost_threshold": q(SPLIT, _costs("test"), f"""SELECT
 {_rounded(['threshold', 'cost', 'missed', 'false_decline_cost'], 2)}, {_rounded(['recall', 'precision'])}
 FROM costs ORDER BY costs.cost, costs.threshold LIMIT 1"""),
    "confusion_at_threshold": q(SPLIT, _costs("valid"), """
best AS (SELECT threshold FROM costs ORDER BY cost, threshold LIMIT 1),
x AS (SELECT sum(CASE WHEN score >= threshold AND is_fraud = 1 THEN 1 ELSE 0 END) AS tp,
 sum(CASE WHEN score >= threshold AND is_fraud = 0 THEN 1 ELSE 0 END) AS fp,
 sum(CASE WHEN score < threshold AND is_fraud = 1 THEN 1 ELSE 0 END) AS fn,
 sum(CASE WHEN score < threshold AND is_fraud = 0 THEN 1 ELSE 0 END) AS tn,
 coalesce(sum(CASE WHEN score < threshold AND is_fraud = 1 THEN amount END), 0) AS missed
 FROM s, best WHERE split = 'test')""", """SELECT CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
 CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn, round(missed, 2) AS missed,
 round(tp / nullif(tp + fn, 0), 4) AS recall, round(tp / greatest(tp + fp, 1), 4) AS precision FROM x"""),
    "partitioned_roundtrip": q("""SELECT txn_id, card_id, amount, strftime(txn_time, '%Y-%m-%d') AS txn_date FROM txn"""),
    "pruned_range_scan": q(SPLIT, "SELECT txn_id, amount FROM s WHERE split = 'train'"),
    "catalog_table_roundtrip": q("""SELECT t.txn_id, t.merchant_id, d.merchant_country FROM txn t
 LEFT JOIN dim d ON d.merchant_id = t.merchant_id"""),
    "bucketed_table_windows": q(CARD, "SELECT txn_id, card_cnt_24h, card_cnt_7d FROM card"),
    "clustered_files": q("SELECT txn_id, card_id, amount FROM txn"),
    "snapshot_asof_read": q("SELECT txn_id, card_id, amount FROM txn"),
    "snapshot_history": q("""SELECT CAST(0 AS BIGINT) AS version, 'WRITE' AS operation, count(*) AS rows FROM txn
UNION ALL SELECT 1, 'REPLACE', count(*) FROM txn WHERE is_fraud = 1"""),
    "row_count_drift": q("""c AS (SELECT CAST(count(*) AS DOUBLE) AS b, CAST(count_if(merchant_id % 10 <> 3) AS DOUBLE) AS n
 FROM txn)""", """
SELECT 'rows' AS metric, n AS value FROM c UNION ALL SELECT 'rows_before', b FROM c
UNION ALL SELECT 'row_drift', round(abs(n - b) / b, 6) FROM c"""),
    "metrics_json_roundtrip": q(SPLIT, _curve("s", "split"), f"""
SELECT split, 'pr_auc' AS metric, round({AP}, 6) AS value FROM curve WHERE split IS NOT NULL GROUP BY split
UNION ALL SELECT split, 'roc_auc', round({AUC}, 6) FROM curve WHERE split IS NOT NULL GROUP BY split"""),
    "stream_dedup": "SELECT event_id, user_id, value FROM events",
    "stream_hourly_counters": """SELECT user_id, hr_ts, count(*) AS n
 FROM (SELECT user_id, CAST(floor(epoch(ts)) AS BIGINT) AS t, t - t % 3600 AS hr_ts FROM events)
 WHERE to_timestamp(hr_ts + 3600) AT TIME ZONE 'UTC' <= (SELECT max(ts) - INTERVAL '1' HOUR FROM events)
 GROUP BY user_id, hr_ts""",
}

SQL["stream_hourly_distinct"] = """SELECT user_id, hr_ts, count(*) AS n, count(DISTINCT event_type) AS nc
 FROM (SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS t, t - t % 3600 AS hr_ts FROM events) GROUP BY user_id, hr_ts"""

SQL["stream_rolling_rows"] = """SELECT event_id, user_id, count(*) OVER h AS cnt_1h, count(*) OVER d AS cnt_24h,
 round(CAST(coalesce(sum(CAST(value AS DECIMAL(28, 9))) OVER h, 0) AS DOUBLE), 8) AS sum_1h,
 round(CAST(coalesce(sum(CAST(value AS DECIMAL(28, 9))) OVER d, 0) AS DOUBLE), 8) AS sum_24h,
 round(CAST(sum(CAST(value AS DECIMAL(28, 9))) OVER d AS DOUBLE) / count(value) OVER d, 8) AS mean_24h
 FROM (SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS t FROM events)
 WINDOW h AS (PARTITION BY user_id ORDER BY t RANGE BETWEEN 3600 PRECEDING AND 1 PRECEDING),
  d AS (PARTITION BY user_id ORDER BY t RANGE BETWEEN 86400 PRECEDING AND 1 PRECEDING)"""

SQL["drift_from_sketches"] = q(SPLIT, """
e AS (SELECT len(list_distinct(quantile_disc(amount, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]))) + 1 AS bins
      FROM s WHERE split = 'train')""", """SELECT 'amount' AS "column", max(bins) AS bins, count(*) FILTER (split = 'train') AS n_ref,
 count(*) FILTER (split = 'test') AS n_act, true AS ref_within, true AS act_within
 FROM s, e WHERE amount IS NOT NULL""")

SQL["card_distinct_approx"] = SQL["card_distinct_exact"]

SQL["backfill_by_range"] = SQL["feature_table_full"]
SQL["silver_feature_table"] = SQL["feature_table_full"]
SQL["stream_rolling_counters"] = """SELECT user_id, hr_ts, count(*) AS n
 FROM (SELECT user_id, CAST(floor(epoch(ts)) AS BIGINT) AS t, t - t % 3600 + 3600 * (1 + k) AS hr_ts
       FROM events, range(24) r(k))
 WHERE to_timestamp(hr_ts) AT TIME ZONE 'UTC' <= (SELECT max(ts) - INTERVAL '1' HOUR FROM events)
 GROUP BY user_id, hr_ts"""


def _ap(where: str, name: str) -> str:
    return f"""
{name}_p AS (SELECT score, sum(is_fraud) AS pos, sum(1 - is_fraud) AS neg FROM s WHERE {where} GROUP BY score),
{name}_c AS (SELECT *, sum(pos) OVER d AS tp, sum(neg) OVER d AS fp, sum(pos) OVER () AS p
 FROM {name}_p WINDOW d AS (ORDER BY score DESC)),
{name} AS (SELECT {AP} AS v FROM {name}_c)"""


SQL["leakage_gap_given_scores"] = q(
    SPLIT, _ap("(txn_id * 7919) % 10 >= 7", "a"), _ap("split = 'test'", "t"),
    """ SELECT round(a.v, 6) AS random_holdout, round(t.v, 6) AS time_test, round(a.v - t.v, 6) AS gap,
 a.v - t.v >= 0.05 AS alarm FROM a, t""",
)


def _recall(points: str) -> str:
    def at(t: str, tag: str) -> str:
        return f"""round(CASE WHEN max(p) > 0 THEN coalesce(max(CASE WHEN fp / nullif(nn, 0) <= {t} THEN tp END) / max(p), 0)
  END, 6) AS recall_{tag}, round(coalesce(min(CASE WHEN fp / nullif(nn, 0) <= {t} THEN score END),
  CAST('inf' AS DOUBLE)), 6) AS threshold_{tag}"""

    return f"SELECT {at('0.01', '1pct')}, {at('0.001', '0_1pct')} FROM {points}"


SQL["recall_at_fpr"] = q(_curve("txn"), _recall("curve"))
SQL["recall_at_fpr_corners"] = q(_curve("txn"), """
steps AS (SELECT *, lead(pos) OVER (ORDER BY score DESC) AS npos, lead(neg) OVER (ORDER BY score DESC) AS nneg,
  row_number() OVER (ORDER BY score DESC) AS i FROM curve),
corners AS (SELECT * FROM steps WHERE i = 1 OR npos IS NULL OR npos <> pos OR nneg <> neg)""", _recall("corners"))
