"""Profiles, scores, contracts, observations (QL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality
from ..plans import steps
from .joining import _DAILY, _daily
from .registry import query

_NUM = """SELECT '{c}' AS "column", count(*) AS rows, count(*) FILTER ({c} IS NULL) AS nulls, count(DISTINCT {c}) AS "distinct", count(*) FILTER ({c} = 0) AS zeros, count(*) FILTER ({c} < 0) AS negatives,
 CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, round(avg({c}), 2) AS mean, round(stddev_samp({c}), 2) AS std, round(quantile_cont({c}, 0.25), 2) AS p25, round(quantile_cont({c}, 0.5), 2) AS p50, round(quantile_cont({c}, 0.75), 2) AS p75,
 CAST(NULL AS BIGINT) AS min_length, CAST(NULL AS BIGINT) AS max_length, CAST(NULL AS DOUBLE) AS mean_length, CAST(NULL AS BIGINT) AS empty FROM {t}"""
_TXT = """SELECT '{c}', count(*), count(*) FILTER ({c} IS NULL), count(DISTINCT {c}), NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, CAST(min(length({c})) AS BIGINT), CAST(max(length({c})) AS BIGINT), round(avg(length({c})), 2), count(*) FILTER ({c} = '') FROM {t}"""
_PART = "(SELECT p_size, p_retailprice, CASE WHEN p_partkey % 9 = 0 THEN NULL WHEN p_partkey % 10 = 0 THEN '' ELSE p_type END AS p_type FROM part)"


def _part(t):
    return t.part.selectExpr("p_size", "p_retailprice", "case when p_partkey % 9 = 0 then null when p_partkey % 10 = 0 then '' else p_type end as p_type")


@query("ql1_table_profile", f"SELECT CAST(sum(n) AS BIGINT) AS rows, 3 AS columns, CAST(sum(n) - count(*) AS BIGINT) AS duplicates, CAST(sum(CASE WHEN p_type IS NULL THEN n ELSE 0 END) AS BIGINT) AS null_cells FROM (SELECT p_size, p_retailprice, p_type, count(*) AS n FROM {_PART} GROUP BY ALL)")
def _(t):
    return quality.profile_table(_part(t))


@query("ql2_column_profile", _NUM.format(c="p_size", t=_PART) + " UNION ALL " + _NUM.format(c="p_retailprice", t=_PART) + " UNION ALL " + _TXT.format(c="p_type", t=_PART))
def _(t):
    return quality.column_statistics(_part(t), digits=2)


_SPREAD = "SELECT CASE WHEN l_linenumber = 3 THEN NULL ELSE l_extendedprice END AS price, CASE WHEN l_orderkey % 3 > 0 THEN 7 ELSE l_partkey END AS hot, CASE WHEN l_linenumber = 1 THEN -1e200 * l_partkey WHEN l_linenumber = 2 THEN 1e-9 * l_suppkey ELSE l_quantity - 25 END AS wild, CAST(NULL AS DOUBLE) AS never FROM lineitem"


@query("ql2_quartiles", " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS \"distinct\", CAST(quantile_cont({c}, 0.25) AS DOUBLE) AS p25, CAST(quantile_cont({c}, 0.5) AS DOUBLE) AS p50, CAST(quantile_cont({c}, 0.75) AS DOUBLE) AS p75 FROM ({_SPREAD})" for c in ("price", "hot", "wild", "never")))
def _(t):
    """Nulls, a value that holds two thirds of the rows, values from 1e-9 to 1e205, and no value at all."""
    rows = t.lineitem.selectExpr(
        "case when l_linenumber = 3 then null else l_extendedprice end as price",
        "case when l_orderkey % 3 > 0 then 7 else l_partkey end as hot",
        "case when l_linenumber = 1 then -1e200 * l_partkey when l_linenumber = 2 then 1e-9 * l_suppkey else l_quantity - 25 end as wild",
        "cast(null as double) as never",
    )
    return quality.column_statistics(rows, digits=None, parts=("distinct", "quartiles")).select("column", "distinct", "p25", "p50", "p75")


@query("ql2_time_range", "SELECT CAST(min(ts) AS VARCHAR) AS first, CAST(max(ts) AS VARCHAR) AS last, date_diff('day', min(ts), max(ts)) AS days FROM events")
def _(t):
    return quality.time_range(t.events, "ts")


_SCORED = "(SELECT p_size, p_retailprice, p_type, 7 AS same, TIMESTAMP '2023-01-01 00:00:00' + INTERVAL 1 DAY * CAST(p_partkey * 7 % 500 AS INTEGER) AS seen FROM {part})"


@query("ql3_quality_score", f"""
WITH p AS {_SCORED.format(part=_PART.replace("SELECT p_size", "SELECT p_partkey, p_size"))}, m AS (SELECT avg(p_size) AS ma, stddev_samp(p_size) AS sa, avg(p_retailprice) AS mb, stddev_samp(p_retailprice) AS sb FROM p),
d AS (SELECT sum(n) AS rows, sum(n) - count(*) AS dup FROM (SELECT count(*) AS n FROM p GROUP BY p_size, p_retailprice, p_type, same, seen)),
x AS (SELECT round(100.0 * (4 * count(*) + count(p_type)) / (5 * count(*)), 2) AS completeness,
 round((100.0 * count(*) FILTER (abs(p_size - ma) <= 3 * sa) / count(*) + 100.0 * count(*) FILTER (abs(p_retailprice - mb) <= 3 * sb) / count(*) + 100) / 3, 2) AS consistency,
 round(100.0 * count(*) FILTER (floor(epoch(TIMESTAMP '2024-06-01 00:00:00' - seen) / 86400) <= 365) / count(*), 2) AS timeliness FROM p, m),
y AS (SELECT CAST(rows AS BIGINT) AS rows, CAST(completeness AS DOUBLE) AS completeness, round(100.0 - 100.0 * dup / rows, 2) AS uniqueness, CAST(75 AS DOUBLE) AS validity, consistency, timeliness FROM x, d),
z AS (SELECT *, round(0.30 * completeness + 0.20 * uniqueness + 0.25 * validity + 0.15 * consistency + 0.10 * timeliness, 2) AS score FROM y)
SELECT *, CASE WHEN score >= 90 THEN 'A' WHEN score >= 80 THEN 'B' WHEN score >= 70 THEN 'C' WHEN score >= 60 THEN 'D' ELSE 'F' END AS grade FROM z""")
def _(t):
    rows = t.part.selectExpr("p_partkey", "p_size", "p_retailprice", "case when p_partkey % 9 = 0 then null when p_partkey % 10 = 0 then '' else p_type end as p_type")
    rows = rows.selectExpr("p_size", "p_retailprice", "p_type", "7 as same", "timestamp'2023-01-01 00:00:00' + make_interval(0, 0, 0, cast(p_partkey * 7 % 500 as int)) as seen")
    return quality.quality_score(rows, passed=3, total=4, as_of="2024-06-01 00:00:00")


_DIMENSIONS = f"SELECT *, CAST(100 - row_count % 43 AS DOUBLE) AS completeness FROM ({_DAILY})"


@query("ql4_score_alerts", f"""
WITH h AS (SELECT *, lag(score) OVER w - score AS c, lag(completeness) OVER w - completeness AS k, lag(score, 2) OVER w AS first, CASE WHEN score < lag(score) OVER w THEN 1 ELSE 0 END AS f FROM ({_DIMENSIONS}) WINDOW w AS (PARTITION BY dataset ORDER BY observed_utc)),
g AS (SELECT *, sum(f) OVER (PARTITION BY dataset ORDER BY observed_utc ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) = 2 AS d FROM h)
SELECT dataset, observed_utc, score, 'SCORE_DROP' AS type, NULL AS dimension, CASE WHEN c > 20 THEN 'HIGH' ELSE 'MEDIUM' END AS severity, CAST(c AS DOUBLE) AS amount FROM g WHERE c > 10
UNION ALL SELECT dataset, observed_utc, score, 'BELOW_FLOOR', NULL, 'CRITICAL', CAST(20 - score AS DOUBLE) FROM g WHERE score < 20
UNION ALL SELECT dataset, observed_utc, score, 'ROLLING_DECLINE', NULL, 'HIGH', CAST(first - score AS DOUBLE) FROM g WHERE d
UNION ALL SELECT dataset, observed_utc, score, 'DIMENSION_DROP', 'completeness', CASE WHEN k > 22.5 THEN 'HIGH' ELSE 'MEDIUM' END, k FROM g WHERE k > 15""")
def _(t):
    return quality.score_alerts(_daily(t).withColumn("completeness", (100 - F.col("row_count") % 43).cast("double")), floor=20)


_CONTRACT = {
    "sla": {"min_rows": 10**12, "max_rows": 1},
    "schema": {"required": ["p_size", "gone"], "forbidden": ["p_type"], "columns": {"p_type": {"not_null": True, "max_length": 5}, "p_size": {"min": 1, "max": 20, "unique": True}, "p_retailprice": {"type": "string"}}},
    "null_ratio": 0.001,
}


@query("ql5_contract", f"""
SELECT 'schema' AS clause, 'gone' AS "column", 'required' AS rule, 'absent' AS actual FROM (SELECT 1) UNION ALL SELECT 'schema', 'p_type', 'forbidden', 'present' UNION ALL SELECT 'schema', 'p_retailprice', 'type', 'double'
UNION ALL SELECT 'sla', NULL, 'min_rows', CAST(count(*) AS VARCHAR) FROM {_PART} UNION ALL SELECT 'sla', NULL, 'max_rows', CAST(count(*) AS VARCHAR) FROM {_PART}
UNION ALL SELECT 'schema', 'p_type', 'not_null', CAST(count(*) FILTER (p_type IS NULL) AS VARCHAR) FROM {_PART} UNION ALL SELECT 'schema', 'p_type', 'max_length', CAST(count(*) FILTER (length(p_type) > 5) AS VARCHAR) FROM {_PART}
UNION ALL SELECT 'schema', 'p_size', 'max', CAST(count(*) FILTER (p_size > 20) AS VARCHAR) FROM {_PART} UNION ALL SELECT 'schema', 'p_size', 'unique', CAST(count(*) - count(DISTINCT p_size) AS VARCHAR) FROM {_PART}
UNION ALL SELECT 'rules', NULL, 'null_ratio', CAST(round(count(*) FILTER (p_type IS NULL) / (3 * count(*)), 6) AS VARCHAR) FROM {_PART}""")
def _(t):
    return quality.check_contract(_part(t), _CONTRACT).select("clause", "column", "rule", "actual")


@query("ql6_build_suite", f"SELECT 'p_size' AS \"column\", e AS expectation, CASE WHEN e = 'between' THEN lo END AS lo, CASE WHEN e = 'between' THEN hi END AS hi FROM (SELECT min(p_size) - (max(p_size) - min(p_size)) / 2.0 AS lo, max(p_size) + (max(p_size) - min(p_size)) / 2.0 AS hi FROM part), (VALUES ('exists'), ('not_null'), ('between')) v(e) UNION ALL SELECT 'p_type', 'exists', NULL, NULL FROM (SELECT count(*) FROM {_PART})")
def _(t):
    return quality.build_suite(_part(t).select("p_size", "p_type"))


_SUITE = [{"column": "p_type", "rule": "not_null"}, {"column": "p_size", "rule": "between", "value": [1, 40]}, {"column": "p_size", "rule": "unique"}, {"rule": "min_rows", "value": 10}, {"column": "p_type", "rule": "pattern", "value": "^[A-Z]"}]


@query("ql7_ql8_run_suite", f"""
SELECT 'p_type:not_null' AS expectation, count(*) FILTER (p_type IS NULL) = 0 AS passed, count(*) FILTER (p_type IS NULL) AS observed FROM {_PART} UNION ALL SELECT 'p_size:between', count(*) FILTER (p_size NOT BETWEEN 1 AND 40) = 0, count(*) FILTER (p_size NOT BETWEEN 1 AND 40) FROM {_PART}
UNION ALL SELECT 'p_size:unique', count(*) = count(DISTINCT p_size), count(*) - count(DISTINCT p_size) FROM {_PART} UNION ALL SELECT 'table:min_rows', count(*) >= 10, count(*) FROM {_PART}
UNION ALL SELECT 'p_type:pattern', count(*) FILTER (NOT regexp_matches(p_type, '^[A-Z]')) = 0, count(*) FILTER (NOT regexp_matches(p_type, '^[A-Z]')) FROM {_PART}""")
def _(t):
    return quality.run_suite(_part(t), _SUITE)[0]


@query("ql8_failing_rows", f"SELECT p_size, p_retailprice FROM {_PART} WHERE p_type IS NULL OR p_size > 40 OR p_size < 1 OR p_type = ''")
def _(t):
    return quality.run_suite(_part(t), _SUITE)[1].select("p_size", "p_retailprice")


@query("ql9_expectations", f"SELECT 'p_size' AS \"column\", 'distinct' AS rule, CAST(NULL AS DOUBLE) AS lo, CAST(count(DISTINCT p_size) AS DOUBLE) AS hi FROM part WHERE (SELECT count(DISTINCT p_size) <= 60 FROM part) UNION ALL SELECT 'p_size', 'null_rate', NULL, 0.05 FROM (SELECT 1) UNION ALL SELECT 'p_size', 'range', round(min(p_size) - (max(p_size) - min(p_size)) * 0.1, 4), round(max(p_size) + (max(p_size) - min(p_size)) * 0.1, 4) FROM part UNION ALL SELECT 'p_size', 'rows', floor(count(*) * 0.5), count(*) * 2 FROM part")
def _(t):
    return quality.expectations_from_profile(quality.profile_columns(t.part, ["p_size"]), few=60)


@query("ql10_freshness", "SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS newest, CASE WHEN epoch(TIMESTAMP '2024-02-05' - max(ts)) / 3600 >= 72 THEN 'HIGH' WHEN epoch(TIMESTAMP '2024-02-05' - max(ts)) / 3600 > 24 THEN 'MEDIUM' ELSE 'OK' END AS severity FROM events")
def _(t):
    return quality.freshness(t.events, "ts", "2024-02-05 00:00:00", 24).select("newest", "severity")


@query("ql11_volume", f"SELECT dataset, observed_utc, CASE WHEN d > 1.0 THEN 'HIGH' WHEN d > 0.5 THEN 'MEDIUM' ELSE 'OK' END AS severity FROM (SELECT *, abs(row_count - b) / b AS d FROM (SELECT *, avg(row_count) OVER (PARTITION BY dataset ORDER BY observed_utc ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS b FROM ({_DAILY})))")
def _(t):
    return quality.volume_alerts(_daily(t)).select("dataset", "observed_utc", "severity")


_HALVES = "SELECT {k} AS k, value, value * 1e-6 AS small, CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN value * 1e-6 + 2e-5 ELSE value * 1e-6 END AS moved, CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN 1e6 + value ELSE value END AS far, 3 AS same FROM events WHERE ts {op} TIMESTAMP '2024-01-16'"
_DRIFT = """SELECT '{c}' AS "column", round(abs(a.m - b.m) / greatest(a.s, b.s, 1e-10), 4) AS drift, CASE WHEN abs(a.m - b.m) / greatest(a.s, b.s, 1e-10) > 2 THEN 'HIGH' WHEN abs(a.m - b.m) / greatest(a.s, b.s, 1e-10) > 1 THEN 'MEDIUM' ELSE 'OK' END AS severity
 FROM (SELECT avg({c}) AS m, stddev_samp({c}) AS s FROM ({x})) a, (SELECT avg({c}) AS m, stddev_samp({c}) AS s FROM ({y})) b WHERE a.s > 0 OR b.s > 0"""


@query("ql12_mean_drift", " UNION ALL ".join(_DRIFT.format(c=c, x=_HALVES.format(k=1, op=">="), y=_HALVES.format(k=0, op="<")) for c in ("value", "small", "moved", "far", "same")))
def _(t):
    """The same column at two scales, one that moved by a small number, one that moved far, one that never varies."""
    rows = t.events.selectExpr("ts", "value", "value * 1e-6D as small", "case when ts >= '2024-01-16' then value * 1e-6D + 2e-5D else value * 1e-6D end as moved", "case when ts >= '2024-01-16' then 1e6D + value else value end as far", "3 as same")
    now, before = (quality.column_statistics(rows.filter(w), ["value", "small", "moved", "far", "same"], digits=None, parts=("numbers",)) for w in ("ts >= '2024-01-16'", "ts < '2024-01-16'"))
    return quality.mean_drift(now, before)


@query("ql13_null_alerts", f"""
WITH r AS (SELECT count(*) FILTER (p_type IS NULL) / count(*) AS t, count(*) FILTER (p_size % 5 > 0) / count(*) AS s, count(*) FILTER (p_size % 3 > 0) / count(*) AS w FROM {_PART})
SELECT 'gone' AS "column", 'NULL_FLOOR' AS alert, 'HIGH' AS severity, CAST(NULL AS DOUBLE) AS previous_rate, 1.0 AS null_rate
UNION ALL SELECT 'often', 'NULL_FLOOR', 'HIGH', NULL, round(s, 4) FROM r WHERE s > 0.5
UNION ALL SELECT 'p_type', 'NULL_SPIKE', 'MEDIUM', -0.2, round(t, 4) FROM r WHERE t + 0.2 > 0.2 AND t + 0.2 <= 0.4
UNION ALL SELECT 'risen', 'NULL_SPIKE', 'HIGH', 0.4, round(w, 4) FROM r WHERE w - 0.4 > 0.2""")
def _(t):
    rows = _part(t).selectExpr("p_type", "p_size", "if(p_size % 5 > 0, null, 1) as often", "if(p_size % 3 > 0, null, 1) as risen")
    return quality.null_alerts(rows, ["gone", "often", "p_type", "risen", "p_size"], previous={"p_type": -0.2, "risen": 0.4, "p_size": 0.0})


_OBSERVED = """SELECT 'part' AS dataset, '2024-01-01' AS observed_utc, count(*) AS row_count, 6 AS column_count, '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS nulls, {m} AS mean, {s} AS std FROM part"""


@query("ql14_observe", " UNION ALL ".join(_OBSERVED.format(c=c, m=f"round(avg({c}), 4)" if n else "NULL", s=f"round(stddev_samp({c}), 4)" if n else "NULL") for c, n in (("p_retailprice", 1), ("p_size", 1), ("p_type", 0))))
def _(t):
    row = quality.observe(t.part, "part", "2024-01-01", ["p_size", "p_retailprice", "p_type"])
    return row.select("dataset", "observed_utc", "row_count", "column_count", F.explode("column_stats").alias("x")).select("dataset", "observed_utc", "row_count", "column_count", "x.*")


_BY_TYPE = "SELECT event_type AS dataset, CASE WHEN event_id % 4 = 0 THEN NULL ELSE value END AS value, CASE WHEN event_id % 10 = 0 THEN NULL ELSE user_id END AS user_id, ts FROM events"


@query("ql15_baseline", f"""
WITH n AS (SELECT dataset, count(*) AS rows, count(*) FILTER (value IS NULL) / count(*) AS v, count(*) FILTER (user_id IS NULL) / count(*) AS u FROM ({_BY_TYPE}) GROUP BY 1),
b AS (SELECT *, CASE WHEN length(dataset) % 2 = 0 THEN 2 * rows ELSE rows END AS e, CASE WHEN length(dataset) % 2 = 0 THEN NULL ELSE 0.0 END AS rt, CASE WHEN length(dataset) % 2 = 0 THEN NULL ELSE 0.3 END AS nt FROM n)
SELECT dataset, 'ROW_COUNT' AS "check", NULL AS "column", CAST(e AS DOUBLE) AS expected, CAST(rows AS DOUBLE) AS actual FROM b WHERE rows < e * (1 - coalesce(rt, 0.2)) OR rows > e * (1 + coalesce(rt, 0.2))
UNION ALL SELECT dataset, 'NULL_RATE', 'value', 0.0, v FROM b WHERE v > coalesce(nt, 0.05)
UNION ALL SELECT dataset, 'NULL_RATE', 'user_id', 0.5, u FROM b WHERE abs(u - 0.5) > coalesce(nt, 0.05)""")
def _(t):
    """Even names: twice the rows are expected, default tolerances. Odd ones: their own tolerances. A column that is not there is not compared."""
    rows = t.events.selectExpr("event_type as dataset", "case when event_id % 4 = 0 then null else value end as value", "case when event_id % 10 = 0 then null else user_id end as user_id", "ts")
    now = quality.null_rates(rows, "dataset")
    even = "length(dataset) % 2 = 0"
    baseline = now.selectExpr("dataset", f"case when {even} then 2 * rows else rows end as expected_rows", "map('value', 0.0D, 'user_id', 0.5D, 'gone', 0.0D) as null_rates", f"case when {even} then null else 0.0D end as row_tolerance", f"case when {even} then null else 0.3D end as null_tolerance")
    return quality.baseline_anomalies(now, baseline)


@query("ql16_exposition", "SELECT 'table_rows' AS metric, 'dataset=\"part\"' AS labels, CAST(count(*) AS DOUBLE) AS value FROM part UNION ALL SELECT 'column_nulls', 'dataset=\"part\",column=\"p_size\"', CAST(count(*) FILTER (p_size IS NULL) AS DOUBLE) FROM part")
def _(t):
    return quality.exposition(quality.observe(t.part, "part", "2024-01-01", ["p_size"])).select("metric", "labels", "value")


@query("ql17_synthetic")
def _(t):
    """As many rows as the table has; the commonest values, 30 of them, by their counts."""
    top = [(r["p_brand"], r["count"]) for r in t.part.groupBy("p_brand").count().orderBy(F.desc("count"), "p_brand").limit(30).collect()]
    return quality.synthesise(t.spark, quality.column_statistics(t.part, ["p_size", "p_retailprice", "p_brand", "p_name"]), t.part.count(), {"p_brand": top}, seed=1)


@query("ql18_gate", "SELECT * FROM (VALUES ('schema', 1, 'WARN'), ('baseline', 1, 'WARN'), ('purpose', 2, 'FAIL'), ('contract', 0, 'PASS')) v(\"check\", findings, status) WHERE (SELECT count(*) FROM orders) > 0")
def _(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    return steps.gate(rows, t.spark, ["o_orderkey"], {"expected_rows": rows.count(), "null_rates": {"o_orderkey": 0.0, "o_orderstatus": 0.4}}, [], {"sla": {"min_rows": 1}})


@query("governed_rows", "SELECT DISTINCT c_custkey AS customer_id, 'MASKED_' || substr(sha256(c_name), 1, 12) AS full_name, n_name AS nation, c_acctbal AS balance, 'run-1' AS _pipeline_id, '2024-01-01T00:00:00Z' AS _loaded_at_utc FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def _(t):
    """The rows of the governed load: names, masks, repeated rows and stamps; every row twice on the way in."""
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    rows = rows.select(F.col("c_custkey").alias("Customer Id"), F.col("c_name").alias("full_name"), F.col("n_name").alias("Nation"), F.col("c_acctbal").alias("balance"))
    return steps.govern(rows.unionAll(rows), "run-1", "2024-01-01T00:00:00Z")
