"""Joins, aggregates, windows, top-k, vectors and diffs (JN, AG, WN, SO, DF)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates, diffs, joins, ranges, vector_index, vectors, windows
from .registry import query


@query("jn1_enrich", "SELECT c_custkey, c_nationkey, n_name, n_regionkey FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def _(t):
    twice = t.nation.unionByName(t.nation.withColumn("n_name", F.lit("zzz")))
    return joins.enrich(t.customer, twice, "c_nationkey", "n_nationkey", ["n_name", "n_regionkey"], [F.col("n_name")]).select("c_custkey", "c_nationkey", "n_name", "n_regionkey")


@query("jn1_match_rate", "SELECT count(*) AS rows, count(*) FILTER (c_nationkey < 20) AS matched, round(count(*) FILTER (c_nationkey < 20) / count(*), 4) AS match_rate FROM customer")
def _(t):
    return joins.match_rate(t.customer, t.nation.filter("n_nationkey < 20"), "c_nationkey", "n_nationkey")


@query("jn2_enrich_all", "SELECT s_suppkey, n_name, r_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def _(t):
    nation = t.nation.withColumnsRenamed({"n_nationkey": "nk", "n_regionkey": "rk"})
    rows = joins.enrich_all(t.supplier.withColumnRenamed("s_nationkey", "nk"), [(nation, "nk"), (t.region.withColumnRenamed("r_regionkey", "rk"), "rk")])
    return rows.select("s_suppkey", "n_name", "r_name")


def _refs(t):
    return joins.check_reference(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), "l_orderkey", t.orders.filter("o_orderkey % 10 <> 0"), "o_orderkey")


@query("jn3_key_violations", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 10 <> 0)")
def _(t):
    return _refs(t)[1]


@query("jn3_clean_keys", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 10 <> 0)")
def _(t):
    return _refs(t)[0]


@query("jn4_decode_codes", "SELECT c_custkey, c_nationkey AS NATION_C, n_name AS NATION_NAME FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def _(t):
    codes = t.nation.select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("name"))
    return joins.decode_codes(t.customer.select("c_custkey", F.col("c_nationkey").alias("NATION_C")), {"NATION": codes}).select("c_custkey", "NATION_C", "NATION_NAME")


def _consents(t):
    """Two grants for every customer: the first expires, the second is withdrawn by some."""
    base = t.customer.select(joins.subject_hash(F.col("c_custkey")).alias("subject_hash"), "c_custkey")
    one = base.select("subject_hash", F.lit("marketing").alias("purpose"), F.lit("2023-01-01 00:00:00").alias("granted_utc"), F.lit("2023-12-31 00:00:00").alias("expires_utc"), F.lit(None).cast("string").alias("withdrawn_utc"), F.lit(1).alias("version"))
    two = base.filter("c_custkey % 2 = 0").select("subject_hash", F.lit("marketing").alias("purpose"), F.lit("2024-01-01 00:00:00").alias("granted_utc"), F.when(F.col("c_custkey") % 3 == 0, F.lit("2024-02-01 00:00:00")).alias("expires_utc"), F.when(F.col("c_custkey") % 5 == 0, F.lit("2024-03-01 00:00:00")).alias("withdrawn_utc"), F.lit(2).alias("version"))
    return one.unionByName(two)


_HELD = "o_custkey % 2 = 0 AND o_custkey % 3 <> 0 AND o_custkey % 5 <> 0 AND o_custkey IN (SELECT c_custkey FROM customer)"


@query("jn5_without_consent", f"SELECT o_orderkey FROM orders WHERE NOT ({_HELD})")
def _(t):
    return joins.with_consent(t.orders, "o_custkey", _consents(t), "marketing", "2024-06-01 00:00:00", without=True).select("o_orderkey")


@query("fl14_with_consent", f"SELECT o_orderkey FROM orders WHERE {_HELD}")
def _(t):
    return joins.with_consent(t.orders, "o_custkey", _consents(t), "marketing", "2024-06-01 00:00:00").select("o_orderkey")


_ACCESS = "SELECT 'orders' AS _source, CAST(o_custkey AS VARCHAR) AS subject_id, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey = 7 GROUP BY ALL UNION ALL SELECT 'customer', CAST(c_custkey AS VARCHAR), 1 FROM customer WHERE c_nationkey = 7"


def _subjects(t, hashed):
    requests = t.customer.filter("c_nationkey = 7").select(F.col("c_custkey").alias("subject_id"))
    customer = t.customer.select(joins.subject_hash(F.col("c_custkey")).alias("who"), "c_mktsegment") if hashed else t.customer.select(F.col("c_custkey").alias("who"), "c_mktsegment")
    rows = joins.subject_rows({"orders": (t.orders, "o_custkey"), "customer": (customer, "who")}, requests, hashed)
    return rows.groupBy("_source", "subject_id").agg(F.count("*").alias("n"))


@query("jn6_subject_access", _ACCESS)
def _(t):
    return _subjects(t, True)


@query("jn7_subject_export", _ACCESS)
def _(t):
    return _subjects(t, False)


_OLD = "SELECT o_orderkey, o_orderstatus, CAST(o_custkey AS BIGINT) AS o_custkey FROM orders WHERE o_orderkey % 11 <> 0"
_NEW = "SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_custkey FROM orders WHERE o_orderkey % 13 <> 0"
_DIFF = f"""SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN a.o_orderkey IS NULL THEN 'added' WHEN b.o_orderkey IS NULL THEN 'deleted' ELSE 'changed' END AS change,
 CASE WHEN a.o_orderkey IS NOT NULL AND b.o_orderkey IS NOT NULL THEN 'o_orderstatus' END AS "column",
 CASE WHEN b.o_orderkey IS NOT NULL THEN a.o_orderstatus END AS before, CASE WHEN a.o_orderkey IS NOT NULL THEN b.o_orderstatus END AS after
 FROM ({_OLD}) a FULL JOIN ({_NEW}) b ON a.o_orderkey = b.o_orderkey WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.o_orderstatus IS DISTINCT FROM b.o_orderstatus"""


def _versions(t):
    old = t.orders.filter("o_orderkey % 11 <> 0").select("o_orderkey", "o_orderstatus", "o_custkey")
    new = t.orders.filter("o_orderkey % 13 <> 0").selectExpr("o_orderkey", "case when o_orderkey % 7 = 0 then 'X' else o_orderstatus end as o_orderstatus", "o_custkey")
    return old, new


@query("jn8_df1_row_diff", _DIFF)
def _(t):
    return diffs.row_diff(*_versions(t), ["o_orderkey"])


@query("df1_diff_counts", f'SELECT change, "column", count(DISTINCT o_orderkey) AS rows FROM ({_DIFF}) GROUP BY ALL')
def _(t):
    return diffs.diff_counts(diffs.row_diff(*_versions(t), ["o_orderkey"]), ["o_orderkey"])


@query("df2_positional_diff", """
WITH a AS (SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS _place, o_orderstatus FROM orders),
b AS (SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS _place, o_orderstatus FROM orders WHERE o_orderkey % 5 <> 0)
SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, coalesce(a._place, b._place) AS _place, CASE WHEN b.o_custkey IS NULL THEN 'deleted' ELSE 'changed' END AS change,
 CASE WHEN b.o_custkey IS NOT NULL THEN 'o_orderstatus' END AS "column", CASE WHEN b.o_custkey IS NOT NULL THEN a.o_orderstatus END AS before, b.o_orderstatus AS after
FROM a FULL JOIN b ON a.o_custkey = b.o_custkey AND a._place = b._place WHERE b.o_custkey IS NULL OR a.o_orderstatus IS DISTINCT FROM b.o_orderstatus""")
def _(t):
    keep = ["o_custkey", "o_orderkey", "o_orderstatus"]
    old, new = t.orders.select(*keep), t.orders.filter("o_orderkey % 5 <> 0").select(*keep)
    return diffs.positional_diff(old, new, [F.col("o_orderkey")], ["o_custkey"]).filter("column is null or column <> 'o_orderkey'")


@query("df3_version_diff", """
SELECT 'o_orderstatus' AS "column", 0 AS nulls_a, 0 AS nulls_b, (SELECT count(DISTINCT o_orderstatus) FROM orders) AS distinct_a, (SELECT count(DISTINCT o_orderstatus) + 1 FROM orders) AS distinct_b, 1 AS added, 0 AS removed
UNION ALL SELECT 'o_custkey', 0, 0, (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_orderkey % 11 <> 0), (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_orderkey % 13 <> 0),
 (SELECT count(*) FROM (SELECT o_custkey FROM orders WHERE o_orderkey % 13 <> 0 EXCEPT SELECT o_custkey FROM orders WHERE o_orderkey % 11 <> 0)),
 (SELECT count(*) FROM (SELECT o_custkey FROM orders WHERE o_orderkey % 11 <> 0 EXCEPT SELECT o_custkey FROM orders WHERE o_orderkey % 13 <> 0))""")
def _(t):
    return diffs.version_diff(*_versions(t), ["o_orderstatus", "o_custkey"])


@query("df4_schema_diff", "SELECT * FROM (VALUES ('o_extra', 'added'), ('o_custkey', 'removed')) v(\"column\", status) WHERE (SELECT count(*) FROM orders) > 0")
def _(t):
    return diffs.schema_diff(t.spark, t.orders.columns, t.orders.withColumn("o_extra", F.lit(1)).drop("o_custkey").columns)


@query("df5_evolution_plan", "SELECT * FROM (VALUES ('o_extra', 'add', NULL, 'TEXT'), ('o_custkey', 'drop', 'BIGINT', NULL), ('o_totalprice', 'drift', 'DOUBLE PRECISION', 'TEXT')) v(\"column\", step, from_type, to_type) WHERE (SELECT count(*) FROM orders) > 0")
def _(t):
    new = t.orders.withColumn("o_extra", F.lit("x")).withColumn("o_totalprice", F.col("o_totalprice").cast("string")).drop("o_custkey")
    return diffs.evolution_plan(t.spark, t.orders.schema, new.schema, drop_missing=True)


@query("df5_evolve", "SELECT s_suppkey, s_name, NULL AS note FROM supplier UNION ALL SELECT s_suppkey, s_name, 'new' FROM supplier")
def _(t):
    return diffs.evolve(t.supplier.select("s_suppkey", "s_name"), t.supplier.select("s_suppkey", "s_name", F.lit("new").alias("note")))


@query("jn9_concept_ids", "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_size * 100 ELSE 0 END AS concept_id FROM part")
def _(t):
    concepts = t.part.filter("p_size % 2 = 0").select(F.col("p_size").cast("string").alias("source_code"), F.lit("SIZE").alias("source_vocabulary_id"), (F.col("p_size") * 100).alias("concept_id"))
    return joins.concept_ids(t.part.withColumn("code", F.col("p_size").cast("string")), "code", "SIZE", concepts, "concept_id").select("p_partkey", "concept_id")


@query("jn10_dated_details", "SELECT o_orderkey, l_linenumber, l_partkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderdate BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1996-12-31'")
def _(t):
    return joins.dated_details(t.orders, t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "o_orderdate", "1995-01-01", "1996-12-31").select("o_orderkey", "l_linenumber", "l_partkey")


# --- aggregates ----------------------------------------------------------------------------------------------


@query("ag1_aggregate", "SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty_sum, min(CAST(l_quantity AS BIGINT)) AS qty_min, max(CAST(l_quantity AS BIGINT)) AS qty_max, count(DISTINCT l_partkey) AS l_partkey FROM lineitem WHERE l_returnflag <> 'R' GROUP BY ALL")
def _(t):
    rows = t.lineitem.selectExpr("nullif(l_returnflag, 'R') as l_returnflag", "l_linestatus", "cast(l_quantity as bigint) as qty", "l_partkey")
    return aggregates.aggregate(rows, ["l_returnflag", "l_linestatus"], {"qty": ["sum", "min", "max"], "l_partkey": "nunique"})


@query("ag2_distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def _(t):
    return aggregates.distinct_rows(t.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber"))


for _keep, _test in (("first", "n = 1"), ("last", "m = 1"), (False, "c = 1")):

    @query(f"ag3_keep_{_keep or 'none'}".lower(), f"SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS m, count(*) OVER (PARTITION BY o_custkey) AS c FROM orders) WHERE {_test}")
    def _(t, keep=_keep):
        return aggregates.deduplicate(t.orders.select("o_custkey", "o_orderkey"), ["o_custkey"], keep, [F.col("o_orderkey")])


@query("ag4_duplicate_rows", "SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(sum(n) - count(*) AS BIGINT) AS duplicates FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)")
def _(t):
    return aggregates.duplicate_rows(t.lineitem.select("l_orderkey", "l_linenumber"))


_KEYS = """SELECT '{name}' AS case, CAST(sum(n) AS BIGINT) AS rows, CAST(sum(n) - count(*) AS BIGINT) AS duplicate_count, round((sum(n) - count(*)) / sum(n), 6) AS duplicate_rate, NULL AS missing,
 CASE WHEN sum(n) = count(*) THEN 'OK' WHEN round((sum(n) - count(*)) / sum(n), 6) > 0.05 OR round((sum(n) - count(*)) / sum(n), 6) - {before} > 0.01 THEN 'HIGH' ELSE 'MEDIUM' END AS severity FROM (SELECT count(*) AS n FROM {table} GROUP BY {keys})"""
_FEW = "(SELECT o_orderkey FROM orders UNION ALL SELECT o_orderkey FROM orders WHERE o_orderkey % 30 = 0)"


@query("ag5_duplicate_keys", " UNION ALL ".join([
    _KEYS.format(name="many", before=1, table="lineitem", keys="l_orderkey, l_linenumber"), _KEYS.format(name="few", before=1, table=_FEW, keys="o_orderkey"),
    _KEYS.format(name="rising", before=0.0, table=_FEW, keys="o_orderkey"), _KEYS.format(name="none", before=0.0, table="orders", keys="o_orderkey"),
    "SELECT 'absent', count(*), NULL, NULL, 'gone', 'HIGH' FROM orders",
]))
def _(t):
    few = t.orders.select("o_orderkey").unionAll(t.orders.select("o_orderkey").filter("o_orderkey % 30 = 0"))
    found = {
        "many": aggregates.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"]),
        "few": aggregates.duplicate_keys(few, ["o_orderkey"]),
        "rising": aggregates.duplicate_keys(few, ["o_orderkey"], previous=0.0),
        "none": aggregates.duplicate_keys(t.orders, ["o_orderkey"]),
        "absent": aggregates.duplicate_keys(t.orders, ["o_orderkey", "gone"]),
    }
    every = [df.select(F.lit(name).alias("case"), "*") for name, df in found.items()]
    out = every[0]
    for df in every[1:]:
        out = out.unionByName(df)
    return out


@query("ag6_k_anonymity", "SELECT count(*) AS groups, min(n) AS smallest, count(*) FILTER (n < 5) AS groups_at_risk, CAST(coalesce(sum(n) FILTER (n < 5), 0) AS BIGINT) AS rows_at_risk FROM (SELECT count(*) AS n FROM part GROUP BY p_brand, p_size)")
def _(t):
    return aggregates.anonymity(t.part, ["p_brand", "p_size"])


@query("ag7_l_diversity", "SELECT p_brand, p_size, count(*) AS group_rows, count(DISTINCT p_type) AS sensitive_values FROM part GROUP BY ALL HAVING count(*) < 3 OR count(DISTINCT p_type) < 2")
def _(t):
    return aggregates.risky_groups(t.part, ["p_brand", "p_size"], 3, "p_type", 2)


@query("ag8_suppress", "SELECT p_partkey FROM part WHERE (p_brand, p_size) NOT IN (SELECT (p_brand, p_size) FROM part GROUP BY p_brand, p_size HAVING count(*) < 3)")
def _(t):
    return aggregates.enforce_anonymity(t.part, ["p_brand", "p_size"], 3).select("p_partkey")


@query("ag11_alert_rollup", "SELECT event_type AS dataset, CASE WHEN value > 50 THEN 'VOLUME' ELSE 'DRIFT' END AS type, CASE WHEN user_id % 2 = 0 THEN 'HIGH' ELSE 'LOW' END AS severity, count(*) AS alerts FROM events GROUP BY ROLLUP (1, 2, 3)")
def _(t):
    rows = t.events.selectExpr("event_type as dataset", "case when value > 50 then 'VOLUME' else 'DRIFT' end as type", "case when user_id % 2 = 0 then 'HIGH' else 'LOW' end as severity")
    return aggregates.alert_summary(rows)


def _runs(t):
    return t.orders.selectExpr("o_orderkey as run_id", "o_orderpriority as platform", "cast(o_orderdate as string) as started", "cast(o_orderkey % 97 as double) as seconds", "cast(o_custkey % 13 as double) as gb")


def _prices(t):
    return t.orders.select(F.col("o_orderpriority").alias("platform")).distinct().select("platform", (F.length("platform") * 0.36).alias("per_hour"), F.lit(0.5).alias("per_gb"))


_COST = "SELECT o_orderkey AS run_id, o_orderpriority AS platform, o_orderdate AS started, round(CAST(o_orderkey % 97 AS DOUBLE) / 3600 * CAST(length(o_orderpriority) * CAST(0.36 AS DOUBLE) AS DOUBLE) + CAST(o_custkey % 13 AS DOUBLE) * CAST(0.5 AS DOUBLE), 6) AS cost FROM orders"


@query("ag12_run_costs", f"SELECT run_id, platform, cost FROM ({_COST})")
def _(t):
    return aggregates.run_costs(_runs(t), _prices(t)).select("run_id", "platform", "cost")


@query("ag12_cost_by_platform", f"SELECT platform, count(*) AS runs, round(sum(cost), 4) AS total, min_by(run_id, (cost, run_id)) AS cheapest, max_by(run_id, (cost, run_id)) AS dearest FROM ({_COST}) GROUP BY platform")
def _(t):
    return aggregates.cost_by_platform(aggregates.run_costs(_runs(t), _prices(t)))


@query("ag12_cumulative", f"SELECT run_id, round(sum(cost) OVER (PARTITION BY platform ORDER BY started, run_id ROWS UNBOUNDED PRECEDING), 6) AS cumulative FROM ({_COST})")
def _(t):
    return aggregates.cumulative_costs(aggregates.run_costs(_runs(t), _prices(t))).select("run_id", "cumulative")


@query("ag12_monthly", f"SELECT platform, round(avg(cost) * 24 * 30, 3) AS monthly FROM ({_COST}) GROUP BY platform")
def _(t):
    return aggregates.monthly_projection(aggregates.run_costs(_runs(t), _prices(t)), 24).select("platform", F.round("monthly", 3).alias("monthly"))


@query("ag14_consent_register", "SELECT CASE WHEN v = 2 AND c % 5 = 0 THEN 'withdrawn' WHEN v = 1 OR c % 3 = 0 THEN 'expired' ELSE 'active' END AS status, count(*) AS records FROM (SELECT c_custkey AS c, 1 AS v FROM customer UNION ALL SELECT c_custkey, 2 FROM customer WHERE c_custkey % 2 = 0) GROUP BY 1")
def _(t):
    return aggregates.consent_register(_consents(t), "2024-06-01 00:00:00")


@query("ag15_track_record", "SELECT count(*) AS runs, count(*) FILTER (value > 20) AS passed, round(avg(CASE WHEN value > 20 THEN 1 ELSE 0 END), 4) AS pass_rate, max_by(CASE WHEN value > 20 THEN 'PASS' ELSE 'FAIL' END, event_id) AS last_status FROM events")
def _(t):
    return aggregates.track_record(t.events.selectExpr("event_id as run_utc", "case when value > 20 then 'PASS' else 'FAIL' end as status"))


@query("ag16_run_metrics", "SELECT event_type AS stage, count(*) AS rows_in, count(*) FILTER (value > 1) AS rows_out, count(*) FILTER (value <= 1) AS rejects, CAST(4 AS DOUBLE) AS seconds, round(count(*) FILTER (value <= 1) / count(*), 6) AS error_rate, round(count(*) / 4, 3) AS rows_per_s FROM events GROUP BY event_type")
def _(t):
    stages = t.events.groupBy(F.col("event_type").alias("stage")).agg(F.count("*").alias("rows_in"), F.count_if(F.col("value") > 1).alias("rows_out"), F.count_if(F.col("value") <= 1).alias("rejects"), F.lit(4.0).alias("seconds"))
    return aggregates.run_metrics(stages)


# --- windows, sorting, top-k ---------------------------------------------------------------------------------

_GAPS = "SELECT event_id, user_id, ts, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_type END AS event_type FROM events"


@query("wn1_fill_forward", f"SELECT event_id, last_value(event_type IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS event_type FROM ({_GAPS})")
def _(t):
    rows = t.events.selectExpr("event_id", "user_id", "ts", "case when event_id % 3 = 0 then null else event_type end as event_type")
    return windows.fill_along(rows, ["event_type"], "forward", [F.col("ts"), F.col("event_id")], ["user_id"]).select("event_id", "event_type")


@query("wn1_fill_backward", f"SELECT event_id, first_value(event_type IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS event_type FROM ({_GAPS})")
def _(t):
    rows = t.events.selectExpr("event_id", "user_id", "ts", "case when event_id % 3 = 0 then null else event_type end as event_type")
    return windows.fill_along(rows, ["event_type"], "backward", [F.col("ts"), F.col("event_id")], ["user_id"]).select("event_id", "event_type")


_WHOLE = "SELECT event_id, user_id, event_type, ts, CASE WHEN event_id % 7 > 0 THEN NULL ELSE user_id END AS last_user, CASE WHEN event_id % 5 > 0 THEN NULL ELSE value END AS last_value FROM events"


def _whole(t):
    return t.events.selectExpr("event_id", "user_id", "event_type", "ts", "case when event_id % 7 > 0 then null else user_id end as last_user", "case when event_id % 5 > 0 then null else value end as last_value")


@query("wn1_fill_forward_whole", f"SELECT event_id, last_value(last_user IGNORE NULLS) OVER w AS last_user, last_value(last_value IGNORE NULLS) OVER w AS last_value FROM ({_WHOLE}) WINDOW w AS (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)")
def _(t):
    return windows.fill_along(_whole(t), ["last_user", "last_value"], "forward", [F.col("ts"), F.col("event_id")]).select("event_id", "last_user", "last_value")


@query("wn1_fill_backward_whole", f"SELECT event_id, first_value(last_user IGNORE NULLS) OVER w AS last_user, first_value(last_value IGNORE NULLS) OVER w AS last_value FROM ({_WHOLE}) WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)")
def _(t):
    return windows.fill_along(_whole(t), ["last_user", "last_value"], "backward", [F.col("ts"), F.col("event_id")]).select("event_id", "last_user", "last_value")


@query("wn1_fill_hot_keys", f"SELECT event_id, last_value(last_user IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts DESC, event_id ROWS UNBOUNDED PRECEDING) AS last_user FROM ({_WHOLE})")
def _(t):
    """A few keys hold all rows: each is filled over many ranges."""
    return ranges.fill_ranges(_whole(t), ["last_user"], "forward", [F.desc("ts"), F.col("event_id")], ["event_type"]).select("event_id", "last_user")


@query("df2_positional_diff_whole", """
WITH a AS (SELECT row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS _place, o_orderkey, o_orderstatus FROM orders),
b AS (SELECT row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS _place, o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 50 <> 0),
p AS (SELECT coalesce(a._place, b._place) AS _place, a._place AS pa, b._place AS pb, CAST(a.o_orderkey AS VARCHAR) AS ka, CAST(b.o_orderkey AS VARCHAR) AS kb, a.o_orderstatus AS sa, b.o_orderstatus AS sb FROM a FULL JOIN b ON a._place = b._place)
SELECT _place, 'deleted' AS change, NULL AS "column", NULL AS before, NULL AS after FROM p WHERE pb IS NULL
UNION ALL SELECT _place, 'changed', 'o_orderkey', ka, kb FROM p WHERE pb IS NOT NULL AND ka <> kb
UNION ALL SELECT _place, 'changed', 'o_orderstatus', sa, sb FROM p WHERE pb IS NOT NULL AND sa IS DISTINCT FROM sb""")
def _(t):
    keep = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    old, new = (ranges.number_rows(rows.select(*keep), [F.col("o_totalprice"), F.col("o_orderkey")]).drop("o_totalprice") for rows in (t.orders, t.orders.filter("o_orderkey % 50 <> 0")))
    return diffs.row_diff(old, new, ["_place"])


_DAILY = "SELECT event_type AS dataset, strftime(ts, '%Y-%m-%d') AS observed_utc, count(*) AS row_count, CAST(count(*) % 50 AS BIGINT) AS score FROM events GROUP BY ALL"


def _daily(t):
    return t.events.groupBy(F.col("event_type").alias("dataset"), F.date_format("ts", "yyyy-MM-dd").alias("observed_utc")).agg(F.count("*").alias("row_count"), (F.count("*") % 50).alias("score"))


@query("wn2_rolling_decline", f"SELECT dataset, observed_utc, sum(f) OVER (PARTITION BY dataset ORDER BY observed_utc ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) = 2 AS declining FROM (SELECT *, CASE WHEN score < lag(score) OVER (PARTITION BY dataset ORDER BY observed_utc) THEN 1 ELSE 0 END AS f FROM ({_DAILY}))")
def _(t):
    return windows.rolling_decline(_daily(t)).select("dataset", "observed_utc", "declining")


@query("wn3_latest", "SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def _(t):
    return windows.latest(t.events, ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id")


@query("wn4_previous_run", f"SELECT dataset, observed_utc, score - lag(score) OVER (PARTITION BY dataset ORDER BY observed_utc) AS score_change FROM ({_DAILY})")
def _(t):
    return windows.against_previous(_daily(t), ["dataset"], "observed_utc", ["score"]).select("dataset", "observed_utc", "score_change")


@query("wn5_volume_baseline", f"SELECT dataset, observed_utc, round(avg(row_count) OVER (PARTITION BY dataset ORDER BY observed_utc ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), 4) AS baseline FROM ({_DAILY})")
def _(t):
    return windows.volume_baseline(_daily(t)).select("dataset", "observed_utc", F.round("baseline", 4).alias("baseline"))


@query("wn7_stage_durations", "SELECT event_id, round(epoch_us(ts) / 1e6 - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) / 1e6, 3) AS seconds FROM events")
def _(t):
    rows = t.events.select(F.col("user_id").alias("pipeline_id"), "event_id", F.col("ts").alias("timestamp_utc"))
    return windows.stage_durations(rows).select("event_id", F.round("seconds", 3).alias("seconds"))


@query("wn8_newest", f"SELECT dataset, observed_utc, row_count FROM (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY observed_utc DESC) AS n FROM ({_DAILY})) WHERE n <= 3")
def _(t):
    return windows.newest(_daily(t), 3, ["dataset"]).select("dataset", "observed_utc", "row_count")


@query("so1_sort", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_mktsegment DESC, c_acctbal")
def _(t):
    return windows.sort(t.customer, ["c_mktsegment", "absent", "c_acctbal"], [False, True, True]).select("c_custkey", "c_acctbal")


@query("so2_top_values", "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY \"column\" ORDER BY count DESC, value) AS rank FROM (SELECT 'o_orderstatus' AS \"column\", o_orderstatus AS value, count(*) AS count FROM orders GROUP BY ALL UNION ALL SELECT 'o_custkey', CAST(o_custkey AS VARCHAR), count(*) FROM orders GROUP BY ALL)) WHERE rank <= 10")
def _(t):
    return windows.top_values(t.orders, ["o_orderstatus", "o_custkey"])


_COS = "1 - list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))"


@query("so3_nearest", "SELECT vec_id, round(1 - list_cosine_similarity(CAST(embedding AS DOUBLE[]), list_transform(range(64), lambda i: CAST(i + 1 AS DOUBLE) / 64)), 6) AS distance FROM embeddings ORDER BY 1 - list_cosine_similarity(CAST(embedding AS DOUBLE[]), list_transform(range(64), lambda i: CAST(i + 1 AS DOUBLE) / 64)), vec_id LIMIT 10")
def _(t):
    return vectors.nearest(t.embeddings, [(i + 1) / 64 for i in range(64)], "embedding", "vec_id").select("vec_id", F.round("distance", 6).alias("distance"))


@query("so3_nearest_each", f"SELECT query, vec_id, CAST(rank AS BIGINT) AS rank FROM (SELECT a.vec_id AS query, b.vec_id, row_number() OVER (PARTITION BY a.vec_id ORDER BY {_COS}, b.vec_id) AS rank FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0) WHERE rank <= 5")
def _(t):
    found = vectors.nearest_each(t.embeddings, t.embeddings.filter("vec_id % 50 = 0"), "embedding", "vec_id", 5)
    return found.select("query", "vec_id", F.col("rank").cast("long").alias("rank"))


def _indexed(t, k=10):
    path = t.folder()
    asked = t.embeddings.filter("vec_id % 50 = 0")
    vector_index.build_index(t.embeddings, "embedding", "vec_id", path)
    return path, asked, t.keep(vector_index.search_index(t.spark, path, asked, "embedding", "vec_id", k))


@query("so4_indexed_nearest")
def _(t):
    return _indexed(t)[2]


@query("so4_index_recall", f"""SELECT count(*) AS queries, true AS enough, true AS distances_agree, true AS fewer_rows_read FROM (SELECT DISTINCT a.vec_id FROM embeddings a WHERE a.vec_id % 50 = 0)""")
def _(t):
    """queries; whether 0.9 of the exact 10 nearest are found, with their distances; whether a part of the rows is read for it (0.9 at most)."""
    path, asked, found = _indexed(t)
    exact = vectors.nearest_each(t.embeddings, asked, "embedding", "vec_id", 10).select("query", "vec_id", F.col("distance").alias("_d"))
    both = exact.join(found, ["query", "vec_id"], "left").agg(F.avg(F.col("distance").isNotNull().cast("int")).alias("recall"), F.max(F.abs(F.col("distance") - F.col("_d"))).alias("off"))
    read = vector_index.rows_read(t.spark, path, vector_index.probed(t.spark, path, asked, "embedding", "vec_id")).agg(F.count("*").alias("queries"), F.avg(F.col("rows_read") / F.col("rows")).alias("share"))
    return both.crossJoin(read).select("queries", (F.col("recall") >= 0.9).alias("enough"), (F.col("off") < 1e-9).alias("distances_agree"), (F.col("share") <= 0.9).alias("fewer_rows_read"))


@query("so4_approximate_nearest")
def _(t):
    return vectors.approximate_nearest(t.embeddings, t.embeddings.filter("vec_id % 50 = 0"), "embedding", "vec_id", 5)
