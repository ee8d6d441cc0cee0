"""Columns and filters (XF, FL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names, values
from ..operators import columns, filters
from ..plans import steps
from .registry import query

_MIXED = "case when c_custkey % 5 = 0 then 'n/a' when c_custkey % 7 = 0 then null else cast(c_custkey as {t}) end"


@query("xf1_flatten_props", "SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS props__k FROM events")
def _(t):
    rows = t.events.select("event_id", "event_type", F.from_json("props", "k long").alias("props"))
    return columns.flatten(rows)


@query("xf1_flatten_arrays", "SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS head__0, CAST(embedding[2] AS DOUBLE) AS head__1, label AS meta__label FROM embeddings")
def _(t):
    rows = t.embeddings.select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("head"), F.struct("label").alias("meta"))
    return columns.flatten(rows).select("vec_id", "head__0", "head__1", "meta__label")


@query("xf1_flatten_embedding", "SELECT vec_id, " + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS embedding__{i}" for i in range(64)) + " FROM embeddings")
def _(t):
    return columns.flatten(t.embeddings.select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("embedding")))


@query("xf2_sanitise_names", 'SELECT c_custkey AS customer_key, c_name AS full_name, c_acctbal AS full_name_2 FROM customer')
def _(t):
    return names.sanitise_all(t.customer.select(F.col("c_custkey").alias("Customer Key"), F.col("c_name").alias("Full-Name"), F.col("c_acctbal").alias("full name ")))


@query("xf3_drop_columns", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def _(t):
    return columns.drop_columns(t.customer, ["c_nationkey", "c_acctbal", "absent"])


@query("xf4_rename", "SELECT c_custkey AS id, c_name AS name, c_nationkey FROM customer")
def _(t):
    return columns.rename(t.customer, {"c_custkey": "id", "c_name": "name", "absent": "x"}).select("id", "name", "c_nationkey")


@query("xf5_coerce", """
SELECT c_custkey, TRY_CAST(a AS BIGINT) AS a, TRY_CAST(b AS DOUBLE) AS b, coalesce(c, '') AS c,
 CASE WHEN lower(trim(d)) IN ('true','1','yes','y') THEN true WHEN lower(trim(d)) IN ('false','0','no','n') THEN false END AS d,
 strftime(try_strptime(e, '%Y-%m-%d'), '%Y-%m-%d') AS e
FROM (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'n/a' WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS a,
  CASE WHEN c_custkey % 4 = 0 THEN 'x' ELSE CAST(c_custkey AS VARCHAR) || '.5' END AS b, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS c,
  CASE c_custkey % 4 WHEN 0 THEN ' Yes' WHEN 1 THEN 'no' WHEN 2 THEN 'maybe' END AS d, CASE WHEN c_custkey % 2 = 0 THEN '2024-02-30' ELSE '2024-03-01' END AS e FROM customer)""")
def _(t):
    rows = t.customer.selectExpr("c_custkey", _MIXED.format(t="string") + " as a", "case when c_custkey % 4 = 0 then 'x' else concat(cast(c_custkey as string), '.5') end as b", "case when c_custkey % 3 = 0 then null else c_mktsegment end as c", "case c_custkey % 4 when 0 then ' Yes' when 1 then 'no' when 2 then 'maybe' end as d", "case when c_custkey % 2 = 0 then '2024-02-30' else '2024-03-01' end as e")
    return columns.coerce_columns(rows, {"a": "int", "b": "float", "c": "str", "d": "bool", "e": "date"})


@query("xf6_coercion_failures", "SELECT 'a' AS \"column\", count(*) FILTER (c_custkey % 5 = 0) AS failures FROM customer UNION ALL SELECT 'b', count(*) FILTER (c_custkey % 4 = 0) FROM customer")
def _(t):
    rows = t.customer.selectExpr(_MIXED.format(t="string") + " as a", "case when c_custkey % 4 = 0 then 'x' else '1.5' end as b")
    return columns.coercion_failures(rows, {"a": "int", "b": "float"})


@query("xf7_cast_whole", "SELECT c_custkey, CAST(c_custkey AS VARCHAR) || 'x' AS a, c_custkey AS b FROM customer")
def _(t):
    rows = t.customer.selectExpr("c_custkey", "concat(cast(c_custkey as string), 'x') as a", "cast(c_custkey as string) as b")
    return columns.cast_whole(rows, {"a": "bigint", "b": "bigint"})


_HOLES = "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal END AS bal, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END AS seg FROM customer"


def _holes(t):
    return t.customer.selectExpr("c_custkey", "case when c_custkey % 3 = 0 then null else c_acctbal end as bal", "case when c_custkey % 4 = 0 then null else c_mktsegment end as seg")


@query("xf8_fill_defaults", f"SELECT c_custkey, coalesce(bal, 0) AS bal, coalesce(seg, '') AS seg FROM ({_HOLES})")
def _(t):
    return columns.fill_nulls(_holes(t))


@query("xf8_fill_values", f"SELECT c_custkey, coalesce(bal, -1) AS bal, coalesce(seg, 'NONE') AS seg FROM ({_HOLES})")
def _(t):
    return columns.fill_nulls(_holes(t), {"bal": -1.0, "seg": "NONE", "absent": 1})


@query("xf9_fill_mean", f"WITH h AS ({_HOLES}) SELECT c_custkey, round(coalesce(bal, (SELECT avg(bal) FROM h)), 4) AS bal FROM h")
def _(t):
    return columns.fill_statistic(_holes(t), ["bal", "seg"], "mean").select("c_custkey", F.round("bal", 4).alias("bal"))


@query("xf9_fill_median", f"WITH h AS ({_HOLES}) SELECT c_custkey, round(coalesce(bal, (SELECT quantile_cont(bal, 0.5) FROM h)), 4) AS bal FROM h")
def _(t):
    return columns.fill_statistic(_holes(t), ["bal"], "median").select("c_custkey", F.round("bal", 4).alias("bal"))


@query("xf10_fill_one", f"SELECT c_custkey, coalesce(seg, 'UNKNOWN') AS seg FROM ({_HOLES})")
def _(t):
    return columns.fill_nulls(_holes(t).select("c_custkey", "seg"), {"seg": "UNKNOWN"})


@query("xf11_map_values", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS status FROM orders")
def _(t):
    return t.orders.select("o_orderkey", values.map_values(F.col("o_orderstatus"), {"F": "filled", "O": "open"}).alias("status"))


@query("xf12_derive", "SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS net, CASE WHEN l_quantity > 25 AND NOT (l_returnflag = 'R') THEN 'big' ELSE 'small' END AS size_class FROM lineitem")
def _(t):
    rows = columns.derive(t.lineitem, "net", "l_extendedprice * (1 - l_discount)")
    rows = columns.derive(rows, "size_class", "'big' if l_quantity > 25 and not l_returnflag == 'R' else 'small'")
    return rows.select("l_orderkey", "l_linenumber", F.round("net", 4).alias("net"), "size_class")


@query("xf13_flag", f"SELECT c_custkey, coalesce(bal > 5000, false) AS rich, coalesce(bal <> 0, true) AS some FROM ({_HOLES})")
def _(t):
    return _holes(t).select("c_custkey", values.flag(F.col("bal"), "gt", 5000).alias("rich"), values.flag(F.col("bal"), "neq", 0).alias("some"))


@query("xf14_text_case", "SELECT p_partkey, upper(p_name) AS up, lower(p_name) AS low, trim(' ' || p_name || ' ') AS bare FROM part")
def _(t):
    p = F.col("p_name")
    return t.part.select("p_partkey", values.text_rule(p, "upper").alias("up"), values.text_rule(p, "lower").alias("low"), values.text_rule(F.concat(F.lit(" "), p, F.lit(" ")), "strip").alias("bare"))


@query("xf15_iso_dates", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS d FROM orders")
def _(t):
    raw = F.when(F.col("o_orderkey") % 3 == 0, "soon").when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "dd.MM.yyyy")).otherwise(F.date_format("o_orderdate", "yyyy/MM/dd"))
    return t.orders.select("o_orderkey", values.iso_date(raw).alias("d"))


@query("xf16_country_codes", "SELECT c_custkey, CASE WHEN lower(n) = 'germany' THEN 'DE' WHEN lower(n) = 'france' THEN 'FR' ELSE n END AS country FROM (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'Germany' WHEN 1 THEN ' FRANCE' ELSE c_name END AS raw, trim(raw) AS t, CASE WHEN lower(trim(raw)) IN ('germany', 'france') THEN trim(raw) ELSE raw END AS n FROM customer)")
def _(t):
    raw = F.when(F.col("c_custkey") % 3 == 0, "Germany").when(F.col("c_custkey") % 3 == 1, " FRANCE").otherwise(F.col("c_name"))
    return t.customer.select("c_custkey", values.country_code(raw).alias("country"))


@query("xf17_bool_text", "SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'True' WHEN 1 THEN 'False' WHEN 2 THEN 'maybe' END AS b FROM customer")
def _(t):
    raw = F.expr("case c_custkey % 4 when 0 then ' YES' when 1 then '0' when 2 then 'maybe' end")
    return t.customer.select("c_custkey", values.bool_text(raw).alias("b"))


@query("xf18_phones", "SELECT c_custkey, CASE WHEN c_custkey % 4 = 3 THEN '12-34' ELSE '+1' || '415555' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') END AS phone FROM customer")
def _(t):
    n = F.lpad((F.col("c_custkey") % 10000).cast("string"), 4, "0")
    raw = F.when(F.col("c_custkey") % 4 == 3, "12-34").when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("(415) 555-"), n)).when(F.col("c_custkey") % 4 == 1, F.concat(F.lit("+1 415 555 "), n)).otherwise(F.concat(F.lit("1-415-555-"), n))
    return t.customer.select("c_custkey", values.phone_e164(raw, "US").alias("phone"))


@query("xf19_changed_counts", "SELECT 'p_brand' AS \"column\", count(*) FILTER (lower(p_brand) IS DISTINCT FROM p_brand) AS changed FROM part UNION ALL SELECT 'p_name', count(*) FILTER (upper(p_name) IS DISTINCT FROM p_name) FROM part")
def _(t):
    return steps.standardise_counts(t.part, {"p_brand": "lower", "p_name": "upper"})


@query("xf20_stamps", "SELECT o_orderkey, o_orderstatus, 'run-1' AS _pipeline_id, '2024-01-01T00:00:00Z' AS _loaded_at_utc FROM orders")
def _(t):
    return columns.stamp(t.orders.select("o_orderkey", "o_orderstatus"), "run-1", "2024-01-01T00:00:00Z")


@query("xf21_drop_empty_rows", f"SELECT bal, seg FROM ({_HOLES}) WHERE bal IS NOT NULL OR seg IS NOT NULL")
def _(t):
    return columns.drop_empty_rows(_holes(t).select("bal", "seg"))


@query("xf21_null_cells", f"SELECT 'bal' AS \"column\", count(*) FILTER (bal IS NULL) AS nulls FROM ({_HOLES}) UNION ALL SELECT 'seg', count(*) FILTER (seg IS NULL) FROM ({_HOLES})")
def _(t):
    return columns.null_cells(_holes(t).select("bal", "seg"))


@query("xf22_present", "SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN '  ' WHEN 1 THEN c_name END IS NOT NULL AND trim(CASE c_custkey % 3 WHEN 0 THEN '  ' WHEN 1 THEN c_name END) <> '' AS there FROM customer")
def _(t):
    return t.customer.select("c_custkey", values.present(F.expr("case c_custkey % 3 when 0 then '  ' when 1 then c_name end")).alias("there"))


@query("xf23_step_pipeline", """
SELECT flag, status, sum(net) AS net_sum, count(net) AS net_count FROM (
 SELECT l_returnflag AS flag, lower(l_linestatus) AS status, CAST(round(l_extendedprice * (1 - l_discount)) AS BIGINT) AS net FROM lineitem WHERE l_quantity > 10 AND l_returnflag <> 'N') GROUP BY ALL""")
def _(t):
    out, _ = steps.run_steps(
        t.lineitem,
        [
            {"type": "filter", "column": "l_quantity", "op": "gt", "value": 10},
            {"type": "filter", "column": "l_returnflag", "op": "neq", "value": "N"},
            {"type": "no_such_step"},
            {"type": "derive", "name": "net", "expression": "l_extendedprice * (1 - l_discount)"},
            {"type": "rename", "mapping": {"l_returnflag": "flag", "l_linestatus": "status"}},
            {"type": "standardize", "rules": {"status": "lower"}},
        ],
    )
    out, _ = steps.run_steps(out.withColumn("net", F.round("net").cast("long")), [{"type": "aggregate", "group_by": ["flag", "status"], "aggs": {"net": ["sum", "count"]}}])
    return out


_OPS = {"eq": "o_orderstatus = 'F'", "neq": "o_orderstatus IS DISTINCT FROM 'F'", "not_in": "coalesce(o_orderstatus NOT IN ('F','P'), true)", "contains": "regexp_matches(o_orderstatus, '[FP]')", "is_null": "o_orderstatus IS NULL"}
_STATUS = "SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders"


def _status(t):
    return t.orders.selectExpr("o_orderkey", "case when o_orderkey % 6 = 0 then null else o_orderstatus end as o_orderstatus", "o_totalprice")


@query("fl1_filter_ops", " UNION ALL ".join(f"SELECT '{k}' AS op, count(*) AS n, sum(o_orderkey) AS keys FROM ({_STATUS}) WHERE {v}" for k, v in _OPS.items()))
def _(t):
    given = {"eq": "F", "neq": "F", "not_in": ["F", "P"], "contains": "[FP]", "is_null": None}
    parts = [filters.filter_rows(_status(t), "o_orderstatus", op, v).agg(F.lit(op).alias("op"), F.count("*").alias("n"), F.sum("o_orderkey").cast("decimal(38,0)").alias("keys")).select("op", "n", F.col("keys").cast("long").alias("keys")) for op, v in given.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


SQL_KEYS = "CAST(sum(o_orderkey) AS BIGINT)"
from .registry import SQL  # noqa: E402

SQL["fl1_filter_ops"] = SQL["fl1_filter_ops"].replace("sum(o_orderkey)", SQL_KEYS)


@query("fl2_simple_rules", f"SELECT * FROM ({_STATUS}) WHERE o_orderstatus IS NOT NULL AND o_totalprice > 100000")
def _(t):
    return filters.simple_rules(_status(t), [{"column": "o_orderstatus", "op": "drop_if_null"}, {"column": "o_totalprice", "op": "gt", "value": 100000}, {"column": "absent", "op": "eq", "value": 1}])


@query("fl3_filter_out", f"SELECT * FROM ({_STATUS}) WHERE lower(o_orderstatus) IS DISTINCT FROM 'f'")
def _(t):
    return filters.filter_out(_status(t), "o_orderstatus", "f")


_MARK = "2024-01-15 00:00:00"
_EVENTS = "SELECT event_id, CASE WHEN event_id % 50 = 0 THEN NULL ELSE ts END AS ts FROM events"


def _marked(t):
    return t.events.selectExpr("event_id", "case when event_id % 50 = 0 then null else ts end as ts")


@query("fl4_above_mark", f"SELECT event_id FROM ({_EVENTS}) WHERE ts IS NULL OR ts > TIMESTAMP '{_MARK}'")
def _(t):
    return filters.above_mark(_marked(t), "ts", _MARK).select("event_id")


@query("fl5_late_rows", f"SELECT event_id FROM ({_EVENTS}) WHERE ts < TIMESTAMP '{_MARK}'")
def _(t):
    return filters.late_rows(_marked(t), "ts", _MARK).select("event_id")


@query("fl6_new_mark", "SELECT 'events::event_id' AS key, CAST(max(event_id) AS VARCHAR) AS mark FROM events")
def _(t):
    return filters.new_mark(t.events, "event_id", "events")


@query("fl7_purpose", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def _(t):
    return filters.limit_to_purpose(t.customer, ["c_mktsegment", "c_custkey", "c_nationkey", "other"])


@query("fl8_role_policy", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_nationkey < 5")
def _(t):
    roles = {"analyst": {"allow": ["c_custkey", "c_mktsegment", "c_name"], "deny": ["c_name"], "where": "c_nationkey < 5"}}
    return filters.enforce_role(t.customer, roles, "analyst")


@query("fl9_protocol_gate", "SELECT o_orderkey, o_orderstatus FROM orders")
def _(t):
    return filters.protocol_gate(t.orders, {"P1": {"columns": ["o_orderkey", "o_orderstatus"], "expires": "2025-01-01"}}, "P1", "2024-06-01")


@query("fl10_retention", f"SELECT event_id FROM ({_EVENTS}) WHERE ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAY")
def _(t):
    return filters.within_retention(_marked(t), "ts", "7_days", "2024-01-31 00:00:00").select("event_id")


@query("fl11_split_retention", f"SELECT CASE WHEN ts < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAY THEN 'expired' ELSE 'kept' END AS part, count(*) AS n FROM ({_EVENTS}) GROUP BY 1")
def _(t):
    kept, expired = filters.split_retention(_marked(t), "ts", "7_days", "2024-01-31 00:00:00")
    return kept.agg(F.count("*").alias("n")).select(F.lit("kept").alias("part"), "n").unionByName(expired.agg(F.count("*").alias("n")).select(F.lit("expired").alias("part"), "n"))


@query("fl12_retention_sweep", "SELECT 'events' AS \"table\", '7_days' AS policy, count(*) AS rows, count(*) FILTER (ts < TIMESTAMP '2024-01-31' - INTERVAL 7 DAY) AS expired FROM events UNION ALL SELECT 'orders', 'indefinite', count(*), 0 FROM orders")
def _(t):
    return filters.sweep_retention({"events": (t.events, "ts", "7_days"), "orders": (t.orders, "o_orderdate", "indefinite")}, "2024-01-31 00:00:00")


@query("fl13_erase_delete", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey = 3)")
def _(t):
    gone = t.customer.filter("c_nationkey = 3").select(F.col("c_custkey").alias("o_custkey"))
    return filters.erase(t.orders, gone, "o_custkey").select("o_orderkey", "o_custkey")


@query("fl13_erase_blank", "SELECT c_custkey, CASE WHEN c_nationkey <> 3 THEN c_name END AS c_name, c_nationkey FROM customer")
def _(t):
    return filters.erase(t.customer, t.customer.filter("c_nationkey = 3").select("c_custkey"), "c_custkey", ["c_name"]).select("c_custkey", "c_name", "c_nationkey")
