"""The audit trail (LG, LN, WN6) and its roll-ups (AG10, AG13)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import aggregates, ledger, lineage
from .registry import query

_SEG = 16


def _events(t):
    """Each event of the table is an audit event of a segment."""
    return t.events.select(
        F.concat(F.lit("run-"), (F.col("user_id") % _SEG).cast("string")).alias("pipeline_id"),
        F.col("event_id").cast("string").alias("event_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp_utc"),
        F.upper("event_type").alias("category"),
        F.when(F.col("value") > 90, "LOAD_ERROR").when(F.col("event_id") % 3 == 0, "SOURCE_READ").otherwise("MASK").alias("action"),
        F.create_map(F.lit("name"), F.col("event_type"), F.when(F.col("event_id") % 4 == 0, "pii_field").otherwise("other"), F.lit("email")).alias("detail"),
        (F.col("user_id") % _SEG).cast("int").alias("segment_id"),
        F.col("event_id").alias("seq"),
    )


def _chain(t):
    return ledger.chain(ledger.canonical(_events(t)))


@query("lg1_row_events", "SELECT 'LOAD-' || CAST(o_orderkey AS VARCHAR) AS event_id, o_orderstatus AS status FROM orders")
def _(t):
    return ledger.row_events(t.orders, "run-1", "LOAD", "LOAD", "2024-01-01", "o_orderkey", {"status": F.col("o_orderstatus")}).select("event_id", F.try_element_at("detail", F.lit("status")).alias("status"))


_BODY = """'{"action":"' || CASE WHEN value > 90 THEN 'LOAD_ERROR' WHEN event_id % 3 = 0 THEN 'SOURCE_READ' ELSE 'MASK' END || '","category":"' || upper(event_type) || '","detail":{"name":"' || event_type
 || '","' || CASE WHEN event_id % 4 = 0 THEN 'pii_field' ELSE 'other' END || '":"email"},"event_id":"' || event_id || '","pipeline_id":"run-' || user_id % 16 || '","timestamp_utc":"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '"}'"""


@query("lg2_chain_heads", f"""
WITH e AS (SELECT CAST(user_id % 16 AS INTEGER) AS segment_id, event_id AS seq, event_id // {ledger.BLOCK} AS block, {_BODY} AS body FROM events),
b AS (SELECT segment_id, block, count(*) AS n, list_reduce(list_prepend('GENESIS', list(body ORDER BY seq)), lambda h, x: sha256(h || '|' || x)) AS head FROM e GROUP BY ALL)
SELECT segment_id, CAST(sum(n) AS BIGINT) AS entry_count, list_reduce(list(head ORDER BY block), lambda h, x: sha256(h || '|' || x)) AS last_hash FROM b GROUP BY segment_id""")
def _(t):
    return ledger.heads(_chain(t))


@query("lg3_wn6_broken_links", "SELECT CAST(user_id % 16 AS INTEGER) AS segment_id, event_id AS seq, 'CONTENT' AS problem FROM events WHERE event_id % 500 = 7")
def _(t):
    edited = _chain(t).withColumn("body", F.when(F.col("seq") % 500 == 7, F.concat("body", F.lit(" "))).otherwise(F.col("body")))
    return ledger.broken_links(edited)


@query("lg3_truncated", "SELECT CAST(user_id % 16 AS INTEGER) AS segment_id, count(*) AS entry_count, count(*) - 5 AS found FROM events GROUP BY 1")
def _(t):
    chained = t.keep(_chain(t))
    from pyspark.sql import Window

    cut = chained.withColumn("_n", F.row_number().over(Window.partitionBy("segment_id").orderBy(F.desc("seq")))).filter("_n > 5").drop("_n")
    return ledger.truncated(cut, ledger.heads(chained))


def _heads_sql() -> str:
    return "SELECT CAST(user_id % 16 AS INTEGER) AS segment_id, count(*) AS entry_count, sha256(CAST(max(event_id) AS VARCHAR)) AS last_hash FROM events GROUP BY 1"


def _heads(t):
    return t.events.groupBy((F.col("user_id") % _SEG).cast("int").alias("segment_id")).agg(F.count("*").alias("entry_count"), F.sha2(F.max("event_id").cast("string"), 256).alias("last_hash"))


_ROOT = f"""
WITH RECURSIVE leaves AS (SELECT row_number() OVER (ORDER BY segment_id) - 1 AS i, sha256(CAST(segment_id AS VARCHAR) || chr(0) || CAST(entry_count AS VARCHAR) || chr(0) || last_hash) AS h FROM ({_heads_sql()})),
up AS (SELECT 0 AS level, list(h ORDER BY i) AS hs FROM leaves UNION ALL
 SELECT level + 1, list_transform(range((len(hs) + 1) // 2), lambda k: sha256(hs[2 * k + 1] || coalesce(hs[2 * k + 2], hs[2 * k + 1]))) FROM up WHERE len(hs) > 1)
SELECT (SELECT hs[1] FROM up ORDER BY level DESC LIMIT 1) AS merkle_root, count(*) AS segment_count, CAST(sum(entry_count) AS BIGINT) AS total_events FROM ({_heads_sql()})"""


@query("lg4_seal", _ROOT)
def _(t):
    return ledger.seal(_heads(t))


@query("lg5_verify_seal", "SELECT false AS ok, false AS root_matches, count(*) FILTER (event_id = 7) AS broken FROM events")
def _(t):
    chained = t.keep(_chain(t))
    sealed = ledger.seal(ledger.heads(chained))
    edited = chained.withColumn("self_hash", F.when(F.col("seq") == 7, F.sha2(F.lit("x"), 256)).otherwise(F.col("self_hash"))).filter("segment_id <> 3 or seq % 2 = 0")
    found = ledger.verify_seal(edited, sealed)
    return found.select("ok", "root_matches", F.when(F.col("broken") > 0, F.lit(1)).otherwise(F.lit(0)).cast("long").alias("broken"))


@query("lg6_inclusion", f"SELECT segment_id, sha256(CAST(segment_id AS VARCHAR) || chr(0) || CAST(entry_count AS VARCHAR) || chr(0) || last_hash) AS leaf, CAST(ceil(log2(count(*) OVER ())) AS INTEGER) AS steps, true AS included FROM ({_heads_sql()})")
def _(t):
    root, proofs = ledger.seal(_heads(t)).first()["merkle_root"], ledger.inclusion_proofs(_heads(t))
    return proofs.select("segment_id", "leaf", F.size("proof").alias("steps")).join(ledger.check_proof(proofs, root), "segment_id")


_LINES = ["l_orderkey", "l_linenumber", "l_partkey"]
_BUCKET = "CAST(CAST('0x' || substr(sha256(CAST(l_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 16 AS INTEGER)"
_MASKED = f"SELECT DISTINCT {_BUCKET} AS segment_id, 'MASKED_' || substr(sha256(CAST(l_partkey AS VARCHAR)), 1, 12) AS l_partkey, l_orderkey, l_linenumber FROM lineitem"


@query("lg7_govern_buckets", _MASKED)
def _(t):
    return ledger.govern_buckets(t.lineitem.select(*_LINES), "l_orderkey", 16, ["l_partkey"])


_STEP = """'{{"action":"{0}","category":"PARTITION","detail":"' || {1} || '","pipeline_id":"run-1","timestamp_utc":"2024-01-01"}}'"""


@query("lg7_govern_sealed", f"""
WITH RECURSIVE i AS (SELECT {_BUCKET} AS segment_id, count(*) AS n FROM lineitem GROUP BY 1), o AS (SELECT segment_id, count(*) AS m FROM ({_MASKED}) GROUP BY 1),
h AS (SELECT segment_id, n, m, list_reduce(['GENESIS', {_STEP.format("START", "n")}, {_STEP.format("MASK", "'l_partkey'")}, {_STEP.format("FINISH", "m")}], lambda h, x: sha256(h || '|' || x)) AS head FROM i JOIN o USING (segment_id)),
up AS (SELECT 0 AS level, list(sha256(CAST(segment_id AS VARCHAR) || chr(0) || '3' || chr(0) || head) ORDER BY segment_id) AS hs FROM h UNION ALL
 SELECT level + 1, list_transform(range((len(hs) + 1) // 2), lambda k: sha256(hs[2 * k + 1] || coalesce(hs[2 * k + 2], hs[2 * k + 1]))) FROM up WHERE len(hs) > 1)
SELECT (SELECT hs[1] FROM up ORDER BY level DESC LIMIT 1) AS merkle_root, count(*) AS segment_count, CAST(3 * count(*) AS BIGINT) AS total_events, CAST(sum(n) AS BIGINT) AS rows_in, CAST(sum(m) AS BIGINT) AS rows_out, true AS ok FROM h""")
def _(t):
    return ledger.govern_sealed(t.lineitem.select(*_LINES), "l_orderkey", 16, "run-1", "2024-01-01", ["l_partkey"], t.folder())


@query("ag10_ledger_summary", "SELECT upper(event_type) AS category, count(*) AS events, count(*) FILTER (value > 90) AS errors, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_utc, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_utc FROM events GROUP BY 1")
def _(t):
    return aggregates.ledger_summary(_events(t))


@query("ag13_processing_register", "SELECT 'seg-' || CAST(user_id % 4 AS VARCHAR) AS source, 'dw' AS destination, 'billing' AS purposes, count(DISTINCT user_id) AS runs FROM events GROUP BY 1")
def _(t):
    rows = t.events.select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("pipeline_id"), F.col("ts").cast("string").alias("timestamp_utc"), F.create_map(F.lit("source"), F.concat(F.lit("seg-"), (F.col("user_id") % 4).cast("string")), F.lit("destination"), F.lit("dw"), F.lit("purpose"), F.lit("billing")).alias("detail"))
    return aggregates.processing_register(rows).select("source", "destination", "purposes", "runs")


@query("ln1_nodes", "SELECT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN value > 90 THEN 'destination' WHEN event_id % 3 = 0 THEN 'source' ELSE 'stage' END AS kind, event_id % 4 = 0 AS pii FROM events")
def _(t):
    return ledger.lineage(_events(t))[0].select("event_id", "kind", "pii")


@query("ln1_edges", "SELECT * FROM (SELECT CAST(lag(event_id) OVER (PARTITION BY user_id % 16 ORDER BY strftime(ts, '%Y-%m-%d %H:%M:%S'), CAST(event_id AS VARCHAR)) AS VARCHAR) AS from_event, CAST(event_id AS VARCHAR) AS to_event FROM events) WHERE from_event IS NOT NULL")
def _(t):
    return ledger.lineage(_events(t))[1].select("from_event", "to_event")


@query("ln1_columns", """
WITH o AS (SELECT o_orderkey AS id, sha256(c_name) AS customer, CASE WHEN o_orderkey % 7 > 0 THEN o_totalprice * (1 + c_nationkey) END AS price, o_orderstatus, 'run-1' AS run,
 row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS nth FROM orders JOIN customer ON o_custkey = c_custkey),
n AS (SELECT count(id) AS id, count(customer) AS customer, count(price) AS price, count(o_orderstatus) AS status, count(run) AS run, count(nth) AS nth FROM o)
SELECT source, v."column", target, how, CASE target WHEN 'id' THEN n.id WHEN 'customer' THEN n.customer WHEN 'price' THEN n.price WHEN 'o_orderstatus' THEN n.status WHEN 'run' THEN n.run WHEN 'nth' THEN n.nth END AS "values"
FROM n, (VALUES ('orders', 'o_orderkey', 'id', 'renamed'), ('customer', 'c_name', 'customer', 'derived'), ('orders', 'o_totalprice', 'price', 'derived'), ('orders', 'o_orderkey', 'price', 'derived'), ('customer', 'c_nationkey', 'price', 'derived'),
 ('orders', 'o_orderstatus', 'o_orderstatus', 'copied'), (NULL, NULL, 'run', 'constant'), ('orders', 'o_custkey', 'nth', 'derived'), ('orders', 'o_orderdate', 'nth', 'derived'), ('orders', 'o_orderkey', 'nth', 'derived'),
 ('orders', 'o_orderpriority', NULL, 'dropped'), ('customer', 'c_custkey', NULL, 'dropped'), ('customer', 'c_acctbal', NULL, 'dropped'), ('customer', 'c_mktsegment', NULL, 'dropped')) v(source, "column", target, how)""")
def _(t):
    """A join with a mask, a rename, a derived column, a constant, a window and drops: its columns' origins, and how many values each holds."""
    nth = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).withColumn("nth", nth)
    price = F.when(F.col("o_orderkey") % 7 > 0, F.col("o_totalprice") * (1 + F.col("c_nationkey")))
    rows = rows.select(F.col("o_orderkey").alias("id"), F.sha2("c_name", 256).alias("customer"), price.alias("price"), "o_orderstatus", F.lit("run-1").alias("run"), "nth")
    return lineage.with_values(lineage.column_lineage(rows), rows).select("source", "column", "target", "how", "values")


@query("ln2_open_lineage", """SELECT CAST(o_orderkey AS VARCHAR) AS run_id, CASE WHEN o_orderkey % 5 = 0 THEN 'FAIL' ELSE 'COMPLETE' END AS type, '2024-01-01' AS at, o_orderpriority AS job, 'ns' AS namespace, 'orders' AS input, 'dw.orders' AS output,
 CASE WHEN o_orderkey % 5 > 0 THEN o_custkey END AS rows, 'o_totalprice' AS field, 'double' AS kind, 'not_null' AS assertion, CASE WHEN o_totalprice > 1000 THEN 'true' ELSE 'false' END AS success, CASE WHEN o_orderkey % 5 = 0 THEN 'lost' END AS error FROM orders""")
def _(t):
    fail = F.col("o_orderkey") % 5 == 0
    runs = t.orders.select(
        F.col("o_orderkey").cast("string").alias("run_id"),
        F.col("o_orderpriority").alias("job"),
        F.when(fail, "FAIL").otherwise("COMPLETE").alias("type"),
        F.lit("2024-01-01").alias("at"),
        F.array(F.lit("orders")).alias("inputs"),
        F.array(F.lit("dw.orders")).alias("outputs"),
        F.when(~fail, F.col("o_custkey")).alias("rows"),
        F.array(*[F.struct(F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type")) for f in t.orders.schema]).alias("fields"),
        F.array(F.struct(F.lit("not_null").alias("assertion"), F.lit("o_totalprice").alias("column"), (F.col("o_totalprice") > 1000).alias("success"))).alias("assertions"),
        F.when(fail, "lost").alias("error"),
    )
    at = {
        "run_id": "run.runId", "type": "eventType", "at": "eventTime", "job": "job.name", "namespace": "job.namespace", "input": "inputs[0].name", "output": "outputs[0].name", "rows": "outputs[0].outputFacets.outputStatistics.rowCount",
        "field": "outputs[0].facets.schema.fields[3].name", "kind": "outputs[0].facets.schema.fields[3].type", "assertion": "inputs[0].inputFacets.dataQualityAssertions.assertions[0].assertion",
        "success": "inputs[0].inputFacets.dataQualityAssertions.assertions[0].success", "error": "run.facets.errorMessage.message",
    }
    got = lambda path: F.get_json_object("value", f"$.{path}")
    return ledger.open_lineage(runs, "ns").select(*[(got(p).cast("long") if n == "rows" else got(p)).alias(n) for n, p in at.items()])
