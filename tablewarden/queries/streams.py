"""Streams (ST): a streaming read of the given tables, run until all is read, and what it wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ledger
from ..streaming import streams
from .registry import query

_MARK = "2024-01-15 00:00:00"


def _stream(t, df):
    """df as a stream: written to a folder in four files, read one file a batch."""
    path = t.folder()
    df.repartition(4, df.columns[0]).write.parquet(path)
    return streams.read_stream(t.spark, path, df.schema, per_batch=1)


@query("st1_decode", "SELECT event_id FROM events WHERE event_id % 10 <> 0")
def _(t):
    messages = t.events.select(F.when(F.col("event_id") % 10 == 0, "{broken").otherwise(F.to_json(F.struct("event_id", "event_type"))).alias("value"))
    good, _ = streams.decode(_stream(t, messages), t.events.select("event_id", "event_type").schema)
    out = t.folder()
    good.writeStream.format("parquet").option("checkpointLocation", t.folder()).trigger(availableNow=True).start(out).awaitTermination()
    return t.spark.read.parquet(out).select("event_id")


@query("st4_govern", "SELECT DISTINCT c_custkey AS id, 'MASKED_' || substr(sha256(c_name), 1, 12) AS full_name FROM customer")
def _(t):
    out = t.folder()
    rows = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("full_name"))
    streams.govern_stream(_stream(t, rows), out, t.folder(), "run-1", "2024-01-01").awaitTermination()
    return t.spark.read.parquet(out).select("id", "full_name")


@query("st4_observed", """
WITH c AS (SELECT c_custkey AS id, 'MASKED_' || substr(sha256(c_name), 1, 12) AS full_name, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal END AS balance FROM customer)
SELECT 'rows' AS part, CAST(count(*) AS DOUBLE) AS a, CAST(count(balance) AS DOUBLE) AS b, round(sum(balance), 2) AS c FROM c
UNION ALL SELECT 'observed', 2.0 * count(*), count(*), count(*) - count(balance) FROM c
UNION ALL SELECT 'events', 12, 0, 0
UNION ALL SELECT 'told', 2.0 * count(*), count(*), count(*) - count(balance) FROM c""")
def _(t):
    """Every customer twice: what was written, what the observations say, the chains (events, broken links, batches without), what the events say."""
    rows = t.customer.selectExpr("c_custkey as id", "c_name as full_name", "case when c_custkey % 3 = 0 then null else c_acctbal end as balance")
    out = t.folder()
    streams.govern_observed_stream(_stream(t, rows.unionAll(rows)), out, t.folder(), "run-1", "2024-01-01T00:00:00Z", "customer").awaitTermination()
    written, seen, trail = (t.spark.read.parquet(f"{out}/{x}") for x in ("rows", "observations", "events"))
    one = lambda df, part, a, b, c: df.agg(a.cast("double").alias("a"), b.cast("double").alias("b"), F.round(c.cast("double"), 2).alias("c")).select(F.lit(part).alias("part"), "*")
    nulls = F.sum(F.aggregate("column_stats", F.lit(0).cast("long"), lambda s, x: s + x["nulls"]))
    told = trail.select("seq", F.get_json_object("body", "$.detail.rows").cast("long").alias("n"), F.get_json_object("body", "$.detail.nulls").cast("long").alias("lack"))
    chains = trail.agg(F.count("*").alias("n"), F.count_distinct("batch").alias("k")).crossJoin(ledger.broken_links(trail).agg(F.count("*").alias("broken")))
    return (
        one(written, "rows", F.count("*"), F.count("balance"), F.sum("balance"))
        .unionByName(one(seen, "observed", F.sum("rows_in"), F.sum("row_count"), nulls))
        .unionByName(one(chains, "events", F.max("n"), F.max("broken"), F.max(4 - F.col("k"))))
        .unionByName(one(told, "told", F.sum(F.when(F.col("seq") == 0, F.col("n"))), F.sum(F.when(F.col("seq") == 2, F.col("n"))), F.sum("lack")))
    )


@query("st5_upsert", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_quantity DESC) = 1")
def _(t):
    out, keys = t.folder(), ["l_orderkey"]
    rows = _stream(t, t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"))
    streams.upsert_stream(rows, out, t.folder(), keys, "l_linenumber").awaitTermination()
    return streams.upserted(t.spark, out, keys, "l_linenumber")


@query("st6_late", f"SELECT event_id, CASE WHEN ts < TIMESTAMP '{_MARK}' THEN 'late' ELSE 'kept' END AS part FROM events WHERE ts <> TIMESTAMP '{_MARK}'")
def _(t):
    out, late = t.folder(), t.folder()
    streams.divert_late(_stream(t, t.events.select("event_id", "ts")), "ts", _MARK, out, late, t.folder()).awaitTermination()
    part = lambda p, n: t.spark.read.parquet(p).select("event_id", F.lit(n).alias("part"))
    return part(out, "kept").unionByName(part(late, "late"))


_HEALTH = "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS rows, round(count(*) FILTER (event_id % 20 = 0) / count(*), 6) AS null_rate, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS newest FROM events GROUP BY 1"


def _health_rows(t):
    return t.events.selectExpr("event_id", "ts", "case when event_id % 20 <> 0 then value end as value")


@query("st7_health_batch", _HEALTH)
def _(t):
    return streams.health(_health_rows(t), "ts", "value")


@query("st7_health_stream", _HEALTH)
def _(t):
    """The same as a stream whose watermark holds all windows open until the end."""
    out = t.folder()
    rows = streams.health(_stream(t, _health_rows(t)), "ts", "value", delay="3650 days")
    rows.writeStream.foreachBatch(lambda batch, n: batch.write.mode("overwrite").parquet(out)).outputMode("complete").option("checkpointLocation", t.folder()).trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.parquet(out)


@query("st8_distinct", "SELECT DISTINCT user_id FROM events")
def _(t):
    out = t.folder()
    rows = streams.distinct_stream(_stream(t, t.events.select("user_id", "ts")), "ts", ["user_id"], "3650 days")
    rows.writeStream.format("parquet").option("checkpointLocation", t.folder()).trigger(availableNow=True).start(out).awaitTermination()
    return t.spark.read.parquet(out).select("user_id")
