"""Sources and loads (SRC, DLQ, LD, VS): every round trip reads the given tables, writes to the shared folder and reads back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import loads
from ..sources import archives, keyed, ranges, readers, sinks, sqlite
from .registry import query

_PART = "SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part"
_SCHEMA = "p_partkey long, p_name string, p_brand string, p_size int, p_retailprice double"


def _part(t):
    return t.part.select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")


for _form, _options in (("csv", {"header": "true"}), ("tsv", {"header": "true", "sep": "\t"}), ("jsonl", {}), ("parquet", {}), ("orc", {})):

    @query(f"src_{_form}", _PART)
    def _(t, form=_form, options=_options):
        path = t.folder()
        _part(t).write.options(**options).format({"tsv": "csv", "jsonl": "json"}.get(form, form)).save(path)
        return readers.read(t.spark, path, form, _SCHEMA)


@query("src3_json_nested", "SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS props__k FROM events")
def _(t):
    path = t.folder()
    t.events.select("event_id", "event_type", F.from_json("props", "k long").alias("props")).write.json(path)
    return readers.read(t.spark, path, "jsonl").select("event_id", "event_type", "props__k")


@query("src5_xml", "SELECT c_custkey, c_name, c_nationkey FROM customer")
def _(t):
    path = t.folder()
    t.customer.select(F.col("c_custkey").alias("_key"), F.struct(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation")).alias("of")).write.format("xml").option("rowTag", "customer").save(path)
    rows = readers.read(t.spark, path, "xml", "_key long, of struct<name: string, nation: int>", row_tag="customer")
    return rows.select(F.col("_key").alias("c_custkey"), F.col("of__name").alias("c_name"), F.col("of__nation").alias("c_nationkey"))


@query("src9_fixed_width", "SELECT CAST(s_suppkey AS VARCHAR) AS key, s_name AS name FROM supplier")
def _(t):
    path = t.folder()
    t.supplier.select(F.concat(F.rpad(F.col("s_suppkey").cast("string"), 10, " "), F.rpad("s_name", 30, " ")).alias("value")).write.text(path)
    return readers.read(t.spark, path, "fixed", fields=[("key", 1, 10), ("name", 11, 30)])


@query("src10_compressed", _PART)
def _(t):
    path = t.folder()
    _part(t).write.options(header=True, compression="gzip").csv(path)
    return readers.read(t.spark, path, "csv", _SCHEMA)


def _database(t) -> str:
    """A new database file that the driver and all executors can open."""
    path = t.folder()
    sqlite.make_folder(path)
    return f"sqlite:{path}/db"


@query("src11_src12_database", "SELECT s_suppkey, CASE WHEN s_nationkey < 3 THEN upper(s_name) || '!' ELSE s_name END AS s_name FROM supplier WHERE s_nationkey < 10 UNION ALL SELECT -s_suppkey, 'new' FROM supplier WHERE s_nationkey < 3")
def _(t):
    """Through a database file in the folder that the cluster shares: written, upserted there, read in parts by a key whose bounds are asked for, filtered at the source."""
    url = _database(t)
    rows = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    sinks.write_database(rows, url, "SUPPLIER", "replace")
    changed = rows.filter("s_nationkey < 3").selectExpr("s_suppkey", "concat(upper(s_name), '!') as s_name", "s_nationkey")
    changed = changed.unionByName(rows.filter("s_nationkey < 3").selectExpr("-s_suppkey as s_suppkey", "'new' as s_name", "s_nationkey"))
    sinks.write_database(changed, url, "SUPPLIER", "upsert", keys=["s_suppkey"])
    return readers.read_database(t.spark, url, "SUPPLIER", columns=["s_suppkey", "s_name"], where="s_nationkey < 10", key="s_suppkey", partitions=3)


_KINDS = ("zip", "tgz", "lz4", "zst")


@query("src10_archives", f"SELECT kind, o_orderkey, o_orderpriority FROM orders, (VALUES {', '.join(f'({chr(39)}{k}{chr(39)})' for k in _KINDS)}) v(kind)")
def _(t):
    """The same rows out of a zip and a tgz of two members each, a frame of lz4 and one of zst."""
    folder = t.folder()
    rows = t.orders.select("o_orderkey", "o_orderpriority")
    out = None
    for kind in _KINDS:
        rows.repartition(2 if kind in ("zip", "tgz") else 1).write.options(header=True).csv(f"{folder}/{kind}-in")
        path = f"{folder}/orders.{'csv.' if kind in ('lz4', 'zst') else ''}{kind}"
        sinks.write_archive(t.spark, f"{folder}/{kind}-in", path)
        part = archives.read_archives(t.spark, path, schema=rows.schema).select(F.lit(kind).alias("kind"), "o_orderkey", "o_orderpriority")
        out = part if out is None else out.unionByName(part)
    return out


@query("src12_keyed", "SELECT p_brand, p_partkey, p_name FROM part WHERE p_size < 40")
def _(t):
    """By a primary key of a text and a number, which the database is asked for: the first half, then from its last key on."""
    url = _database(t)
    sinks.write_database(t.part.select("p_brand", "p_partkey", "p_name", "p_size"), url, "PART", "replace", primary=["p_brand", "p_partkey"])
    key = keyed.primary_key(t.spark, url, "PART")
    columns = ["p_brand", "p_partkey", "p_name"]
    first = t.keep(keyed.read_keyed(t.spark, url, "PART", columns=columns, where='"p_size" < 40 AND "p_brand" < \'Brand#2\'', partitions=3))
    rest = keyed.read_keyed(t.spark, url, "PART", columns=columns, where='"p_size" < 40', partitions=4, resume_after=keyed.last_key(first, key))
    return first.unionByName(rest)


@query("src13_fingerprints", "SELECT 'orders.parquet' AS file, count(*) AS rows, 6 AS columns, true AS hashed FROM orders")
def _(t):
    found = readers.fingerprints(t.spark, f"{t.sf_dir}/orders.parquet", "parquet")
    return found.select("file", "rows", "columns", F.col("sha256").rlike("^[0-9a-f]{64}$").alias("hashed"))


@query("src13_large_files", "SELECT CAST(sum(octet_length(encode(o_orderkey || ',' || o_orderpriority)) + 1) AS BIGINT) AS bytes, true AS plain_agrees, true AS trees_agree, true AS trees_tell FROM orders")
def _(t):
    """Text files and their copies by ranges of 4,096 bytes: plain hashes are those of whole values, equal files have equal trees, other ones others."""
    first, copy, other = t.folder(), t.folder(), t.folder()
    lines = t.keep(t.orders.select(F.concat_ws(",", F.col("o_orderkey").cast("string"), "o_orderpriority").alias("value")))
    for path, rows in ((first, lines), (copy, lines), (other, lines.select(F.concat(F.substring("value", 1, 1), F.lower(F.substring("value", 2, 99))).alias("value")))):
        # files that can still be one value, which the plain hashes are compared with
        rows.write.option("maxRecordsPerFile", 2_000_000).text(path)
    found, again, changed = (t.keep(ranges.large_fingerprints(t.spark, p, 4096)) for p in (first, copy, other))
    whole = readers.fingerprints(t.spark, first).select("file", F.col("sha256").alias("_whole"))
    one = found.join(whole, "file").agg(F.sum("bytes").alias("bytes"), (F.count_if(F.col("sha256") == F.col("_whole")) == F.count("*")).alias("plain_agrees"))
    trees = lambda df, name: df.agg(F.array_join(F.array_sort(F.collect_list("tree")), ",").alias(name))
    return one.crossJoin(trees(found, "_a")).crossJoin(trees(again, "_b")).crossJoin(trees(changed, "_c")).select("bytes", "plain_agrees", (F.col("_a") == F.col("_b")).alias("trees_agree"), (F.col("_a") != F.col("_c")).alias("trees_tell"))


@query("src14_per_file", "SELECT count(*) AS rows, 4 AS files FROM part")
def _(t):
    path = t.folder()
    _part(t).repartition(4, "p_partkey").write.parquet(path)
    return readers.per_file(readers.read_files(t.spark, [path], "parquet", _SCHEMA)).agg(F.sum("rows").alias("rows"), F.count("*").alias("files"))


@query("src15_copy", _PART)
def _(t):
    return readers.copy_table(_part(t), t.folder())


@query("src16_reading_sql", "SELECT n_name, count(*) AS suppliers FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name")
def _(t):
    return readers.query(t.spark, {"supplier": t.supplier, "nation": t.nation}, "SELECT n_name, count(*) AS suppliers FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name")


@query("dlq1_dead_letters", "SELECT c_custkey, 'run-1' AS _dlq_pipeline_id, 'negative balance' AS _dlq_reason FROM customer WHERE c_acctbal < 0")
def _(t):
    path = t.folder()
    loads.write_dead(loads.split_bad(t.customer, F.col("c_acctbal") < 0, "run-1", "negative balance", "2024-01-01")[1], path)
    return t.spark.read.parquet(path).select("c_custkey", "_dlq_pipeline_id", "_dlq_reason")


@query("dlq2_replay", "SELECT c_custkey, CAST(0 AS DOUBLE) AS c_acctbal FROM customer WHERE c_acctbal < 0")
def _(t):
    path = t.folder()
    loads.write_dead(loads.split_bad(t.customer, F.col("c_acctbal") < 0, "run-1", "negative balance", "2024-01-01")[1], path)
    return loads.replay(t.spark, path, lambda df: df.withColumn("c_acctbal", F.lit(0.0)), "run-1").select("c_custkey", "c_acctbal")


@query("ld1_append_replace", "SELECT o_orderkey, o_totalprice FROM orders UNION ALL SELECT o_orderkey, o_totalprice FROM orders")
def _(t):
    path = t.folder()
    for mode in ("append", "replace", "append"):
        loads.write_rows(t.orders.select("o_orderkey", "o_totalprice"), path, mode)
    return t.spark.read.parquet(path)


_SOURCE = "SELECT c_custkey, 'NEW' AS c_mktsegment FROM customer WHERE c_custkey % 10 = 0 UNION ALL SELECT c_custkey + 1000000, 'NEW' FROM customer WHERE c_custkey % 10 = 0"


def _source(t):
    some = t.customer.filter("c_custkey % 10 = 0").select("c_custkey", F.lit("NEW").alias("c_mktsegment"))
    return some.unionByName(some.withColumn("c_custkey", F.col("c_custkey") + 1000000))


@query("ld2_upsert", f"SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey % 10 <> 0 UNION ALL {_SOURCE}")
def _(t):
    return loads.upsert(t.customer.select("c_custkey", "c_mktsegment"), _source(t), ["c_custkey"])


@query("ld3_merge", f"SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey % 10 <> 0 UNION ALL {_SOURCE}")
def _(t):
    twice = _source(t).unionByName(_source(t).withColumn("c_mktsegment", F.lit("OLD")))
    return loads.upsert(t.customer.select("c_custkey", "c_mktsegment"), twice, ["c_custkey"], merge=True, order=[F.col("c_mktsegment")])


@query("ld4_partitions", "SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS replaced FROM customer")
def _(t):
    path = t.folder()
    rows = t.customer.select("c_custkey", F.lit(0).alias("replaced"), "c_mktsegment")
    sinks.write_files(rows, path, "parquet", "replace", ["c_mktsegment"], "zstd")
    sinks.write_files(rows.filter("c_mktsegment = 'BUILDING'").withColumn("replaced", F.lit(1)), path, "parquet", "replace", ["c_mktsegment"])
    return t.spark.read.parquet(path).select("c_custkey", "replaced")


@query("ld5_compact", _PART)
def _(t):
    path = t.folder()
    _part(t).repartition(8).write.parquet(path)
    return loads.compact(t.spark, path, t.folder())


@query("ld6_reconcile", "SELECT count(*) AS source_rows, count(*) FILTER (c_custkey % 100 <> 0) AS loaded_rows, CASE WHEN count(*) - count(*) FILTER (c_custkey % 100 <> 0) > count(*) * 0.001 THEN 'SHORT' ELSE 'OK' END AS verdict FROM customer")
def _(t):
    return loads.reconcile(t.customer, t.customer.filter("c_custkey % 100 <> 0"), tolerance=0.001)


@query("df6_column_reconciliation", "SELECT * FROM (VALUES ('c_name', 'missing'), ('extra', 'extra')) v(\"column\", status) WHERE (SELECT count(*) FROM customer) > 0")
def _(t):
    return loads.column_reconciliation(t.customer, t.customer.withColumnsRenamed({"c_name": "EXTRA", "c_custkey": "C_CUSTKEY"}))


@query("ld7_rollback", "SELECT c_custkey, c_mktsegment FROM customer")
def _(t):
    store = loads.ReversibleLoads(t.spark, t.folder())
    before = t.customer.select("c_custkey", "c_mktsegment")
    store.load(before, loads.upsert(before, _source(t), ["c_custkey"]), "customer", "run-1", "2024-01-01")
    return store.rollback_latest("customer")


@query("ld8_ld9_dry_run", "SELECT count(*) AS rows, false AS written FROM customer")
def _(t):
    return loads.write_rows(t.customer, "nowhere", dry_run=True).select("rows", "written")


@query("ld10_vs2_versions", "SELECT CAST(v AS BIGINT) AS version, CASE v WHEN 1 THEN count(*) ELSE count(*) FILTER (c_custkey % 2 = 0) END AS rows FROM customer, (VALUES (1), (2)) x(v) GROUP BY v")
def _(t):
    store = loads.SnapshotStore(t.spark, t.folder())
    store.snapshot(t.customer, "customer", at="2024-01-01")
    store.snapshot(t.customer.orderBy(F.desc("c_custkey")), "customer", at="2024-01-02")
    store.snapshot(t.customer.filter("c_custkey % 2 = 0"), "customer", at="2024-01-03")
    return store.manifest().select("version", "rows")


@query("vs1_content_hash", "SELECT true AS same, false AS same_after_edit FROM customer LIMIT 1")
def _(t):
    a = loads.content_hash(t.customer).select(F.col("hash").alias("a"))
    b = loads.content_hash(t.customer.repartition(5, "c_nationkey")).select(F.col("hash").alias("b"))
    c = loads.content_hash(t.customer.withColumn("c_name", F.when(F.col("c_custkey") == 1, "x").otherwise(F.col("c_name")))).select(F.col("hash").alias("c"))
    return a.crossJoin(b).crossJoin(c).select((F.col("a") == F.col("b")).alias("same"), (F.col("a") == F.col("c")).alias("same_after_edit"))


@query("vs2_checkout", "SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0")
def _(t):
    store = loads.SnapshotStore(t.spark, t.folder())
    for k in (3, 2):
        store.snapshot(t.customer.filter(F.col("c_custkey") % k == 0), "customer", at=str(k))
    return store.checkout("customer", 1).select("c_custkey")


@query("sink_topic_rows", "SELECT CAST(s_suppkey AS VARCHAR) AS key, CAST(s_nationkey AS VARCHAR) AS nation FROM supplier")
def _(t):
    return sinks.topic_rows(t.supplier, ["s_suppkey"]).select("key", F.get_json_object("value", "$.s_nationkey").alias("nation"))


@query("sink_vectors", "SELECT vec_id, label FROM embeddings")
def _(t):
    path = t.folder()
    sinks.write_vectors(t.embeddings, path, "embedding", "vec_id")
    return t.spark.read.parquet(path).select("vec_id", "label")
