"""The audit trail as tables: events, hash chains, Merkle roots and proofs, lineage."""

from __future__ import annotations

import hashlib
import json
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_folder

GENESIS = "GENESIS"
# What an empty ledger's root is the hash of, and the ids that a segment may have.
EMPTY_ROOT = hashlib.sha256(b"EMPTY-LEDGER").hexdigest()
SEGMENT_ID = "^[A-Za-z0-9_.-]{1,128}$"
EVENT = "pipeline_id string, event_id string, timestamp_utc string, category string, action string, detail map<string,string>"


def events(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Audit events: pipeline_id, event_id, timestamp_utc, category, action, detail."""
    return spark.createDataFrame(rows, EVENT)


def row_events(df: DataFrame, pipeline_id: str, category: str, action: str, at: str, key: str, detail: dict[str, Column]) -> DataFrame:
    """One event a row of a report: events come from DataFrames, not from the driver."""
    pairs = [x for k, v in detail.items() for x in (F.lit(k), v.cast("string"))]
    return df.select(F.lit(pipeline_id).alias("pipeline_id"), F.concat(F.lit(f"{action}-"), F.col(key).cast("string")).alias("event_id"), F.lit(at).alias("timestamp_utc"), F.lit(category).alias("category"), F.lit(action).alias("action"), F.create_map(*pairs).alias("detail"))


def canonical(df: DataFrame) -> DataFrame:
    """df with body: the event as one JSON text of sorted keys."""
    keys = sorted(c for c in df.columns if c not in ("segment_id", "seq"))
    return df.withColumn("body", F.to_json(F.struct(*keys)))


# Numbers of seq in a block of a segment: no more events are folded at once, however long a segment is.
BLOCK = 1 << 14


def chain(df: DataFrame, block: int = BLOCK) -> DataFrame:
    """df (segment_id, seq, body) with block, prev_hash and self_hash: SHA-256 over the hash before and the body, a fold along seq.

    seq numbers the events of a segment: whole numbers, each once. Segments are cut into blocks of `block` numbers, and
    the first of a block is hashed behind GENESIS, so that blocks are folded apart. Its prev_hash links it to the block
    before, and heads() folds the blocks' last hashes into the segment's.
    """

    def fold(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("seq")
        prev, out = GENESIS, []
        for body in f["body"]:
            own = hashlib.sha256(f"{prev}|{body}".encode()).hexdigest()
            out.append((prev, own))
            prev = own
        f["prev_hash"], f["self_hash"] = [x for x, _ in out], [x for _, x in out]
        return f[["segment_id", "seq", "block", "body", "prev_hash", "self_hash"]]

    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    cut = df.select("segment_id", "seq", F.expr(f"(seq - pmod(seq, {block})) div {block}").alias("block"), "body")
    folded = cut.groupBy("segment_id", "block").applyInPandas(fold, f"segment_id {kinds['segment_id']}, seq {kinds['seq']}, block long, body string, prev_hash string, self_hash string")
    first = F.col("prev_hash") == GENESIS
    return _linked(folded).select("segment_id", "seq", "block", "body", F.when(first, F.coalesce("_before", F.lit(GENESIS))).otherwise(F.col("prev_hash")).alias("prev_hash"), "self_hash")


def _blocks(chained: DataFrame) -> DataFrame:
    return chained.groupBy("segment_id", "block").agg(F.count("*").alias("n"), F.max_by("self_hash", "seq").alias("head"))


def _linked(chained: DataFrame) -> DataFrame:
    """chained with _before: the last hash of the block before in the segment. Only blocks are ordered within segments."""
    w = Window.partitionBy("_s").orderBy("_b")
    b = _blocks(chained).select(F.col("segment_id").alias("_s"), F.col("block").alias("_b"), "head").withColumn("_before", F.lag("head").over(w)).drop("head")
    return chained.join(b, F.col("segment_id").eqNullSafe(F.col("_s")) & F.col("block").eqNullSafe(F.col("_b")), "left").drop("_s", "_b")


def broken_links(chained: DataFrame) -> DataFrame:
    """segment_id, seq, problem: CONTENT (hash does not fit the body), ORDER (prev_hash is not the hash before)."""
    w = Window.partitionBy("segment_id", "block").orderBy("seq")
    before = F.coalesce(F.lag("self_hash").over(w), "_before", F.lit(GENESIS))
    fits = lambda prev: F.sha2(F.concat_ws("|", prev, F.col("body")), 256) == F.col("self_hash")
    tests = F.array(
        F.when(~(fits(F.col("prev_hash")) | ((F.row_number().over(w) == 1) & fits(F.lit(GENESIS)))), F.lit("CONTENT")),
        F.when(F.col("prev_hash") != before, F.lit("ORDER")),
    )
    return _linked(chained).select("segment_id", "seq", tests.alias("t")).select("segment_id", "seq", F.explode(F.filter("t", lambda x: x.isNotNull())).alias("problem"))


def heads(chained: DataFrame) -> DataFrame:
    """segment_id, entry_count, last_hash: the last hash of a segment of one block, else SHA-256 folded along the blocks' last hashes."""
    hashes = F.transform(F.array_sort("_x"), lambda x: x["head"])
    folded = F.aggregate(F.slice(hashes, F.lit(2), F.size(hashes)), F.element_at(hashes, 1), lambda h, x: F.sha2(F.concat_ws("|", h, x), 256))
    found = _blocks(chained).groupBy("segment_id").agg(F.sum("n").alias("entry_count"), F.collect_list(F.struct("block", "head")).alias("_x"))
    return found.select("segment_id", "entry_count", folded.alias("last_hash"))


def truncated(chained: DataFrame, anchors: DataFrame, slack: int = 1) -> DataFrame:
    """Segments whose events are fewer than anchored (segment_id, entry_count, last_hash); `slack` events may be missing after a crash."""
    now = heads(chained).select("segment_id", F.col("entry_count").alias("_n"), F.col("last_hash").alias("_h"))
    short = F.coalesce(F.col("_n"), F.lit(0)) < F.col("entry_count") - slack
    other = (F.col("_n") == F.col("entry_count")) & (F.col("_h") != F.col("last_hash"))
    return anchors.join(now, "segment_id", "left").filter(short | other).select("segment_id", "entry_count", F.coalesce("_n", F.lit(0)).alias("found"))


def leaf(segment: Column, count: Column, head: Column) -> Column:
    """The hash of id, count and head, parted by NUL; an id that no segment may have is an error."""
    name = segment.cast("string")
    fits = name.rlike(SEGMENT_ID) & ~name.isin(".", "..")
    return F.when(fits, F.sha2(F.concat_ws("\0", name, count.cast("string"), head), 256)).otherwise(F.raise_error(F.concat(F.lit("not a segment id: "), F.coalesce(name, F.lit("null")))).cast("string"))


def _levels(leaves: DataFrame) -> list[DataFrame]:
    """Levels (i, hash) from the leaves up to the root; a last odd node is paired with itself. log2 rounds of half the rows each."""
    n = leaves.count()
    out = [leaves]
    while n > 1:
        below = out[-1]
        pairs = below.groupBy(F.floor(F.col("i") / 2).cast("long").alias("_p")).agg(F.min_by("hash", "i").alias("a"), F.max_by("hash", "i").alias("b"))
        out.append(pairs.select(F.col("_p").alias("i"), F.sha2(F.concat("a", "b"), 256).alias("hash")))
        n = -(-n // 2)
    return out


def number_leaves(segment_heads: DataFrame, ranges: int = 32) -> DataFrame:
    """i, segment_id, hash in order of segment_id. Each of `ranges` tasks numbers one range of ids; only the ranges' sizes are summed up in order.

    The ranges are written before they are numbered, as their borders come from a sample.
    """
    spark = segment_heads.sparkSession
    path = f"{shared_folder(spark)}/leaves-{uuid.uuid4().hex}"
    own = segment_heads.select("segment_id", leaf(F.col("segment_id"), F.col("entry_count"), F.col("last_hash")).alias("hash"))
    own.repartitionByRange(ranges, "segment_id").sortWithinPartitions("segment_id").withColumn("_m", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("_r", F.shiftright("_m", 33))
    before = Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as ranges
    sizes = rows.groupBy("_r").agg(F.count("*").alias("_n")).select("_r", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return rows.join(sizes, "_r").select((F.col("_before") + F.col("_m").bitwiseAND((1 << 33) - 1)).alias("i"), "segment_id", "hash")


#: Leaves that are folded in one row.
FOLD = 4096


def _fold(leaves: Column) -> Column:
    """The root over FOLD sorted leaf hashes at most: twelve rounds of half as many; a last odd one is paired with itself."""
    pairs = lambda a: F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / 2).cast("int")), lambda i: F.sha2(F.concat(F.get(a, i * 2), F.coalesce(F.get(a, i * 2 + 1), F.get(a, i * 2))), 256))
    rounds = FOLD.bit_length() - 1
    top = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), leaves, lambda a, _: F.when(F.size(a) > 1, pairs(a)).otherwise(a))
    return F.when(F.size(leaves) > 0, F.get(top, F.lit(0)))


def seal(segment_heads: DataFrame) -> DataFrame:
    """merkle_root, segment_count, total_events. Up to FOLD segments are one row, more are numbered and paired level by level."""
    totals = [F.count("*").alias("segment_count"), F.coalesce(F.sum("entry_count"), F.lit(0)).alias("total_events")]
    if segment_heads.limit(FOLD + 1).count() <= FOLD:
        own = leaf(F.col("segment_id"), F.col("entry_count"), F.col("last_hash"))
        one = segment_heads.agg(*totals, F.array_sort(F.collect_list(F.struct("segment_id", own.alias("hash")))).alias("_leaves"))
        hashes = F.transform("_leaves", lambda x: x["hash"])
        return one.select(F.coalesce(_fold(hashes), F.lit(EMPTY_ROOT)).alias("merkle_root"), "segment_count", "total_events")
    top = _levels(number_leaves(segment_heads).select("i", "hash"))[-1]
    return segment_heads.agg(*totals).join(top.select(F.col("hash").alias("_root")), F.lit(True), "left").select(F.coalesce("_root", F.lit(EMPTY_ROOT)).alias("merkle_root"), "segment_count", "total_events")


def verify_seal(chained: DataFrame, sealed: DataFrame) -> DataFrame:
    """ok, root_matches, broken: chains and root of what is there now against the sealed root."""
    now = seal(heads(chained)).select(F.col("merkle_root").alias("_root"), F.col("total_events").alias("_n"))
    bad = broken_links(chained).agg(F.count("*").alias("broken"))
    same = (F.col("_root") == F.col("merkle_root")) & (F.col("_n") == F.col("total_events"))
    return sealed.crossJoin(now).crossJoin(bad).select((same & (F.col("broken") == 0)).alias("ok"), same.alias("root_matches"), "broken")


def inclusion_proofs(segment_heads: DataFrame) -> DataFrame:
    """segment_id, leaf, proof: array of (level, hash, left) for every segment; joins along the levels."""
    numbered = number_leaves(segment_heads)
    levels = _levels(numbered.select("i", "hash"))
    out = numbered.select("segment_id", "hash", F.col("i"), F.col("i").alias("_at"), F.array().cast("array<struct<level:int,hash:string,left:boolean>>").alias("proof"))
    for k, level in enumerate(levels[:-1]):
        own = level.select(F.col("i").alias("_i"), F.col("hash").alias("_h"))
        sib = level.select(F.col("i").alias("_j"), F.col("hash").alias("_s"))
        at = F.col("_at")
        other = F.when(at % 2 == 0, at + 1).otherwise(at - 1)
        out = out.join(own, at == F.col("_i")).join(sib, other == F.col("_j"), "left")
        step = F.struct(F.lit(k).alias("level"), F.coalesce("_s", "_h").alias("hash"), (at % 2 == 1).alias("left"))
        out = out.select("segment_id", "hash", "i", F.floor(at / 2).cast("long").alias("_at"), F.concat("proof", F.array(step)).alias("proof"))
    return out.select("segment_id", F.col("hash").alias("leaf"), "proof")


def check_proof(proofs: DataFrame, root: str) -> DataFrame:
    """segment_id, included: the proof folded from the leaf gives the root."""
    folded = F.aggregate("proof", F.col("leaf"), lambda h, p: F.when(p["left"], F.sha2(F.concat(p["hash"], h), 256)).otherwise(F.sha2(F.concat(h, p["hash"]), 256)))
    return proofs.select("segment_id", (folded == root).alias("included"))


def bucket(key: Column, buckets: int) -> Column:
    """A stable bucket: the first 32 bits of the key's SHA-256."""
    return F.pmod(F.conv(F.substring(F.sha2(F.coalesce(key.cast("string"), F.lit("")), 256), 1, 8), 16, 10).cast("long"), F.lit(buckets)).cast("int")


def govern_buckets(df: DataFrame, key: str, buckets: int, columns: list[str]) -> DataFrame:
    """df with segment_id (a stable bucket of the key), the named columns masked, repeated rows dropped."""
    from ..functions.values import mask

    return df.withColumns({"segment_id": bucket(F.col(key), buckets)} | {c: mask(F.col(c)) for c in columns}).dropDuplicates()


def bucket_trail(counts: DataFrame, pipeline_id: str, at: str, columns: list[str]) -> DataFrame:
    """The chained start, mask and finish events of each bucket, as chain() makes them; counts: segment_id, rows_in, rows_out.

    A bucket has three events, so its chain is three nested hashes in its own row.
    """
    body = lambda action, detail: F.to_json(F.struct(F.lit(action).alias("action"), F.lit("PARTITION").alias("category"), detail.cast("string").alias("detail"), F.lit(pipeline_id).alias("pipeline_id"), F.lit(at).alias("timestamp_utc")))
    rows = counts.select("segment_id", body("START", F.col("rows_in")).alias("_b0"), body("MASK", F.lit(",".join(columns))).alias("_b1"), body("FINISH", F.col("rows_out")).alias("_b2"))
    before: Column = F.lit(GENESIS)
    for i in range(3):
        rows = rows.withColumns({f"_p{i}": before, f"_h{i}": F.sha2(F.concat_ws("|", before, f"_b{i}"), 256)})
        before = F.col(f"_h{i}")
    events = F.array(*[F.struct(F.lit(i).cast("long").alias("seq"), F.lit(0).cast("long").alias("block"), F.col(f"_b{i}").alias("body"), F.col(f"_p{i}").alias("prev_hash"), F.col(f"_h{i}").alias("self_hash")) for i in range(3)])
    return rows.select("segment_id", F.explode(events).alias("x")).select("segment_id", "x.*")


def govern_sealed(df: DataFrame, key: str, buckets: int, pipeline_id: str, at: str, columns: list[str], path: str) -> DataFrame:
    """Govern df by buckets into `path`: rows, the chained trail and its seal are written, then verified as they stand there.

    merkle_root, segment_count, total_events, rows_in, rows_out, ok. Every bucket has its own chain, so nothing is shared
    between the tasks that write. A row says in _copies for how many it stands, so what came in is counted in what is written.
    """
    from ..functions.values import mask

    spark = df.sparkSession
    masked = df.withColumns({"segment_id": bucket(F.col(key), buckets)} | {c: mask(F.col(c)) for c in columns})
    masked.groupBy(*masked.columns).agg(F.count("*").alias("_copies")).write.parquet(f"{path}/rows")
    counts = spark.read.parquet(f"{path}/rows").groupBy("segment_id").agg(F.sum("_copies").alias("rows_in"), F.count("*").alias("rows_out"))
    bucket_trail(counts, pipeline_id, at, columns).write.parquet(f"{path}/trail")
    trail = spark.read.parquet(f"{path}/trail")
    seal(heads(trail)).write.parquet(f"{path}/seal")
    sealed = spark.read.parquet(f"{path}/seal")
    told = trail.select("seq", F.get_json_object("body", "$.detail").try_cast("long").alias("n")).agg(F.coalesce(F.sum(F.when(F.col("seq") == 0, F.col("n"))), F.lit(0)).alias("rows_in"), F.coalesce(F.sum(F.when(F.col("seq") == 2, F.col("n"))), F.lit(0)).alias("rows_out"))
    return sealed.crossJoin(told).crossJoin(verify_seal(trail, sealed).select("ok"))


# --- lineage -------------------------------------------------------------------------------------------------


def lineage(audit: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of runs: source, stages by time, destination; edges go from each event to the next of its run."""
    kind = F.when(F.col("action").rlike("SOURCE|EXTRACT"), "source").when(F.col("action").rlike("LOAD|DESTINATION"), "destination").otherwise("stage")
    w = Window.partitionBy("pipeline_id").orderBy("timestamp_utc", "event_id")
    nodes = audit.select("pipeline_id", "event_id", kind.alias("kind"), F.coalesce(F.try_element_at("detail", F.lit("name")), F.col("action")).alias("label"), F.coalesce(F.try_element_at("detail", F.lit("pii_field")).isNotNull(), F.lit(False)).alias("pii"), "timestamp_utc")
    edges = nodes.withColumn("from_event", F.lag("event_id").over(w)).filter("from_event is not null").select("pipeline_id", "from_event", F.col("event_id").alias("to_event"))
    return nodes, edges


def open_lineage(runs: DataFrame, namespace: str) -> DataFrame:
    """run_id, value: one JSON text a run in the open run-event format.

    runs: run_id, job, type (START, COMPLETE, FAIL), at, inputs, outputs, rows; and where there are such columns, fields
    (array of name, type: the schema facet of every output), assertions (array of assertion, column, success: the quality facet
    of every input) and error (the message of a failed run). What is null is left out.
    """
    has = lambda c: c in runs.columns
    named = lambda n: [F.lit(namespace).alias("namespace"), n.alias("name")]
    rows = F.when(F.col("rows").isNotNull(), F.struct(F.struct(F.col("rows").alias("rowCount")).alias("outputStatistics")))
    schema = F.when(F.col("fields").isNotNull(), F.struct(F.struct(F.col("fields").alias("fields")).alias("schema"))) if has("fields") else F.lit(None).cast("struct<schema:string>")
    checks = F.when(F.col("assertions").isNotNull(), F.struct(F.struct(F.col("assertions").alias("assertions")).alias("dataQualityAssertions"))) if has("assertions") else F.lit(None).cast("struct<dataQualityAssertions:string>")
    failed = F.when(F.col("error").isNotNull(), F.struct(F.struct(F.col("error").alias("message"), F.lit("python").alias("programmingLanguage")).alias("errorMessage"))) if has("error") else F.lit(None).cast("struct<errorMessage:string>")
    body = F.struct(
        F.col("type").alias("eventType"),
        F.col("at").alias("eventTime"),
        F.struct(F.col("run_id").alias("runId"), failed.alias("facets")).alias("run"),
        F.struct(*named(F.col("job"))).alias("job"),
        F.transform("inputs", lambda n: F.struct(*named(n), checks.alias("inputFacets"))).alias("inputs"),
        F.transform("outputs", lambda n: F.struct(*named(n), schema.alias("facets"), rows.alias("outputFacets"))).alias("outputs"),
    )
    return runs.select("run_id", F.to_json(body).alias("value"))


def canonical_json(event: dict) -> str:
    return json.dumps(event, sort_keys=True, separators=(",", ":"))
