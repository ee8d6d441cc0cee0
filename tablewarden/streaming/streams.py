"""Governed streams: decode, mask, divert late rows, observe, load; over any streaming source."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import NumericType, StructType

from ..functions.names import check_identifier, pii_columns
from ..operators import filters, ledger
from ..plans.steps import govern

#: Tasks among which the rows of one key are dealt out.
SALTS = 8


def read_stream(spark: SparkSession, path: str, schema: StructType | str, form: str = "parquet", per_batch: int | None = None) -> DataFrame:
    r = spark.readStream.format(form).schema(schema)
    return (r.option("maxFilesPerTrigger", per_batch) if per_batch else r).load(path)


def read_topic(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    return spark.readStream.format("kafka").options(**{"kafka.bootstrap.servers": servers, "subscribe": topic}).load()  # needs the Kafka package


def decode(df: DataFrame, schema: StructType, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(rows of the JSON messages, messages that can't be decoded). Works on streams and tables."""
    full = StructType([*schema.fields]).add("_corrupt", "string")
    parsed = df.withColumn("_row", F.from_json(F.col(value).cast("string"), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    bad = F.col("_row").isNull() | F.col("_row._corrupt").isNotNull()
    return parsed.filter(~bad).select("_row.*").drop("_corrupt"), parsed.filter(bad).select(F.col(value).cast("string").alias(value))


def run_batches(df: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """All there is now, batch by batch; the checkpoint makes a restart go on after the last batch done."""
    return df.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def govern_stream(df: DataFrame, out: str, checkpoint: str, run_id: str, at: str) -> StreamingQuery:
    """Each batch governed and written to a folder of its own, so a batch that runs again replaces itself."""

    def each(batch: DataFrame, n: int) -> None:
        govern(batch, run_id, at).write.mode("overwrite").parquet(f"{out}/batch={n}")

    return run_batches(df, each, checkpoint)


def govern_observed_stream(df: DataFrame, out: str, checkpoint: str, run_id: str, at: str, dataset: str) -> StreamingQuery:
    """Each batch governed, observed and recorded: folders rows, observations and events under out, a batch each.

    What a batch brings, keeps and lacks is counted while its rows are written, with no pass of its own. Its events (read, masked,
    loaded) are one segment of the ledger, chained under the batch's number, and written last: a batch is done once they are
    there. A batch that runs again replaces all three by the same, so a stream that failed ends as one that did not.
    """

    def each(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        before, after = Observation(), Observation()
        masked = sorted(r["field"] for r in pii_columns(batch.columns))
        governed = govern(batch.observe(before, F.count("*").alias("rows")), run_id, at)
        numbers = [f.name for f in governed.schema if isinstance(f.dataType, NumericType)]
        stats = [F.count("*").alias("rows")]
        for i, c in enumerate(governed.columns):
            stats.append(F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}"))
            if c in numbers:
                stats += [F.avg(F.col(f"`{c}`").cast("double")).alias(f"m{i}"), F.stddev_samp(F.col(f"`{c}`").cast("double")).alias(f"s{i}")]
        governed.observe(after, *stats).write.mode("overwrite").parquet(f"{out}/rows/batch={n}")
        read, kept = before.get["rows"], after.get
        columns = [(c, kept[f"n{i}"], kept.get(f"m{i}"), kept.get(f"s{i}")) for i, c in enumerate(governed.columns)]
        seen = spark.createDataFrame([(dataset, at, read, kept["rows"], columns)], "dataset string, observed_utc string, rows_in long, row_count long, column_stats array<struct<column:string,nulls:long,mean:double,std:double>>")
        seen.coalesce(1).write.mode("overwrite").parquet(f"{out}/observations/batch={n}")
        detail = [("BATCH_READ", {"rows": str(read)}), ("PII_MASKED", {"fields": ",".join(masked)}), ("BATCH_LOADED", {"rows": str(kept["rows"]), "nulls": str(sum(c[1] for c in columns))})]
        events = ledger.events(spark, [(run_id, f"{dataset}-{n}-{i}", at, "STREAM", action, d) for i, (action, d) in enumerate(detail)])
        seq = F.substring_index("event_id", "-", -1).cast("long")
        chained = ledger.chain(ledger.canonical(events).select(F.lit(f"{dataset}-{n}").alias("segment_id"), seq.alias("seq"), "body"))
        chained.coalesce(1).write.mode("overwrite").parquet(f"{out}/events/batch={n}")

    return run_batches(df, each, checkpoint)


def latest(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row a key: the greatest by `order`, equal ones by all columns, so that the same rows give the same choice.

    Rows are dealt out first, so that a task holds the keys of its share and not all of a file's; a hot key's go to SALTS tasks.
    """
    value = F.struct(*rows.columns)
    rows = rows.repartition(*keys, F.pmod(F.xxhash64(*order), F.lit(SALTS)))
    return rows.groupBy(*keys).agg(F.max_by(value, F.struct(*order, *rows.columns)).alias("_row")).select("_row.*")


def upsert_stream(df: DataFrame, out: str, checkpoint: str, keys: Sequence[str], order: str) -> StreamingQuery:
    """Changes by key, a folder a batch, each with its keys' latest rows; a batch that runs again replaces its folder.

    A batch costs what it brings, whatever the table holds; upserted() reads the table, compact_upserts() folds it.
    """
    if not keys:
        raise ValueError("a load that counts each row once needs keys")
    order = check_identifier(order)

    def each(batch: DataFrame, n: int) -> None:
        latest(batch, keys, [order]).write.mode("overwrite").parquet(f"{out}/batch={n}")

    return run_batches(df, each, checkpoint)


def upserted(spark: SparkSession, out: str, keys: Sequence[str], order: str) -> DataFrame:
    """The table that the batches make: of each key the greatest row by `order`, of equal ones that of the later batch."""
    return latest(spark.read.parquet(out), keys, [order, "batch"]).drop("batch")


def compact_upserts(spark: SparkSession, out: str, to: str, keys: Sequence[str], order: str) -> None:
    """The table as one batch (-1, before all others) of a new folder, to which a stream may go on writing."""
    upserted(spark, out, keys, order).write.mode("overwrite").parquet(f"{to}/batch=-1")


def divert_late(df: DataFrame, column: str, mark, out: str, late: str, checkpoint: str) -> StreamingQuery:
    """Rows over the stored mark to `out`, rows below it to `late`; none is lost."""
    check_identifier(column)

    def each(batch: DataFrame, n: int) -> None:
        filters.above_mark(batch, column, mark).write.mode("overwrite").parquet(f"{out}/batch={n}")
        filters.late_rows(batch, column, mark).write.mode("overwrite").parquet(f"{late}/batch={n}")

    return run_batches(df, each, checkpoint)


def health(df: DataFrame, time: str, value: str, window: str = "1 hour", delay: str = "1 day") -> DataFrame:
    """window_start, rows, null_rate, newest of tumbling windows; the same on streams and tables."""
    rows = df.withColumn("_t", F.col(time).cast("timestamp"))
    if df.isStreaming:
        rows = rows.withWatermark("_t", delay)
    out = rows.groupBy(F.window("_t", window).alias("w")).agg(F.count("*").alias("rows"), F.round(F.avg(F.col(value).isNull().cast("int")), 6).alias("null_rate"), F.max("_t").alias("_newest"))
    return out.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "rows", "null_rate", F.date_format("_newest", "yyyy-MM-dd HH:mm:ss").alias("newest"))


def distinct_stream(df: DataFrame, time: str, keys: Sequence[str], delay: str = "1 day") -> DataFrame:
    """One row a key across batches, as long as the watermark keeps the key."""
    return df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))
