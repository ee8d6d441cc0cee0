"""Prefix scans over a whole table's order: numbering and filling without a window over all rows.

Rows are numbered and written, so that ties have an order that stays, then parted by ranges of the order (and their number:
a third of all rows with one value are split as any others), sorted, and written with their range and place in it. A scan is
then one summary a range, the summaries' own scan (as many rows as ranges), and each range's part with what was carried to it.
No task holds more than the ranges that are dealt to it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_folder

#: monotonically_increasing_id: the partition stands above these bits.
_BITS = 33


def ranged(df: DataFrame, order: Sequence[Column], ranges: int | None = None) -> DataFrame:
    """df with _range and _place (from 0 in the range), as a written table; ranges follow one another in the order."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/ranges-{uuid.uuid4().hex}"
    df.withColumn("_number", F.monotonically_increasing_id()).write.parquet(f"{path}/numbered")
    rows = spark.read.parquet(f"{path}/numbered")
    parts = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.repartitionByRange(parts, *order, "_number").sortWithinPartitions(*order, "_number").withColumn("_at", F.monotonically_increasing_id()).drop("_number").write.parquet(f"{path}/ranged")
    read = spark.read.parquet(f"{path}/ranged")
    return read.withColumns({"_range": F.shiftright("_at", _BITS), "_place": F.col("_at").bitwiseAND((1 << _BITS) - 1)}).drop("_at")


def number_rows(df: DataFrame, order: Sequence[Column], name: str = "_place", ranges: int | None = None) -> DataFrame:
    """df with its rows' places in the order, from 1."""
    rows = ranged(df, order, ranges)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as ranges
    sizes = rows.groupBy("_range").agg(F.count("*").alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.col("_place") + 1
    return rows.join(F.broadcast(sizes), "_range").withColumn("_place", place).drop("_range", "_before").withColumnRenamed("_place", name)


def fill_ranges(df: DataFrame, columns: Sequence[str], how: str, order: Sequence[Column], by: Sequence[str] = (), ranges: int | None = None) -> DataFrame:
    """Nulls take the nearest value before (forward) or after (backward) them among the rows of the same `by`.

    A key may fill many ranges: what its last rows in one know is carried to the ranges that go on with it.
    """
    if not order:
        raise ValueError("an order is needed to fill along")
    rows = ranged(df, [*map(F.col, by), *order], ranges)
    sign = 1 if how == "forward" else -1
    place, step = F.col("_place") * sign, F.col("_range") * sign
    key = F.struct(*map(F.col, by)) if by else F.lit(0)
    # The key that a range ends with (in the direction of the scan), the one that it begins with, and what the first knows.
    ends = rows.groupBy("_range").agg(F.max_by(key, place).alias("_last"), F.min_by(key, place).alias("_first"))
    known = rows.join(F.broadcast(ends), "_range").filter(key.eqNullSafe(F.col("_last"))).groupBy("_range").agg(*[F.max_by(F.col(f"`{c}`"), F.when(F.col(f"`{c}`").isNotNull(), place)).alias(f"_c{i}") for i, c in enumerate(columns)])
    ends = ends.join(known, "_range")
    values = [f"_c{i}" for i in range(len(columns))]
    told = ends.select((step * 2).alias("_at"), F.col("_last").alias("_key"), F.lit(None).cast("long").alias("_range"), *values)
    asked = ends.select((step * 2 - 1).alias("_at"), F.col("_first").alias("_key"), "_range", *[F.lit(None).cast(ends.schema[v].dataType).alias(v) for v in values])
    over = Window.partitionBy("_key").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)  # two rows a range
    carried = told.unionByName(asked).withColumns({v: F.last(v, ignorenulls=True).over(over) for v in values}).filter("_range is not null").select("_range", F.col("_key").alias("_first"), *values)
    own = Window.partitionBy("_range", *by).orderBy(place).rowsBetween(Window.unboundedPreceding, 0)
    joined = rows.join(F.broadcast(carried), "_range")
    filled = {c: F.coalesce(F.last(F.col(f"`{c}`"), ignorenulls=True).over(own), F.when(key.eqNullSafe(F.col("_first")), F.col(v))) for c, v in zip(columns, values, strict=True)}
    return joined.withColumns(filled).select(*[F.col(f"`{c}`") for c in df.columns])
