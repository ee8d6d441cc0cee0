"""Differences of tables, versions and schemas."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, StructType, TimestampNTZType, TimestampType
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from .ranges import number_rows


def row_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, change (added, deleted, changed), column, before, after: values as text, one row a changed column; one full join."""
    columns = [c for c in old.columns if c in new.columns and c not in keys]
    pack = lambda df, name: df.select(*keys, F.struct(*[F.col(c).cast("string").alias(c) for c in columns]).alias(name))
    both = pack(old, "_old").join(pack(new, "_new"), list(keys), "full_outer")
    one = [F.struct(F.lit(c).alias("column"), F.col(f"_old.{c}").alias("before"), F.col(f"_new.{c}").alias("after")) for c in columns]
    none = F.array(F.struct(F.lit(None).cast("string").alias("column"), F.lit(None).cast("string").alias("before"), F.lit(None).cast("string").alias("after")))
    change = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "deleted").otherwise("changed")
    found = F.when(F.col("_old").isNull() | F.col("_new").isNull(), none).otherwise(F.filter(F.array(*one), lambda x: ~x["before"].eqNullSafe(x["after"])))
    return both.select(*keys, change.alias("change"), F.explode(found).alias("_x")).select(*keys, "change", "_x.*")


def diff_counts(diff: DataFrame, keys: Sequence[str]) -> DataFrame:
    """change, column (null: whole rows), rows."""
    return diff.groupBy("change", "column").agg(F.count_distinct(F.struct(*keys)).alias("rows"))


def positional_diff(old: DataFrame, new: DataFrame, order: Sequence[Column], by: Sequence[str] = ()) -> DataFrame:
    """row_diff by the place in the given order: of the whole table, whose places are counted in ranges, or within `by`."""
    if by:
        w = Window.partitionBy(*by).orderBy(*order)
        place = lambda df: df.withColumn("_place", F.row_number().over(w))
    else:
        place = lambda df: number_rows(df, order)
    return row_diff(place(old), place(new), [*by, "_place"])


def version_diff(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, nulls and distinct values in both, values added and removed: one shuffle over (column, value)."""
    stack = lambda df, at: df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])).alias("x"), F.lit(at).alias("at")).select("x.*", "at")
    values = stack(a, 0).unionByName(stack(b, 1)).groupBy("column", "value").agg(F.count_if(F.col("at") == 0).alias("a"), F.count_if(F.col("at") == 1).alias("b"))
    there = F.col("value").isNotNull()
    return values.groupBy("column").agg(
        F.coalesce(F.sum(F.when(~there, F.col("a"))), F.lit(0)).alias("nulls_a"),
        F.coalesce(F.sum(F.when(~there, F.col("b"))), F.lit(0)).alias("nulls_b"),
        F.count_if(there & (F.col("a") > 0)).alias("distinct_a"),
        F.count_if(there & (F.col("b") > 0)).alias("distinct_b"),
        F.count_if(there & (F.col("a") == 0)).alias("added"),
        F.count_if(there & (F.col("b") == 0)).alias("removed"),
    )


def schema_diff(spark: SparkSession, old: Sequence[str], new: Sequence[str], ignore_case: bool = False) -> DataFrame:
    """column, status (added, removed)."""
    low = (lambda x: x.lower()) if ignore_case else (lambda x: x)
    a, b = {low(c) for c in old}, {low(c) for c in new}
    rows = [(c, "added") for c in new if low(c) not in a] + [(c, "removed") for c in old if low(c) not in b]
    return spark.createDataFrame(rows, "column string, status string")


def family(t) -> str:
    """The five families in which types count as equal."""
    if isinstance(t, (ByteType, ShortType, IntegerType, LongType)):
        return "BIGINT"
    if isinstance(t, NumericType):
        return "DOUBLE PRECISION"
    if isinstance(t, (TimestampType, TimestampNTZType, DateType)):
        return "TIMESTAMP"
    return "BOOLEAN" if isinstance(t, BooleanType) else "TEXT"


def evolution_plan(spark: SparkSession, target: StructType, incoming: StructType, drop_missing: bool = False) -> DataFrame:
    """column, step (add, drop, drift), from_type, to_type."""
    a, b = {f.name: family(f.dataType) for f in target}, {f.name: family(f.dataType) for f in incoming}
    rows = [(c, "add", None, t) for c, t in b.items() if c not in a]
    rows += [(c, "drop", t, None) for c, t in a.items() if c not in b and drop_missing]
    rows += [(c, "drift", a[c], t) for c, t in b.items() if c in a and a[c] != t]
    return spark.createDataFrame(rows, "column string, step string, from_type string, to_type string")


def evolve(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """Both tables' rows under all columns of either."""
    return target.unionByName(incoming, allowMissingColumns=True)


def all_equal(a: Sequence[Column], b: Sequence[Column]) -> Column:
    return reduce(lambda x, y: x & y, [p.eqNullSafe(q) for p, q in zip(a, b, strict=True)])
