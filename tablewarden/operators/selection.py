"""Exact quantiles and distinct counts of many columns at once, without holding any column in a task.

A quantile is selected, not sorted for: a histogram of every column says in which bin each wanted rank falls, then only those
bins are divided again, between the least and greatest value that they hold, until a bin is one value. The first
histogram is over the signed logarithm, so columns of any spread divide well; the next ones are even. Each pass is one scan
with one aggregate for all columns (BINS rows a wanted bin at most, summed up before the shuffle) and is done in some three or four
passes whatever the number of rows. What comes to the driver is one bin for each wanted rank of each column.

Nulls do not count. NaN is greater than all numbers. A column without values has null quantiles. Ties need no rule: ranks
within equal values are the same value.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bins that a bin is divided into; values over all numbers' logarithms.
BINS = 8192
_TOP = 710.0


def _numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """c (place of the column), x: every value that is no null."""
    cells = F.array(*[F.struct(F.lit(i).alias("c"), F.col(f"`{c}`").cast("double").alias("x")) for i, c in enumerate(columns)])
    return df.select(F.explode(cells).alias("v")).select("v.c", "v.x").filter("x is not null")


def _spread(x: Column) -> Column:
    """Bin by signed logarithm: 0 to BINS - 1, below them -infinity, above them infinity and NaN."""
    log = F.when(x < 0, -F.log1p(-x)).otherwise(F.log1p(x))
    bin_ = F.least(F.lit(BINS - 1), F.floor((log + _TOP) / (2 * _TOP) * BINS))
    return F.when(F.isnan(x), BINS + 1).when(x == math.inf, BINS).when(x == -math.inf, -1).otherwise(bin_).cast("int")


def _bins(values: DataFrame, key: Sequence[str], bin_: Column, start: Column) -> DataFrame:
    """key, bin, n, lo, hi and before (rows of the same key in smaller bins, from start on)."""
    bins = values.withColumn("bin", bin_).groupBy(*key, "bin").agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"), F.min(start).alias("start"))
    up = Window.partitionBy(*key).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)  # BINS + 3 rows a key at most
    return bins.withColumn("before", F.col("start") + F.coalesce(F.sum("n").over(up), F.lit(0))).drop("start")


def quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[str, list[float | None]]:
    """Of each numeric column its values at the probabilities, linear between neighbouring ranks."""
    if not columns:
        return {}
    spark = df.sparkSession
    values = _numbers(df, columns)
    first = _bins(values, ["c"], _spread(F.col("x")), F.lit(0).cast("long")).withColumn("rows", F.sum("n").over(Window.partitionBy("c")))
    places = F.array(*[F.floor((F.col("rows") - 1) * F.lit(p)).cast("long") + F.lit(i) for p in probs for i in (0, 1)])
    here = (F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("n"))
    found: dict[tuple[int, int], float] = {}
    rows: dict[int, int] = {}
    at = first.withColumn("rank", F.explode(F.array_distinct(places))).filter(here).select("c", "rank", "rows", "before", "lo", "hi").collect()
    while at:
        rows |= {r["c"]: r["rows"] for r in at if "rows" in r}
        found |= {(r["c"], r["rank"]): r["lo"] for r in at if r["lo"] == r["hi"] or math.isnan(r["lo"])}
        open_ = {(r["c"], r["before"]): (r["lo"], r["hi"]) for r in at if (r["c"], r["rank"]) not in found}
        if not open_:
            break
        wanted = sorted({(r["c"], r["before"], r["rank"]) for r in at if (r["c"], r["rank"]) not in found})
        bins = spark.createDataFrame([(c, b, lo, hi) for (c, b), (lo, hi) in open_.items()], "c int, base long, lo double, hi double")
        inside = values.join(F.broadcast(bins), (values["c"] == bins["c"]) & (F.col("x") >= F.col("lo")) & (F.col("x") <= F.col("hi"))).select(values["c"], "base", "x", (F.col("x") - F.col("lo")).alias("up"), (F.col("hi") - F.col("lo")).alias("width"))
        even = F.least(F.lit(BINS - 1), F.floor(F.col("up") / F.col("width") * BINS)).cast("int")
        divided = _bins(inside, ["c", "base"], even, F.col("base"))
        targets = spark.createDataFrame(wanted, "c int, base long, rank long")
        at = divided.join(F.broadcast(targets), ["c", "base"]).filter(here).select("c", "rank", "before", "lo", "hi").collect()
    out: dict[str, list[float | None]] = {}
    for i, c in enumerate(columns):
        out[c] = []
        for p in probs:
            if i not in rows:
                out[c].append(None)
                continue
            place = (rows[i] - 1) * p
            low = math.floor(place)
            a = found[i, low]
            part = place - low
            out[c].append(a if not part else a + (found[i, low + 1] - a) * part if found[i, low + 1] != a else a)
    return out


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, distinct: one aggregate over (column, 128-bit hash of the value) for all columns; nulls do not count."""
    cells = [F.when(F.col(f"`{c}`").isNotNull(), F.struct(F.lit(i).alias("c"), F.xxhash64(F.col(f"`{c}`")).alias("a"), F.xxhash64(F.lit(i), F.lit("again"), F.col(f"`{c}`")).alias("b"))) for i, c in enumerate(columns)]
    values = df.select(F.explode(F.filter(F.array(*cells), lambda v: v.isNotNull())).alias("v")).select("v.*").distinct()
    counts = values.groupBy("c").agg(F.count("*").alias("distinct"))
    names = F.array(*map(F.lit, columns))
    every = df.sparkSession.range(len(columns)).select(F.col("id").cast("int").alias("c"))
    return every.join(F.broadcast(counts), "c", "left").select(F.element_at(names, F.col("c") + 1).alias("column"), F.coalesce("distinct", F.lit(0)).cast("long").alias("distinct"))
