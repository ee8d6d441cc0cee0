"""Order-dependent operators, sorting and top-k. Every order is explicit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranges import fill_ranges


def fill_along(df: DataFrame, columns: Sequence[str], how: str, order: Sequence[Column], by: Sequence[str] = ()) -> DataFrame:
    """Nulls take the nearest value before (forward) or after (backward) them within `by`.

    Without `by` the order is that of the whole table, which is scanned in ranges; ranges.fill_ranges does the same for keys
    that hold a large share of the rows.
    """
    if not order:
        raise ValueError("an order is needed to fill along")
    if not by:
        return fill_ranges(df, columns, how, order)
    w = Window.partitionBy(*by).orderBy(*order)
    if how == "forward":
        w, f = w.rowsBetween(Window.unboundedPreceding, 0), F.last
    else:
        w, f = w.rowsBetween(0, Window.unboundedFollowing), F.first
    return df.withColumns({c: f(c, ignorenulls=True).over(w) for c in columns})


def rolling_decline(scores: DataFrame, n: int = 3) -> DataFrame:
    """declining: the last n scores of the dataset fell strictly."""
    w = Window.partitionBy("dataset").orderBy("observed_utc")
    fell = (F.col("score") < F.lag("score").over(w)).cast("int")
    marked = scores.withColumn("_fell", F.coalesce(fell, F.lit(0)))
    return marked.withColumn("declining", F.sum("_fell").over(w.rowsBetween(-(n - 2), 0)) == n - 1).drop("_fell")


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def against_previous(df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str]) -> DataFrame:
    """previous_X and X_change of every column X against the run before."""
    w = Window.partitionBy(*keys).orderBy(order)
    out = df.withColumns({f"previous_{c}": F.lag(c).over(w) for c in columns})
    return out.withColumns({f"{c}_change": F.col(c) - F.col(f"previous_{c}") for c in columns})


def volume_baseline(observations: DataFrame, n: int = 5) -> DataFrame:
    """baseline: mean row_count of the n observations before."""
    w = Window.partitionBy("dataset").orderBy("observed_utc").rowsBetween(-n, -1)
    return observations.withColumn("baseline", F.avg("row_count").over(w))


def stage_durations(events: DataFrame) -> DataFrame:
    """seconds since the event before in the same run."""
    w = Window.partitionBy("pipeline_id").orderBy("timestamp_utc", "event_id")
    at = F.col("timestamp_utc").cast("timestamp")
    return events.withColumn("seconds", F.unix_micros(at) / 1e6 - F.unix_micros(F.lag(at).over(w)) / 1e6)


def newest(history: DataFrame, n: int, by: Sequence[str] = (), time: str = "observed_utc") -> DataFrame:
    """The last n rows, of each key if there are keys."""
    if not by:
        return history.orderBy(F.desc(time)).limit(n)
    return history.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(time)))).filter(F.col("_n") <= n).drop("_n")


def sort(df: DataFrame, by: Sequence[str], ascending: bool | Sequence[bool] = True) -> DataFrame:
    """Nulls last in either direction; columns that are absent are passed over."""
    up = [ascending] * len(by) if isinstance(ascending, bool) else ascending
    keys = [F.col(c).asc_nulls_last() if a else F.col(c).desc_nulls_last() for c, a in zip(by, up, strict=True) if c in df.columns]
    return df.orderBy(*keys) if keys else df


def top_values(df: DataFrame, columns: Sequence[str], n: int = 10) -> DataFrame:
    """column, value, count, rank: the most frequent values as text (ties by value); one shuffle for all columns."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])).alias("x")).select("x.*").filter("value is not null")
    counts = long.groupBy("column", "value").agg(F.count("*").alias("count"))
    w = Window.partitionBy("column").orderBy(F.desc("count"), "value")
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
