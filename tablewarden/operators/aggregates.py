"""Grouping, de-duplication, anonymity, and roll-ups of ledgers, alerts, costs and consents."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

AGGREGATES = {"sum": lambda c: F.coalesce(F.sum(c), F.lit(0)), "mean": F.avg, "avg": F.avg, "min": F.min, "max": F.max, "count": F.count, "nunique": F.count_distinct, "std": F.stddev_samp, "median": lambda c: F.percentile(c, 0.5), "first": F.first, "last": F.last}


def aggregate(df: DataFrame, by: Sequence[str], aggs: dict[str, str | list[str]]) -> DataFrame:
    """One function keeps the column's name, several give column_function. Null keys are dropped."""
    out = []
    for c, fs in aggs.items():
        many = not isinstance(fs, str)
        out += [AGGREGATES[f](F.col(c)).alias(f"{c}_{f}" if many else c) for f in ([fs] if not many else fs)]
    return df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in by])).groupBy(*by).agg(*out)


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def deduplicate(df: DataFrame, subset: Sequence[str], keep: str | bool, order: Sequence[Column]) -> DataFrame:
    """first or last of each subset in the given order; False: only those that stand alone."""
    if keep is False:
        return df.withColumn("_n", F.count("*").over(Window.partitionBy(*subset))).filter("_n = 1").drop("_n")
    if not order:
        raise ValueError("an order is needed to say which row is first")
    w = Window.partitionBy(*subset)
    if keep == "first":
        return df.withColumn("_n", F.row_number().over(w.orderBy(*order))).filter("_n = 1").drop("_n")
    places = w.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({"_n": F.row_number().over(places), "_of": F.count("*").over(w)}).filter("_n = _of").drop("_n", "_of")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """rows, duplicates: by a group of all columns, so equal rows are summed before the shuffle."""
    return df.groupBy(*df.columns).count().agg(F.coalesce(F.sum("count"), F.lit(0)).alias("rows"), (F.coalesce(F.sum("count"), F.lit(0)) - F.count("*")).alias("duplicates"))


def duplicate_keys(df: DataFrame, keys: Sequence[str], previous: float | None = None, spike: float = 0.01) -> DataFrame:
    """rows, duplicate_count, duplicate_rate, missing, severity: HIGH over 5 % or a rise of more than `spike`, MEDIUM for any duplicate, else OK.

    A key column that is absent is HIGH by itself; then nothing is counted, and `missing` names what is absent.
    """
    missing = [k for k in keys if k not in df.columns]
    if missing:
        none = F.lit(None)
        return df.agg(F.count("*").alias("rows")).select("rows", none.cast("long").alias("duplicate_count"), none.cast("double").alias("duplicate_rate"), F.lit(",".join(missing)).alias("missing"), F.lit("HIGH").alias("severity"))
    one = df.groupBy(*keys).count().agg(F.coalesce(F.sum("count"), F.lit(0)).alias("rows"), (F.coalesce(F.sum("count"), F.lit(0)) - F.count("*")).alias("duplicate_count"))
    rate = F.round(F.coalesce(F.col("duplicate_count") / F.when(F.col("rows") > 0, F.col("rows")), F.lit(0.0)), 6)
    high = (rate > 0.05) | (F.lit(previous is not None) & (rate - F.lit(previous or 0.0) > spike))
    severity = F.when(F.col("duplicate_count") == 0, "OK").when(high, "HIGH").otherwise("MEDIUM")
    return one.select("rows", "duplicate_count", rate.alias("duplicate_rate"), F.lit(None).cast("string").alias("missing"), severity.alias("severity"))


def risky_groups(df: DataFrame, quasi: Sequence[str], k: int = 5, sensitive: str | None = None, diversity: int = 2) -> DataFrame:
    """Groups of quasi-identifiers (nulls form groups) of fewer than k rows, or of fewer than `diversity` sensitive values."""
    aggs = [F.count("*").alias("group_rows")] + ([F.count_distinct(sensitive).alias("sensitive_values")] if sensitive else [])
    bad = F.col("group_rows") < k
    if sensitive:
        bad = bad | (F.col("sensitive_values") < diversity)
    return df.groupBy(*quasi).agg(*aggs).filter(bad)


def anonymity(df: DataFrame, quasi: Sequence[str], k: int = 5) -> DataFrame:
    """groups, smallest, groups_at_risk, rows_at_risk."""
    g = df.groupBy(*quasi).agg(F.count("*").alias("n"))
    return g.agg(F.count("*").alias("groups"), F.min("n").alias("smallest"), F.count_if(F.col("n") < k).alias("groups_at_risk"), F.coalesce(F.sum(F.when(F.col("n") < k, F.col("n"))), F.lit(0)).alias("rows_at_risk"))


def enforce_anonymity(df: DataFrame, quasi: Sequence[str], k: int = 5, sensitive: str | None = None, diversity: int = 2, action: str = "suppress") -> DataFrame:
    """suppress: without the rows of risky groups; report: the groups; raise: an error if there are any."""
    bad = risky_groups(df, quasi, k, sensitive, diversity)
    if action == "report":
        return bad
    if action == "raise":
        if bad.limit(1).count():
            raise ValueError("groups of quasi-identifiers are too small")
        return df
    keys = bad.select(*[F.col(q).alias(f"_{q}") for q in quasi])
    return df.join(keys, reduce(lambda a, b: a & b, [F.col(q).eqNullSafe(F.col(f"_{q}")) for q in quasi]), "left_anti")


def ledger_summary(events: DataFrame) -> DataFrame:
    """category, events, errors, first_utc, last_utc."""
    return events.groupBy("category").agg(F.count("*").alias("events"), F.count_if(F.upper("action").rlike("ERROR|FAIL")).alias("errors"), F.min("timestamp_utc").alias("first_utc"), F.max("timestamp_utc").alias("last_utc"))


def alert_summary(alerts: DataFrame) -> DataFrame:
    """dataset, type, severity, alerts: with totals (null) by dataset and over all."""
    return alerts.rollup("dataset", "type", "severity").agg(F.count("*").alias("alerts"))


def run_costs(runs: DataFrame, prices: DataFrame) -> DataFrame:
    """runs (run_id, platform, started, seconds, gb) with cost by prices (platform, per_hour, per_gb)."""
    return runs.join(prices, "platform", "left").withColumn("cost", F.round(F.col("seconds") / 3600 * F.coalesce("per_hour", F.lit(0.0)) + F.col("gb") * F.coalesce("per_gb", F.lit(0.0)), 6)).drop("per_hour", "per_gb")


def cost_by_platform(costs: DataFrame) -> DataFrame:
    """platform, runs, total, cheapest and dearest run (ties by run_id)."""
    return costs.groupBy("platform").agg(F.count("*").alias("runs"), F.round(F.sum("cost"), 4).alias("total"), F.min_by("run_id", F.struct("cost", "run_id")).alias("cheapest"), F.max_by("run_id", F.struct("cost", "run_id")).alias("dearest"))


def cumulative_costs(costs: DataFrame) -> DataFrame:
    """Running cost of each platform, in order of start and run."""
    w = Window.partitionBy("platform").orderBy("started", "run_id").rowsBetween(Window.unboundedPreceding, 0)
    return costs.withColumn("cumulative", F.round(F.sum("cost").over(w), 6))


def monthly_projection(costs: DataFrame, runs_per_day: float) -> DataFrame:
    return costs.groupBy("platform").agg(F.round(F.avg("cost") * runs_per_day * 30, 4).alias("monthly"))


def processing_register(events: DataFrame) -> DataFrame:
    """source, destination, purposes, pii_fields, transfers, runs: one row a pair, from all runs' events (pipeline_id, action, detail map)."""
    get = lambda k: F.try_element_at("detail", F.lit(k))
    runs = events.groupBy("pipeline_id").agg(
        F.max_by(get("source"), F.when(get("source").isNotNull(), F.col("timestamp_utc"))).alias("source"),
        F.max_by(get("destination"), F.when(get("destination").isNotNull(), F.col("timestamp_utc"))).alias("destination"),
        F.collect_set(get("purpose")).alias("purposes"),
        F.collect_set(get("pii_field")).alias("pii"),
        F.collect_set(get("transfer")).alias("moves"),
    )
    join = lambda c: F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))), ",")
    return runs.filter("source is not null and destination is not null").groupBy("source", "destination").agg(join("purposes").alias("purposes"), join("pii").alias("pii_fields"), join("moves").alias("transfers"), F.count("*").alias("runs"))


def consent_register(consents: DataFrame, as_of: str) -> DataFrame:
    """status (withdrawn, expired, active), records."""
    at = F.lit(as_of).cast("timestamp")
    status = F.when(F.col("withdrawn_utc").isNotNull(), "withdrawn").when(F.col("expires_utc").cast("timestamp") <= at, "expired").otherwise("active")
    return consents.groupBy(status.alias("status")).agg(F.count("*").alias("records"))


def track_record(runs: DataFrame) -> DataFrame:
    """runs, passed, pass_rate, last_status of a history (run_utc, status)."""
    return runs.agg(F.count("*").alias("runs"), F.count_if(F.col("status") == "PASS").alias("passed"), F.round(F.avg((F.col("status") == "PASS").cast("int")), 4).alias("pass_rate"), F.max_by("status", "run_utc").alias("last_status"))


def run_metrics(stages: DataFrame) -> DataFrame:
    """stages (stage, rows_in, rows_out, rejects, seconds) with error_rate and rows_per_s."""
    return stages.withColumns({"error_rate": F.round(F.coalesce(F.col("rejects") / F.when(F.col("rows_in") > 0, F.col("rows_in")), F.lit(0.0)), 6), "rows_per_s": F.round(F.coalesce(F.col("rows_in") / F.when(F.col("seconds") > 0, F.col("seconds")), F.lit(0.0)), 3)})
