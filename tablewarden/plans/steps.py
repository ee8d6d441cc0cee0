"""Declarative step pipelines, governed loads and the gate before them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import sanitise_all
from ..functions.values import changed, flag, map_values, text_rule
from ..operators import aggregates, columns, diffs, filters, joins, privacy, quality, windows

Step = Callable[[DataFrame, dict], DataFrame]


def _order(cfg: dict) -> list:
    return [F.col(c) for c in cfg.get("order", [])]


def _fill(df: DataFrame, cfg: dict) -> DataFrame:
    how, cols = cfg.get("strategy", "value"), cfg.get("columns") or df.columns
    if how == "value":
        return columns.fill_nulls(df, {c: cfg["value"] for c in cols})
    if how in ("mean", "median"):
        return columns.fill_statistic(df, cols, how)
    return windows.fill_along(df, cols, how, _order(cfg), cfg.get("by", ()))


def _reference(df: DataFrame, cfg: dict) -> DataFrame:
    return joins.check_reference(df, cfg["column"], cfg["reference"], cfg["key"])[0]


STEPS: dict[str, Step] = {
    "filter": lambda df, c: filters.filter_rows(df, c["column"], c["op"], c.get("value")),
    "deduplicate": lambda df, c: aggregates.deduplicate(df, c.get("subset") or df.columns, c.get("keep", "first"), _order(c) or [F.col(x) for x in c.get("subset") or df.columns]),
    "aggregate": lambda df, c: aggregates.aggregate(df, c["group_by"], c["aggs"]),
    "sort": lambda df, c: windows.sort(df, c["by"], c.get("ascending", True)),
    "rename": lambda df, c: columns.rename(df, c["mapping"]),
    "drop_columns": lambda df, c: columns.drop_columns(df, c["columns"]),
    "fill_nulls": _fill,
    "type_coerce": lambda df, c: columns.coerce_columns(df, c["types"]),
    "mask_pii": lambda df, c: privacy.short_mask(df, c["columns"]),
    "derive": lambda df, c: columns.derive(df, c["name"], c["expression"]),
    "standardise": lambda df, c: df.withColumns({k: text_rule(F.col(k), r) for k, r in c["rules"].items() if k in df.columns}),
    "map_values": lambda df, c: df.withColumn(c["column"], map_values(F.col(c["column"]), c["mapping"])),
    "flag": lambda df, c: df.withColumn(c["name"], flag(F.col(c["column"]), c["op"], c["value"])),
    "filter_out": lambda df, c: filters.filter_out(df, c["column"], c["value"]),
    "enrich": lambda df, c: joins.enrich(df, c["lookup"], c["on"], c.get("key", c["on"]), c["columns"], _order(c)),
    "referential_integrity": _reference,
    "flatten": lambda df, c: columns.flatten(df, c.get("sep", "__"), c.get("depth", 10)),
}
STEPS["standardize"] = STEPS["standardise"]


def run_steps(df: DataFrame, steps: Sequence[dict], registry: dict[str, Step] | None = None) -> tuple[DataFrame, list[dict]]:
    """df after all steps, and one note a step: ok, skipped (unknown) or failed (on_error warn goes on, halt raises). No step runs a job of its own to count rows."""
    known, notes = STEPS | (registry or {}), []
    for s in steps:
        if s["type"] not in known:
            notes.append({"step": s["type"], "status": "skipped"})
            continue
        try:
            df = known[s["type"]](df, s)
            df.schema  # unknown columns show here  # noqa: B018
            notes.append({"step": s["type"], "status": "ok"})
        except Exception as e:
            if s.get("on_error", "halt") == "halt":
                raise
            notes.append({"step": s["type"], "status": "failed", "error": str(e)[:200]})
    return df, notes


def standardise_counts(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """column, changed: how many values the rules change, in one pass."""
    parts = [F.struct(F.lit(c).alias("column"), changed(F.col(c), text_rule(F.col(c), r)).alias("changed")) for c, r in rules.items()]
    return df.agg(F.array(*parts).alias("x")).select(F.explode("x").alias("x")).select("x.*")


def govern(df: DataFrame, run_id: str, loaded_at: str, strategy: str = "mask", overrides: dict[str, str] | None = None, drop: Sequence[str] = ()) -> DataFrame:
    """The flow of a governed load: flatten, drop, personal data, empty rows, repeated rows, names, stamps."""
    if columns.nested_columns(df):
        df = columns.flatten(df)
    df = privacy.apply_strategy(df.drop(*drop), strategy, overrides)
    return columns.stamp(sanitise_all(columns.drop_empty_rows(df).dropDuplicates()), run_id, loaded_at)


def gate(df: DataFrame, spark: SparkSession, known_columns: Sequence[str], baseline: dict, allowed: Sequence[str], contract: dict, consents: DataFrame | None = None, subject: str | None = None, purpose: str = "", as_of: str = "", report: DataFrame | dict | None = None, elapsed: float | None = None) -> DataFrame:
    """check, findings, status: schema, baseline, purpose, contract and consent, in this order.

    baseline: expected_rows, null_rates by column, row_tolerance, null_tolerance; what it lacks is not compared or has its default.
    """
    expected = spark.createDataFrame([("", baseline.get("expected_rows"), baseline.get("null_rates") or {}, baseline.get("row_tolerance"), baseline.get("null_tolerance"))], "dataset string, expected_rows long, null_rates map<string,double>, row_tolerance double, null_tolerance double")
    one = lambda name, d, hard: d.agg(F.count("*").alias("findings")).select(F.lit(name).alias("check"), "findings", F.when(F.col("findings") == 0, "PASS").otherwise("FAIL" if hard else "WARN").alias("status"))
    parts = [
        one("schema", diffs.schema_diff(spark, known_columns, df.columns), False),
        one("baseline", quality.baseline_anomalies(quality.null_rates(df).withColumn("dataset", F.lit("")), expected), False),
        one("purpose", spark.createDataFrame([(c,) for c in df.columns if c not in allowed], "column string"), True),
        one("contract", quality.check_contract(df, contract, as_of or None, report, elapsed), True),
    ]
    if consents is not None:
        parts.append(one("consent", joins.with_consent(df, subject, consents, purpose, as_of, without=True), True))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
