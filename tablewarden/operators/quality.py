"""Profiles, scores, contracts, expectations and observations. Checks of one table are compiled into one aggregate."""

from __future__ import annotations

import operator
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, StringType

from .aggregates import duplicate_rows
from .selection import distinct_counts, quantiles

QUARTILES = (0.25, 0.5, 0.75)


def _numeric(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, NumericType)


def _text(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, StringType)


PARTS = ("numbers", "texts", "distinct", "quartiles")


def column_statistics(df: DataFrame, columns: Sequence[str] | None = None, digits: int | None = 4, parts: Sequence[str] = PARTS) -> DataFrame:
    """One row a column: rows, nulls, distinct, zero and negative counts, min/max/mean/std/quartiles of numbers, lengths and empty texts.

    Sums come from one aggregate, distinct counts from a second, quartiles by selection (operators.selection); parts says which are
    wanted, the others are null and cost nothing. Means, deviations and quartiles are rounded to so many digits, or not at all.
    """
    cells = []
    none, zero = F.lit(None).cast("double"), F.lit(None).cast("long")
    names = list(columns or df.columns)
    numbers = [c for c in names if _numeric(df, c)]
    r = lambda v: v if digits is None else F.round(v, digits)
    for c in names:
        x = F.col(f"`{c}`")
        num, text = c in numbers and "numbers" in parts, _text(df, c) and "texts" in parts
        d, n = x.cast("double"), F.char_length(x) if text else F.lit(None).cast("int")
        cells.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count("*").alias("rows"),
                F.count_if(x.isNull()).alias("nulls"),
                (F.count_if(d == 0) if num else zero).alias("zeros"),
                (F.count_if(d < 0) if num else zero).alias("negatives"),
                (F.min(d) if num else none).alias("min"),
                (F.max(d) if num else none).alias("max"),
                (r(F.avg(d)) if num else none).alias("mean"),
                (r(F.stddev_samp(d)) if num else none).alias("std"),
                (F.min(n).cast("long") if text else zero).alias("min_length"),
                (F.max(n).cast("long") if text else zero).alias("max_length"),
                (r(F.avg(n)) if text else none).alias("mean_length"),
                (F.count_if(x == "") if text else zero).alias("empty"),
            )
        )
    sums = df.agg(F.array(*cells).alias("x")).select(F.explode("x").alias("x")).select("x.*")
    if "distinct" in parts:
        sums = sums.join(F.broadcast(distinct_counts(df, names)), "column")
    else:
        sums = sums.withColumn("distinct", zero)
    found = quantiles(df, numbers, QUARTILES) if "quartiles" in parts else {}
    # a literal a column and quartile: as many as the schema has
    at = F.create_map(*[x for c, qs in found.items() for x in (F.lit(c), F.array(*[F.lit(q).cast("double") for q in qs]))]) if found else F.lit(None).cast("map<string,array<double>>")
    sums = sums.withColumns({n: r(F.get(at[F.col("column")], i)) for i, n in enumerate(("p25", "p50", "p75"))})
    return sums.select("column", "rows", "nulls", "distinct", "zeros", "negatives", "min", "max", "mean", "std", "p25", "p50", "p75", "min_length", "max_length", "mean_length", "empty")


def profile_table(df: DataFrame) -> DataFrame:
    """rows, columns, duplicates, null_cells."""
    cells = df.groupBy(*df.columns).count()
    nulls = sum([F.col(f"`{c}`").isNull().cast("long") for c in df.columns], F.lit(0))
    return cells.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("rows"), F.lit(len(df.columns)).cast("long").alias("columns"), (F.coalesce(F.sum("count"), F.lit(0)) - F.count("*")).alias("duplicates"), F.coalesce(F.sum(nulls * F.col("count")), F.lit(0)).alias("null_cells"))


def profile_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """column_statistics with null_rate and cardinality."""
    s = column_statistics(df, columns)
    rows = F.when(F.col("rows") > 0, F.col("rows"))
    return s.withColumns({"null_rate": F.round(F.coalesce(F.col("nulls") / rows, F.lit(0.0)), 4), "cardinality": F.round(F.coalesce(F.col("distinct") / rows, F.lit(0.0)), 4)})


def time_range(df: DataFrame, column: str) -> DataFrame:
    """first, last, days of a time column."""
    return df.agg(F.min(column).cast("string").alias("first"), F.max(column).cast("string").alias("last"), F.datediff(F.max(column), F.min(column)).cast("long").alias("days"))


# Weights of the dimensions of the score.
WEIGHTS = {"completeness": 0.30, "uniqueness": 0.20, "validity": 0.25, "consistency": 0.15, "timeliness": 0.10}


def grade(score: Column) -> Column:
    return F.when(score >= 90, "A").when(score >= 80, "B").when(score >= 70, "C").when(score >= 60, "D").otherwise("F")


def quality_score(df: DataFrame, passed: int | None = None, total: int | None = None, as_of: str | None = None, max_days: int = 365, weights: dict[str, float] | None = None) -> DataFrame:
    """rows, the five dimensions (0 to 100), score and grade.

    Completeness: cells that are neither null nor NaN. Uniqueness: rows that repeat no other. Validity: passed of total
    expectations of a validation. Consistency: the mean over numeric columns of the share within three deviations of
    the mean (100 where nothing deviates; columns of fewer than two values do not count). Timeliness: the mean over
    timestamp columns of the share of values at most max_days old at as_of (default: now). What has nothing to
    count is 100. weights are scaled to a sum of 1.
    """
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    value = {c: F.nanvl(F.col(f"`{c}`"), F.lit(None)) if k in ("double", "float") else F.col(f"`{c}`") for c, k in kinds.items()}
    numbers = [c for c in df.columns if _numeric(df, c)]
    times = [c for c, k in kinds.items() if k in ("timestamp", "timestamp_ntz")]
    now = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    old = lambda c: F.floor((now.cast("double") - F.col(f"`{c}`").cast("timestamp").cast("double")) / 86400)
    share = lambda good, n: F.when(n > 0, 100.0 * good / F.when(n > 0, n))
    # one row of as many numbers as the table has columns
    first = df.agg(
        F.count("*").alias("n"),
        *[F.count(value[c]).alias(f"f{i}") for i, c in enumerate(df.columns)],
        *[F.avg(value[c].cast("double")).alias(f"m{i}") for i, c in enumerate(numbers)],
        *[F.stddev_samp(value[c].cast("double")).alias(f"s{i}") for i, c in enumerate(numbers)],
        *[share(F.count_if(old(c) <= max_days), F.count(F.col(f"`{c}`"))).alias(f"t{i}") for i, c in enumerate(times)],
    ).first()
    n, cells = first["n"], first["n"] * len(df.columns)
    complete = 100.0 * sum(first[f"f{i}"] for i in range(len(df.columns))) / cells if cells else 100.0
    fresh = [first[f"t{i}"] for i in range(len(times)) if first[f"t{i}"] is not None]
    shares = [F.lit(100.0) if first[f"s{i}"] == 0 else share(F.count_if(F.abs(value[c].cast("double") - first[f"m{i}"]) <= 3 * first[f"s{i}"]), F.count(value[c])) for i, c in enumerate(numbers) if first[f"s{i}"] is not None]
    consistent = df.agg((sum(shares, F.lit(0.0)) / len(shares) if shares else F.lit(100.0)).alias("c"))
    one = duplicate_rows(df).crossJoin(consistent).select(
        "rows",
        F.round(F.lit(complete), 2).alias("completeness"),
        F.round(F.lit(100.0) - (F.lit(100.0) * F.col("duplicates") / n if n else F.lit(0.0)), 2).alias("uniqueness"),
        F.round(F.lit(100.0 * passed / total if total and passed is not None else 100.0), 2).alias("validity"),
        F.round("c", 2).alias("consistency"),
        F.round(F.lit(sum(fresh) / len(fresh) if fresh else 100.0), 2).alias("timeliness"),
    )
    weights = weights or WEIGHTS
    scale = sum(weights.values()) or 1.0
    score = F.round(sum([F.col(k) * (w / scale) for k, w in weights.items()], F.lit(0.0)), 2)
    return one.withColumn("score", score).withColumn("grade", grade(F.col("score")))


def score_alerts(history: DataFrame, drop: float = 10, floor: float = 60, n: int = 3, dimension_drop: float = 15) -> DataFrame:
    """dataset, observed_utc, score, type, dimension, severity, amount of every alert in a score history.

    SCORE_DROP (amount: the fall; HIGH over twice the limit, else MEDIUM), BELOW_FLOOR (the gap; CRITICAL), ROLLING_DECLINE (the
    fall over the n scores; HIGH), DIMENSION_DROP once a dimension that the history has (HIGH over 1.5 times the limit, else MEDIUM).
    """
    from .windows import against_previous, rolling_decline

    dims = [c for c in WEIGHTS if c in history.columns]
    h = rolling_decline(against_previous(history, ["dataset"], "observed_utc", ["score", *dims]), n)
    h = h.withColumn("_first", F.lag("score", n - 1).over(Window.partitionBy("dataset").orderBy("observed_utc")))

    def one(bad: Column, name: str, severity: Column, amount: Column, dim: str | None = None) -> Column:
        return F.when(bad, F.struct(F.lit(name).alias("type"), F.lit(dim).cast("string").alias("dimension"), severity.alias("severity"), F.round(amount.cast("double"), 2).alias("amount")))

    fall = lambda c, limit, times: F.when(-F.col(f"{c}_change") > limit * times, "HIGH").otherwise("MEDIUM")
    tests = F.array(
        one(F.col("score_change") < -drop, "SCORE_DROP", fall("score", drop, 2), -F.col("score_change")),
        one(F.col("score") < floor, "BELOW_FLOOR", F.lit("CRITICAL"), F.lit(floor) - F.col("score")),
        one(F.col("declining"), "ROLLING_DECLINE", F.lit("HIGH"), F.col("_first") - F.col("score")),
        *[one(F.col(f"{c}_change") < -dimension_drop, "DIMENSION_DROP", fall(c, dimension_drop, 1.5), -F.col(f"{c}_change"), c) for c in dims],
    )
    return h.select("dataset", "observed_utc", "score", F.explode(F.filter(tests, lambda x: x.isNotNull())).alias("x")).select("dataset", "observed_utc", "score", "x.*")


# --- contracts and expectations ----------------------------------------------------------------------------


def failing_rows(df: DataFrame, rule: str, column: str, value=None) -> Column:
    """Rows that break a row rule; nulls break only not_null."""
    c = F.col(column)
    text = c.cast("string")
    tests = {
        "not_null": lambda: c.isNull(),
        "min": lambda: c.cast("double") < float(value),
        "max": lambda: c.cast("double") > float(value),
        "between": lambda: ~c.cast("double").between(*map(float, value)),
        "min_length": lambda: F.char_length(text) < value,
        "max_length": lambda: F.char_length(text) > value,
        "pattern": lambda: ~text.rlike(value),
        "allowed": lambda: ~text.isin(*[str(v) for v in value]),
    }
    return F.coalesce(tests[rule](), F.lit(False))


# Clauses that a contract may hold, by part; whatever else it holds is refused.
CLAUSES = {
    "contract": {"sla", "quality", "schema", "rules", "null_ratio"},
    "sla": {"min_rows", "max_rows", "freshness", "max_seconds"},
    "freshness": {"column", "hours"},
    "quality": {"min_score", *(f"min_{d}" for d in WEIGHTS)},
    "schema": {"required", "forbidden", "no_extra", "columns"},
    "column": {"type", "not_null", "unique", "min", "max", "between", "min_length", "max_length", "pattern", "allowed"},
    "rule": {"name", "column", "condition", "description"},
}
_CONDITION = re.compile(r"\s*(>=|<=|!=|==|>|<)\s*(-?\d+\.?\d*)\s*")
_HOLDS = {">": operator.gt, "<": operator.lt, ">=": operator.ge, "<=": operator.le, "==": operator.eq, "!=": operator.ne}


def check_clauses(contract: dict) -> None:
    """Raises on clauses, column rules and conditions that check_contract does not know."""
    sla, schema, rules = contract.get("sla", {}), contract.get("schema", {}), contract.get("rules", [])
    parts = [("contract", contract), ("sla", sla), ("freshness", sla.get("freshness", {})), ("quality", contract.get("quality", {})), ("schema", schema)]
    for part, given in parts + [("column", r) for r in schema.get("columns", {}).values()] + [("rule", r) for r in rules]:
        if unknown := sorted(set(given) - CLAUSES[part]):
            raise ValueError(f"unknown clauses in {part}: {', '.join(unknown)}")
    for r in rules:
        if "column" not in r or not _CONDITION.fullmatch(r.get("condition", "")):
            raise ValueError(f"a rule needs a column and a condition of operator and number: {r}")


def check_contract(df: DataFrame, contract: dict, as_of: str | None = None, report: DataFrame | dict | None = None, elapsed: float | None = None) -> DataFrame:
    """clause, column, rule, expected, actual, severity of every violation; all data clauses in one aggregate.

    contract: {sla: {min_rows, max_rows, freshness: {column, hours}, max_seconds}, quality: {min_score, min_completeness, ...}, schema: {required, forbidden, no_extra, columns: {name: {type, not_null, unique, min, max, min_length, max_length, pattern, allowed}}}, rules: [{name, column, condition: "op number"}], null_ratio}

    A rule is over the values that are numbers. Quality floors are held against `report` (the row of quality_score),
    max_seconds against `elapsed`, freshness against `as_of`: a clause whose value is not given raises, as do unknown clauses.
    """
    check_clauses(contract)
    spark, sla, schema, floors = df.sparkSession, contract.get("sla", {}), contract.get("schema", {}), contract.get("quality", {})
    for name, clause, given in (("freshness", "freshness" in sla, as_of), ("max_seconds", "max_seconds" in sla, elapsed), ("quality", floors, report)):
        if clause and given is None:
            raise ValueError(f"the contract's {name} clause can't be checked: its value is not given")
    cols, static = schema.get("columns", {}), []
    for c in schema.get("required", []):
        if c not in df.columns:
            static.append(("schema", c, "required", "present", "absent", "HIGH"))
    for c in schema.get("forbidden", []):
        if c in df.columns:
            static.append(("schema", c, "forbidden", "absent", "present", "HIGH"))
    if schema.get("no_extra"):
        static += [("schema", c, "extra", "absent", "present", "LOW") for c in df.columns if c not in cols and c not in schema.get("required", [])]
    checks: list[tuple[str, str | None, str, str, Column, Column, str]] = []  # clause, column, rule, expected, violated, actual
    rows = F.count("*")
    if "min_rows" in sla:
        checks.append(("sla", None, "min_rows", str(sla["min_rows"]), rows < sla["min_rows"], rows, "HIGH"))
    if "max_rows" in sla:
        checks.append(("sla", None, "max_rows", str(sla["max_rows"]), rows > sla["max_rows"], rows, "MEDIUM"))
    if "max_seconds" in sla:
        checks.append(("sla", None, "max_seconds", str(sla["max_seconds"]), F.lit(float(elapsed) > sla["max_seconds"]), F.lit(round(float(elapsed), 1)), "HIGH"))
    if floors:
        found = (report.first() if isinstance(report, DataFrame) else report) or {}
        found = found if isinstance(found, dict) else found.asDict()
        for rule, least in floors.items():
            if (actual := found.get(rule.removeprefix("min_"))) is None:
                raise ValueError(f"the report has no {rule.removeprefix('min_')}")
            checks.append(("quality", None, rule, str(least), F.lit(float(actual) < least), F.lit(float(actual)), "HIGH"))
    if "freshness" in sla:
        f = sla["freshness"]
        hours = (F.lit(as_of).cast("timestamp").cast("long") - F.max(f["column"]).cast("timestamp").cast("long")) / 3600
        checks.append(("sla", f["column"], "freshness", str(f["hours"]), F.coalesce(hours > f["hours"], F.lit(True)), F.round(hours, 2), "HIGH"))
    for c, rules in cols.items():
        if c not in df.columns:
            continue
        for rule, value in rules.items():
            if rule == "type":
                if df.schema[c].dataType.simpleString() != value:
                    static.append(("schema", c, "type", value, df.schema[c].dataType.simpleString(), "MEDIUM"))
            elif rule == "unique":
                if value:
                    bad = F.count(c) - F.count_distinct(c)
                    checks.append(("schema", c, "unique", "0", bad > 0, bad, "HIGH"))
            elif value is not False:
                bad = F.count_if(failing_rows(df, rule, c, value))
                checks.append(("schema", c, rule, str(value), bad > 0, bad, "HIGH" if rule == "not_null" else "MEDIUM"))
    for r in contract.get("rules", []):
        c, (op, limit) = r["column"], _CONDITION.fullmatch(r["condition"]).groups()
        if c not in df.columns:
            static.append(("rules", c, r.get("name", "rule"), r["condition"], "absent", "HIGH"))
            continue
        x = F.col(f"`{c}`").try_cast("double")
        bad = F.count_if(~F.isnan(x) & ~_HOLDS[op](x, float(limit)))
        checks.append(("rules", c, r.get("name", "rule"), r["condition"], bad > 0, bad, "HIGH"))
    if "null_ratio" in contract:
        nulls = sum([F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns], F.lit(0)) / F.when(rows > 0, rows * len(df.columns))
        checks.append(("rules", None, "null_ratio", str(contract["null_ratio"]), F.coalesce(nulls > contract["null_ratio"], F.lit(False)), F.round(nulls, 6), "MEDIUM"))
    kind = "clause string, column string, rule string, expected string, actual string, severity string"
    out = spark.createDataFrame(static, kind)
    if checks:
        found = [F.when(bad, F.struct(F.lit(a).alias("clause"), F.lit(b).cast("string").alias("column"), F.lit(r).alias("rule"), F.lit(e).alias("expected"), actual.cast("string").alias("actual"), F.lit(s).alias("severity"))) for a, b, r, e, bad, actual, s in checks]
        out = out.unionByName(df.agg(F.array(*found).alias("x")).select(F.explode("x").alias("x")).filter("x is not null").select("x.*"))
    return out


def enforce_contract(df: DataFrame, contract: dict, as_of: str | None = None, warn_only: bool = False, report: DataFrame | dict | None = None, elapsed: float | None = None) -> DataFrame:
    bad = check_contract(df, contract, as_of, report, elapsed)
    if not warn_only and bad.filter("severity = 'HIGH'").limit(1).count():
        raise ValueError("the contract is broken")
    return bad


def build_suite(df: DataFrame) -> DataFrame:
    """column, expectation, lo, hi: exists; not_null where nothing is null; between min and max, half their range wider."""
    s = column_statistics(df, [c for c in df.columns if not isinstance(df.schema[c].dataType, BooleanType)])
    half = (F.col("max") - F.col("min")) / 2
    none = F.lit(None).cast("double")
    one = lambda name, lo, hi: F.struct(F.lit(name).alias("expectation"), lo.alias("lo"), hi.alias("hi"))
    found = F.array(one("exists", none, none), F.when(F.col("nulls") == 0, one("not_null", none, none)), F.when(F.col("min").isNotNull(), one("between", F.col("min") - half, F.col("max") + half)))
    return s.select("column", F.explode(F.filter(found, lambda x: x.isNotNull())).alias("x")).select("column", "x.*")


def run_suite(df: DataFrame, expectations: Sequence[dict]) -> tuple[DataFrame, DataFrame]:
    """(results, failing rows with _reasons) of [{column, rule, value}]: row rules, unique and min_rows."""
    tests, rows, reasons = [], F.count("*"), []
    for e in expectations:
        c, rule, value = e.get("column"), e["rule"], e.get("value")
        name = f"{c or 'table'}:{rule}"
        if rule == "min_rows":
            bad, n = rows < value, rows
        elif rule == "unique":
            n = F.count(c) - F.count_distinct(c)
            bad = n > 0
        else:
            broken = failing_rows(df, rule, c, value)
            n = F.count_if(broken)
            bad = n > 0
            reasons.append(F.when(broken, F.lit(name)))
        tests.append(F.struct(F.lit(name).alias("expectation"), (~bad).alias("passed"), n.cast("long").alias("observed")))
    results = df.agg(F.array(*tests).alias("x")).select(F.explode("x").alias("x")).select("x.*")
    marked = df.withColumn("_reasons", F.array_join(F.array(*reasons), ",") if reasons else F.lit(""))
    return results, marked.filter("_reasons <> ''")


def expectations_from_profile(profile: DataFrame, null_slack: float = 0.05, few: int = 20) -> DataFrame:
    """column, rule, lo, hi of a column profile: null rate with slack, ranges a tenth wider, lengths half longer, low cardinality, rows 0.5 to 2 times."""
    span = (F.col("max") - F.col("min")) * 0.1
    none = F.lit(None).cast("double")
    one = lambda name, lo, hi: F.struct(F.lit(name).alias("rule"), F.round(lo.cast("double"), 4).alias("lo"), F.round(hi.cast("double"), 4).alias("hi"))
    found = F.array(
        one("null_rate", none, F.least(F.lit(1.0), F.col("null_rate") + null_slack)),
        F.when(F.col("min").isNotNull(), one("range", F.col("min") - span, F.col("max") + span)),
        F.when(F.col("max_length").isNotNull(), one("length", none, F.ceil(F.col("max_length") * 1.5))),
        F.when(F.col("distinct") <= few, one("distinct", none, F.col("distinct"))),
        one("rows", F.floor(F.col("rows") * 0.5), F.col("rows") * 2),
    )
    return profile.select("column", F.explode(F.filter(found, lambda x: x.isNotNull())).alias("x")).select("column", "x.*")


# --- observation ---------------------------------------------------------------------------------------------


def freshness(df: DataFrame, column: str, as_of: str, hours: float) -> DataFrame:
    """newest, age_hours, severity: HIGH over three times the threshold, MEDIUM over it, else OK."""
    one = df.agg(F.max(column).cast("timestamp").alias("t"))
    age = F.round((F.lit(as_of).cast("timestamp").cast("long") - F.col("t").cast("long")) / 3600, 4)
    return one.select(F.date_format("t", "yyyy-MM-dd HH:mm:ss").alias("newest"), age.alias("age_hours"), F.when(age > 3 * hours, "HIGH").when(age > hours, "MEDIUM").otherwise("OK").alias("severity"))


def volume_alerts(observations: DataFrame, threshold: float = 0.5, n: int = 5) -> DataFrame:
    """deviation from the mean of the n observations before; severity HIGH over twice the threshold."""
    from .windows import volume_baseline

    dev = F.abs(F.col("row_count") - F.col("baseline")) / F.when(F.col("baseline") > 0, F.col("baseline"))
    return volume_baseline(observations, n).withColumn("deviation", F.round(dev, 4)).withColumn("severity", F.when(dev > 2 * threshold, "HIGH").when(dev > threshold, "MEDIUM").otherwise("OK"))


def mean_drift(now: DataFrame, previous: DataFrame, threshold: float = 0.1) -> DataFrame:
    """column, drift, severity: change of the mean over the larger deviation; MEDIUM over 10, HIGH over 20 times the threshold, else OK.

    now, previous: column_statistics, which should not be rounded (digits=None), or columns of small numbers never drift. Columns
    that have no mean in either, or do not vary in either, are left out; of one value the deviation is 0.
    """
    p = previous.select("column", F.col("mean").alias("_mean"), F.coalesce("std", F.lit(0.0)).alias("_std"))
    n = now.select("column", "mean", F.coalesce("std", F.lit(0.0)).alias("std"))
    drift = F.abs(F.col("mean") - F.col("_mean")) / F.greatest("std", "_std", F.lit(1e-10))
    both = n.join(p, "column").filter("mean is not null and _mean is not null and (std > 0 or _std > 0)")
    return both.select("column", F.round(drift, 4).alias("drift"), F.when(drift > threshold * 20, "HIGH").when(drift > threshold * 10, "MEDIUM").otherwise("OK").alias("severity"))


def null_alerts(df: DataFrame, critical: Sequence[str] = (), floor: float = 0.5, previous: dict[str, float] | None = None, spike: float = 0.2) -> DataFrame:
    """column, alert, severity, previous_rate, null_rate of the critical fields, or of all columns if none are named.

    NULL_SPIKE: the rate rose by more than `spike` since the rates before; HIGH at more than twice that, or for a
    critical field over the floor. NULL_FLOOR (HIGH): a critical field is absent, or over the floor without a spike.
    """
    schema = "column string, alert string, severity string, previous_rate double, null_rate double"
    absent = df.sparkSession.createDataFrame([(c, "NULL_FLOOR", "HIGH", None, 1.0) for c in critical if c not in df.columns], schema)
    parts = []
    for c in (c for c in (critical or df.columns) if c in df.columns):
        rate = F.coalesce(F.avg(F.col(f"`{c}`").isNull().cast("int")), F.lit(0.0))
        before = F.lit((previous or {}).get(c)).cast("double")
        jump, low = F.coalesce(rate - before, F.lit(0.0)), F.lit(c in critical) & (rate > floor)
        alert = F.when(jump > spike, "NULL_SPIKE").when(low, "NULL_FLOOR")
        severity = F.when((jump > spike) & ~((jump > 2 * spike) | low), "MEDIUM").otherwise("HIGH")
        parts.append(F.struct(F.lit(c).alias("column"), alert.alias("alert"), severity.alias("severity"), F.when(jump > spike, F.round(before, 4)).alias("previous_rate"), F.round(rate, 4).alias("null_rate")))
    if not parts:
        return absent
    return df.agg(F.array(*parts).alias("x")).select(F.explode("x").alias("x")).select("x.*").filter("alert is not null").unionByName(absent)


def observe(df: DataFrame, dataset: str, observed: str, columns: Sequence[str] | None = None) -> DataFrame:
    """dataset, observed_utc, row_count, column_count, column_stats: one row for the history."""
    s = column_statistics(df, columns, parts=("numbers",))
    return s.agg(F.max("rows").alias("row_count"), F.array_sort(F.collect_list(F.struct("column", "nulls", "mean", "std"))).alias("column_stats")).select(F.lit(dataset).alias("dataset"), F.lit(observed).alias("observed_utc"), "row_count", F.lit(len(df.columns)).alias("column_count"), "column_stats")


def null_rates(df: DataFrame, by: str | None = None) -> DataFrame:
    """(by,) rows, null_rates: the share of nulls of every column, as a map; one aggregate."""
    columns = [c for c in df.columns if c != by]
    rates = F.create_map(*[x for c in columns for x in (F.lit(c), F.avg(F.col(f"`{c}`").isNull().cast("int")))]) if columns else F.create_map().cast("map<string,double>")
    return df.groupBy(*([by] if by else [])).agg(F.count("*").alias("rows"), rates.alias("null_rates"))


def baseline_anomalies(now: DataFrame, baseline: DataFrame) -> DataFrame:
    """dataset, check, column, expected, actual of what is beyond its dataset's baseline.

    now: dataset, rows, null_rates (map by column). baseline: dataset, expected_rows, null_rates, and its own tolerances
    row_tolerance (a share of the expected rows; null: 0.2) and null_tolerance (null: 0.05). ROW_COUNT: rows beyond the tolerance.
    NULL_RATE: a column whose rate differs by more. Rows that are not expected, columns that are not there and datasets
    without a baseline are not compared.
    """
    b = baseline.select("dataset", F.col("expected_rows").alias("_rows"), F.col("null_rates").alias("_rates"), F.coalesce("row_tolerance", F.lit(0.2)).alias("_t"), F.coalesce("null_tolerance", F.lit(0.05)).alias("_n"))
    both = now.join(b, "dataset")
    found = lambda check, column, expected, actual: F.struct(F.lit(check).alias("check"), column.cast("string").alias("column"), expected.cast("double").alias("expected"), actual.cast("double").alias("actual"))
    outside = (F.col("rows") < F.col("_rows") * (1 - F.col("_t"))) | (F.col("rows") > F.col("_rows") * (1 + F.col("_t")))
    rows = F.when(outside, found("ROW_COUNT", F.lit(None), F.col("_rows"), F.col("rows")))
    rates = F.transform(F.map_entries(F.coalesce("_rates", F.create_map().cast("map<string,double>"))), lambda e: F.when(F.abs(F.try_element_at("null_rates", e["key"]) - e["value"]) > F.col("_n"), found("NULL_RATE", e["key"], e["value"], F.try_element_at("null_rates", e["key"]))))
    return both.select("dataset", F.explode(F.filter(F.concat(F.array(rows), rates), lambda x: x.isNotNull())).alias("x")).select("dataset", "x.*")


def exposition(observations: DataFrame) -> DataFrame:
    """metric, labels, value, line: observations in the text format of metric scrapers."""
    label = F.format_string('dataset="%s"', "dataset")
    table = F.struct(F.lit("table_rows").alias("metric"), label.alias("labels"), F.col("row_count").cast("double").alias("value"))
    cols = F.transform("column_stats", lambda x: F.struct(F.lit("column_nulls").alias("metric"), F.concat(label, F.lit(',column="'), x["column"], F.lit('"')).alias("labels"), x["nulls"].cast("double").alias("value")))
    rows = observations.select(F.explode(F.concat(F.array(table), cols)).alias("x")).select("x.*")
    return rows.withColumn("line", F.concat("metric", F.lit("{"), "labels", F.lit("} "), F.col("value").cast("string")))


def synthesise(spark: SparkSession, profile: DataFrame, n: int, categories: dict[str, Sequence[tuple[str, float]]] | None = None, seed: int = 0) -> DataFrame:
    """n rows after a column profile: numbers uniform in their range, categories by weight, other texts by a template."""
    out = []
    for i, r in enumerate(profile.select("column", "min", "max").collect()):  # one row a column
        c, u = r["column"], F.rand(seed + i)
        weights = (categories or {}).get(c)
        if weights:
            total, run, value = sum(w for _, w in weights), 0.0, F.lit(weights[-1][0])
            bounds = []
            for v, w in weights[:30]:
                run += w / total
                bounds.append((run, v))
            for b, v in reversed(bounds):
                value = F.when(u <= b, F.lit(v)).otherwise(value)
            out.append(value.alias(c))
        elif r["min"] is not None:
            out.append(F.round(F.lit(r["min"]) + u * (r["max"] - r["min"]), 2).alias(c))
        else:
            out.append(F.concat(F.lit(f"{c}_"), F.floor(u * 1_000_000).cast("string")).alias(c))
    return spark.range(n).select(*out)
