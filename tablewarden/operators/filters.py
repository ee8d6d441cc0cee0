"""Row and column filters: steps, watermarks, policies, retention, erasure, consent."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

# Retention policies and their days (None: kept for ever).
RETENTION_DAYS = {"7_days": 7, "30_days": 30, "90_days": 90, "1_year": 365, "3_years": 1095, "5_years": 1825, "7_years": 2555, "indefinite": None}


def predicate(column: str, op: str, value=None) -> Column:
    """eq neq gt gte lt lte in not_in contains not_null is_null. neq and not_in keep nulls; contains takes a regular expression."""
    c = F.col(column)
    tests: dict[str, Callable[[], Column]] = {
        "eq": lambda: c == F.lit(value),
        "neq": lambda: ~c.eqNullSafe(F.lit(value)),
        "gt": lambda: c > F.lit(value),
        "gte": lambda: c >= F.lit(value),
        "lt": lambda: c < F.lit(value),
        "lte": lambda: c <= F.lit(value),
        "in": lambda: c.isin(*value),
        "not_in": lambda: F.coalesce(~c.isin(*value), F.lit(True)),
        "contains": lambda: c.cast("string").rlike(value),
        "not_null": lambda: c.isNotNull(),
        "is_null": lambda: c.isNull(),
    }
    if op not in tests:
        raise ValueError(f"unknown filter operator: {op}")
    return tests[op]()


def filter_rows(df: DataFrame, column: str, op: str, value=None) -> DataFrame:
    return df.filter(predicate(column, op, value))


def simple_rules(df: DataFrame, rules: Sequence[dict]) -> DataFrame:
    """[{column, op: gt | lt | eq | drop_if_null, value}]; rules on columns that are absent are passed over."""
    for r in rules:
        if r["column"] in df.columns:
            df = df.filter(predicate(r["column"], "not_null" if r["op"] == "drop_if_null" else r["op"], r.get("value")))
    return df


def filter_out(df: DataFrame, column: str, value: str) -> DataFrame:
    """Without rows whose value, as text and whatever its case, is `value`; nulls stay."""
    return df.filter(~F.lower(F.col(column).cast("string")).eqNullSafe(F.lit(str(value).lower())))


def _against(df: DataFrame, column: str, mark) -> tuple[Column, Column] | None:
    """(value, mark) to compare, or None if the mark can't be one for a numeric column."""
    c = F.col(column)
    if isinstance(df.schema[column].dataType, NumericType):
        try:
            return c, F.lit(float(mark))
        except (TypeError, ValueError):
            return None
    if df.schema[column].dataType.typeName() == "string":
        value, at = c.try_cast("timestamp"), F.lit(str(mark)).try_cast("timestamp")
        plain = c > F.lit(str(mark))
        # values that are no times are kept; a mark that is none falls back to comparing texts
        return F.when(at.isNull(), F.when(plain, F.lit(1)).otherwise(F.lit(0))).otherwise(F.when(value.isNull(), F.lit(None).cast("int")).when(value > at, F.lit(1)).when(value < at, F.lit(-1)).otherwise(F.lit(0))), F.lit(0)
    return c, F.lit(mark).cast(df.schema[column].dataType)


def above_mark(df: DataFrame, column: str, mark) -> DataFrame:
    """Rows over the stored mark, and those without a value that can be compared."""
    pair = _against(df, column, mark) if mark is not None else None
    return df if pair is None else df.filter(pair[0].isNull() | (pair[0] > pair[1]))


def late_rows(df: DataFrame, column: str, mark) -> DataFrame:
    """Rows strictly below the mark, for the dead letters; equal ones were seen before."""
    pair = _against(df, column, mark) if mark is not None else None
    return df.limit(0) if pair is None else df.filter(pair[0] < pair[1])


def new_mark(df: DataFrame, column: str, source: str) -> DataFrame:
    """key, mark: the state row after this batch."""
    return df.agg(F.max(column).cast("string").alias("mark")).select(F.lit(f"{source}::{column}").alias("key"), "mark")


def limit_to_purpose(df: DataFrame, allowed: Sequence[str], reject: bool = False) -> DataFrame:
    """Only allowed columns, in the table's order; with reject, others are an error."""
    extra = [c for c in df.columns if c not in set(allowed)]
    if extra and reject:
        raise PermissionError(f"columns outside the purpose: {extra}")
    return df.select(*[c for c in df.columns if c not in extra])


def enforce_role(df: DataFrame, roles: dict[str, dict], role: str | None) -> DataFrame:
    """allow (columns), deny (columns), where (SQL predicate) of the role. No role: no rows. Unknown role: an error."""
    if role is None:
        return df.limit(0)
    if role not in roles:
        raise PermissionError(f"unknown role: {role}")
    policy = roles[role]
    rows = df.filter(policy["where"]) if policy.get("where") else df
    keep = [c for c in df.columns if (not policy.get("allow") or c in policy["allow"]) and c not in policy.get("deny", ())]
    return rows.select(*keep)


def protocol_gate(df: DataFrame, protocols: dict[str, dict], protocol: str, as_of: str) -> DataFrame:
    """The approved columns of a protocol that has not expired; otherwise an error."""
    p = protocols.get(protocol)
    if p is None or p["expires"] < as_of:
        raise PermissionError(f"no valid protocol: {protocol}")
    return limit_to_purpose(df, p["columns"])


def _days(policy: str) -> int | None:
    if policy not in RETENTION_DAYS:
        raise ValueError(f"unknown retention policy: {policy}")
    return RETENTION_DAYS[policy]


def within_retention(df: DataFrame, column: str, policy: str, as_of: str) -> DataFrame:
    """Rows not older than the policy; rows without a time go, unless the policy is indefinite."""
    days = _days(policy)
    at = F.col(column).try_cast("timestamp") if df.schema[column].dataType.typeName() == "string" else F.col(column).cast("timestamp")
    return df if days is None else df.filter(at >= F.lit(as_of).cast("timestamp") - F.make_interval(days=F.lit(days)))


def split_retention(df: DataFrame, column: str, policy: str, as_of: str) -> tuple[DataFrame, DataFrame]:
    """(kept, expired); rows without a time are kept, for they can't be shown to be old."""
    days = _days(policy)
    if days is None:
        return df, df.limit(0)
    old = F.coalesce(F.col(column).cast("timestamp") < F.lit(as_of).cast("timestamp") - F.make_interval(days=F.lit(days)), F.lit(False))
    return df.filter(~old), df.filter(old)


def enforce_retention(df: DataFrame, column: str, policy: str, as_of: str, kept: str, archive: str | None = None, dry_run: bool = False) -> DataFrame:
    """Rewrites what is kept to `kept`, writes what expired to `archive`; returns policy, rows, expired, dry_run."""
    stay, gone = split_retention(df, column, policy, as_of)
    if not dry_run:
        if archive:
            gone.write.mode("append").parquet(archive)
        stay.write.mode("overwrite").parquet(kept)
    return df.agg(F.count("*").alias("rows")).crossJoin(gone.agg(F.count("*").alias("expired"))).select(F.lit(policy).alias("policy"), "rows", "expired", F.lit(dry_run).alias("dry_run"))


def sweep_retention(tables: dict[str, tuple[DataFrame, str, str]], as_of: str) -> DataFrame:
    """table, policy, rows, expired of {table: (rows, time column, policy)}."""
    parts = []
    for name, (df, column, policy) in tables.items():
        days = _days(policy)
        old = F.lit(False) if days is None else F.col(column).cast("timestamp") < F.lit(as_of).cast("timestamp") - F.make_interval(days=F.lit(days))
        parts.append(df.agg(F.count("*").alias("rows"), F.count_if(old).alias("expired")).select(F.lit(name).alias("table"), F.lit(policy).alias("policy"), "rows", "expired"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def erase(df: DataFrame, subjects: DataFrame, column: str, blank: Sequence[str] | None = None) -> DataFrame:
    """Without the subjects' rows, or with these columns of theirs set to null. subjects: one column of that name."""
    keys = subjects.select(F.col(column).alias("_subject")).distinct()
    if blank is None:
        return df.join(keys, F.col(column) == F.col("_subject"), "left_anti")
    rows = df.join(keys.withColumn("_hit", F.lit(True)), F.col(column) == F.col("_subject"), "left")
    return rows.withColumns({c: F.when(F.col("_hit").isNull(), F.col(c)) for c in blank}).select(*df.columns)
