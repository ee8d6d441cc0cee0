"""Lookups, key checks, consent and subject requests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order; the order must be given."""
    if not order:
        raise ValueError("an order is needed to say which row is first")
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def enrich(df: DataFrame, lookup: DataFrame, on: str, key: str, columns: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Left join to the first lookup row of a key (null matches null); a name that is taken gets _lookup."""
    one = first_per_key(lookup.select(key, *[c for c in columns if c != key]), [key], order)
    names = {c: f"{c}_lookup" if c in df.columns else c for c in columns if c != key}
    one = one.select(F.col(key).alias("_key"), *[F.col(c).alias(n) for c, n in names.items()])
    return df.join(one, F.col(on).eqNullSafe(F.col("_key")), "left").drop("_key")


def match_rate(df: DataFrame, lookup: DataFrame, on: str, key: str) -> DataFrame:
    """rows, matched, match_rate."""
    keys = lookup.select(F.col(key).alias("_key")).distinct().withColumn("_hit", F.lit(1))
    return df.join(keys, F.col(on) == F.col("_key"), "left").agg(F.count("*").alias("rows"), F.count("_hit").alias("matched"), F.round(F.count("_hit") / F.count("*"), 4).alias("match_rate"))


def enrich_all(df: DataFrame, lookups: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Left joins by a column of one name; several lookup rows give several rows."""
    for lookup, on in lookups:
        df = df.join(lookup, on, "left")
    return df


def check_reference(df: DataFrame, column: str, reference: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(clean, violations) by the foreign key as text; a null key is a violation."""
    keys = reference.select(F.col(key).cast("string").alias("_key")).distinct()
    on = F.col(column).cast("string") == F.col("_key")
    return df.join(keys, on, "left_semi"), df.join(keys, on, "left_anti")


def decode_codes(df: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """For every column X_C with a table (code, name) under X: X_NAME."""
    for base, codes in tables.items():
        if f"{base}_C" in df.columns:
            names = codes.select(F.col("code").alias("_code"), F.col("name").alias(f"{base}_NAME"))
            df = df.join(names, F.col(f"{base}_C").cast("string") == F.col("_code").cast("string"), "left").drop("_code")
    return df


def latest_consent(consents: DataFrame) -> DataFrame:
    """The last grant of each subject and purpose."""
    return first_per_key(consents, ["subject_hash", "purpose"], [F.col("granted_utc").desc(), F.col("version").desc()])


def active_consent(consents: DataFrame, purpose: str, as_of: str) -> DataFrame:
    """Subjects whose last grant for the purpose is neither withdrawn nor expired."""
    at = F.lit(as_of).cast("timestamp")
    last = latest_consent(consents.filter(F.col("purpose") == purpose))
    return last.filter(F.col("withdrawn_utc").isNull() & (F.col("expires_utc").isNull() | (F.col("expires_utc").cast("timestamp") > at))).select("subject_hash")


def with_consent(df: DataFrame, column: str, consents: DataFrame, purpose: str, as_of: str, without: bool = False) -> DataFrame:
    """Rows whose subject (or its hash) has consent; or the others."""
    held = active_consent(consents, purpose, as_of)
    return df.join(held, subject_hash(F.col(column)) == F.col("subject_hash"), "left_anti" if without else "left_semi")


def subject_hash(c: Column) -> Column:
    return F.substring(F.sha2(c.cast("string"), 256), 1, 16)


def subject_rows(tables: dict[str, tuple[DataFrame, str]], requests: DataFrame, hashed: bool = True) -> DataFrame:
    """_source, subject_id, row (JSON): the rows of all tables that hold a requested subject, plain or by its hash."""
    ids = requests.select(F.col("subject_id").cast("string").alias("subject_id")).distinct()
    keys = ids.select("subject_id", F.explode(F.array("subject_id", subject_hash(F.col("subject_id"))) if hashed else F.array("subject_id")).alias("_key"))
    out = None
    for name, (df, column) in tables.items():
        rows = df.select(F.to_json(F.struct(*df.columns)).alias("row"), F.col(column).cast("string").alias("_value")).join(keys, F.col("_value") == F.col("_key"))
        part = rows.select(F.lit(name).alias("_source"), "subject_id", "row")
        out = part if out is None else out.unionByName(part)
    return out


def concept_ids(df: DataFrame, code: str, vocabulary: str | Column, concepts: DataFrame, name: str) -> DataFrame:
    """concept_id of (code, vocabulary), the smallest if there are several, 0 if there is none."""
    one = concepts.groupBy("source_code", "source_vocabulary_id").agg(F.min("concept_id").alias(name))
    v = F.lit(vocabulary) if isinstance(vocabulary, str) else vocabulary
    on = (F.col(code) == F.col("source_code")) & (v == F.col("source_vocabulary_id"))
    return df.join(one, on, "left").withColumn(name, F.coalesce(name, F.lit(0))).drop("source_code", "source_vocabulary_id")


def dated_details(heads: DataFrame, details: DataFrame, key: str, date: str, start: str, end: str) -> DataFrame:
    """Inner join of details to the heads of a date range."""
    return heads.filter(F.col(date).between(start, end)).join(details, key)
