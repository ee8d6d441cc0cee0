"""Agreements, controls, catalogues and models as tables that are joined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import pii_columns


def agreement_status(expires: Column, as_of: str, soon: int = 30) -> Column:
    """MISSING, EXPIRED, EXPIRING (within `soon` days), ACTIVE."""
    left = F.datediff(expires.cast("date"), F.lit(as_of).cast("date"))
    return F.when(expires.isNull(), "MISSING").when(left < 0, "EXPIRED").when(left <= soon, "EXPIRING").otherwise("ACTIVE")


def check_agreements(loads: DataFrame, agreements: DataFrame, as_of: str, soon: int = 30) -> DataFrame:
    """loads (load_id, party, data_types) with status, days_left and uncovered types of the party's agreement (expires, data_types)."""
    a = agreements.select("party", F.col("expires").alias("_expires"), F.col("data_types").alias("_covered"))
    none = F.array().cast("array<string>")
    return loads.join(a, "party", "left").select("load_id", "party", agreement_status(F.col("_expires"), as_of, soon).alias("status"), F.datediff(F.col("_expires").cast("date"), F.lit(as_of).cast("date")).alias("days_left"), F.array_join(F.array_sort(F.array_except("data_types", F.coalesce("_covered", none))), ",").alias("uncovered"))


def overdue_reviews(vendors: DataFrame, as_of: str, every: int = 365) -> DataFrame:
    """Vendors whose last review is missing or too old, with high risk first."""
    late = F.datediff(F.lit(as_of).cast("date"), F.col("last_review").cast("date"))
    return vendors.filter(F.col("last_review").isNull() | (late > every)).select("vendor", "risk", late.alias("days"), F.col("has_dpa"))


def control_summary(checks: dict[str, DataFrame]) -> DataFrame:
    """control, status of one-row tables (bad, warn counts): FAIL, WARN or OK."""
    out = None
    for name, df in checks.items():
        part = df.select(F.lit(name).alias("control"), F.when(F.col("bad") > 0, "FAIL").when(F.col("warn") > 0, "WARN").otherwise("OK").alias("status"))
        out = part if out is None else out.unionByName(part)
    return out


def inventory(tables: dict[str, DataFrame], owners: dict[str, dict] | None = None) -> tuple[DataFrame, DataFrame]:
    """(datasets with owner, domain, tenant; columns with type and kind of personal data), from the tables' schemas."""
    spark = next(iter(tables.values())).sparkSession
    datasets, columns = [], []
    for name, df in tables.items():
        o = (owners or {}).get(name, {})
        datasets.append((name, o.get("owner"), o.get("domain"), o.get("tenant"), len(df.columns)))
        found = {r["field"]: r["kind"] for r in pii_columns(df.columns)}
        columns += [(name, f.name, f.dataType.simpleString(), found.get(f.name)) for f in df.schema]
    return spark.createDataFrame(datasets, "dataset string, owner string, domain string, tenant string, columns int"), spark.createDataFrame(columns, "dataset string, column string, type string, pii string")


def search(df: DataFrame, query: str, fields: list[str], tenant: str | None = None) -> DataFrame:
    """Rows that hold words of the query in any field, by number of words found; `hits` and whether all were."""
    words = [w for w in query.lower().split() if w]
    text = F.lower(F.concat_ws(" ", *fields))
    hits = sum([F.contains(text, F.lit(w)).cast("int") for w in words], F.lit(0))
    rows = df.filter(F.col("tenant") == tenant) if tenant is not None else df
    return rows.withColumn("hits", hits).filter("hits > 0").withColumn("all_words", F.col("hits") == len(words))


# Saturation of a term's count, and weight of a text's length.
K1, B = 1.2, 0.75


def build_search_index(df: DataFrame, key: str, fields: list[str], path: str) -> None:
    """Write an inverted index of df's texts under path: `terms` (term, key, count, positions, length), parted by the term, and `texts` (key, text, length).

    Terms are runs of letters and digits, ASCII and others, lower-cased. A term that many texts hold is one row a text, so
    no row grows with the table.
    """
    text = F.lower(F.concat_ws(" ", *fields))
    rows = df.select(F.col(key).alias("key"), text.alias("text"), F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}]+"), F.lit(0)).alias("words"))
    rows = rows.withColumn("length", F.size("words"))
    rows.select("key", "text", "length").write.mode("overwrite").parquet(f"{path}/texts")
    placed = rows.select("key", "length", F.posexplode("words").alias("at", "term")).groupBy("term", "key", "length").agg(F.count("*").alias("count"), F.array_sort(F.collect_list("at")).alias("positions"))
    placed.repartition("term", F.pmod(F.xxhash64("key"), F.lit(16))).sortWithinPartitions("term", "key").write.mode("overwrite").parquet(f"{path}/terms")


def search_index(spark: SparkSession, path: str, query: str, phrase: bool = False) -> DataFrame:
    """key, score, terms (found), all_terms of the texts that hold terms of the query, by BM25; phrase: terms must follow one another.

    Only the query's terms are read (a filter that reaches the files). If no text holds any of them, texts that contain the
    query as it stands are found, with a score of 0.
    """
    import re

    words = re.findall(r"[^\W_]+", query.lower())
    texts = spark.read.parquet(f"{path}/texts")
    found = spark.read.parquet(f"{path}/terms").filter(F.col("term").isin(sorted(set(words))))
    size = texts.agg(F.count("*").alias("_n"), F.avg("length").alias("_mean"))
    often = found.groupBy("term").agg(F.count("*").alias("_df"))  # a row a term of the query
    weight = F.log(1 + (F.col("_n") - F.col("_df") + 0.5) / (F.col("_df") + 0.5))
    part = weight * F.col("count") * (K1 + 1) / (F.col("count") + K1 * (1 - B + B * F.col("length") / F.col("_mean")))
    scored = found.join(F.broadcast(often), "term").crossJoin(F.broadcast(size)).groupBy("key").agg(F.round(F.sum(part), 6).alias("score"), F.count("*").cast("int").alias("terms"), F.map_from_entries(F.collect_list(F.struct("term", "positions"))).alias("_at"))
    if phrase and words:
        starts = F.col("_at")[words[0]]
        for i, w in enumerate(words[1:], 1):
            starts = F.array_intersect(starts, _back(F.col("_at")[w], i))
        scored = scored.filter((F.col("terms") == len(set(words))) & (F.size(starts) > 0))
    scored = scored.select("key", "score", "terms", (F.col("terms") == len(set(words))).alias("all_terms"))
    if phrase or found.limit(1).count():
        return scored
    return texts.filter(F.contains("text", F.lit(query.strip().lower())) if query.strip() else F.lit(False)).select("key", F.lit(0.0).alias("score"), F.lit(0).alias("terms"), F.lit(False).alias("all_terms"))


def _back(positions: Column, n: int) -> Column:
    return F.transform(positions, lambda p: p - n)


def model_impact(models: DataFrame, dataset: str) -> DataFrame:
    """Models (model, version, datasets) that were trained on a dataset."""
    return models.filter(F.array_contains("datasets", dataset)).select("model", "version")


def compare_models(models: DataFrame, model: str, a: int, b: int) -> DataFrame:
    """metric, a, b, change of two versions' metric maps."""
    rows = models.filter((F.col("model") == model) & F.col("version").isin(a, b)).select("version", F.explode("metrics").alias("metric", "value"))
    both = rows.groupBy("metric").agg(F.max(F.when(F.col("version") == a, F.col("value"))).alias("a"), F.max(F.when(F.col("version") == b, F.col("value"))).alias("b"))
    return both.withColumn("change", F.col("b") - F.col("a"))


def import_policies(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """schema, purposes, access and baseline tables of a catalogue export ({datasets: [...]}); of repeated labels the last entry counts."""
    kind = "datasets array<struct<source_label:string,columns:array<string>,dtypes:map<string,string>,column_purposes:map<string,array<string>>,pii_columns:array<string>,allowed_columns:array<string>,purpose:string,expected_row_count:bigint,null_rates:map<string,double>>>"
    rows = spark.read.schema(kind).option("multiLine", "true").json(path).select(F.posexplode("datasets").alias("at", "d"))
    rows = rows.groupBy("d.source_label").agg(F.max_by("d", "at").alias("d")).select("d.*")
    return {
        "schema": rows.select("source_label", F.explode("columns").alias("column")).join(rows.select("source_label", F.explode("dtypes").alias("column", "type")), ["source_label", "column"], "left"),
        "purposes": rows.select("source_label", F.explode("column_purposes").alias("column", "purposes")),
        "access": rows.select("source_label", "purpose", "allowed_columns", "pii_columns"),
        "baseline": rows.select("source_label", F.col("expected_row_count").alias("row_count"), "null_rates"),
    }
