"""Readers. Formats are named, or found by the file's extension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.names import check_identifier
from ..operators.columns import flatten
from . import sqlite

# Extensions of formats and of codecs that Spark opens by itself.
FORMATS = {"csv": "csv", "tsv": "tsv", "json": "json", "jsonl": "jsonl", "ndjson": "jsonl", "xml": "xml", "parquet": "parquet", "orc": "orc", "avro": "avro", "fw": "fixed"}
CODECS = ("gz", "bz2", "zst")


def inner_format(path: str) -> str:
    """The format by the extension, under a codec's if there is one."""
    parts = path.rsplit("/", 1)[-1].lower().split(".")
    if parts[-1] in CODECS:
        parts.pop()
    if parts[-1] not in FORMATS:
        raise ValueError(f"unknown format: {path}")
    return FORMATS[parts[-1]]


def read(spark: SparkSession, path: str | Sequence[str], form: str | None = None, schema: StructType | str | None = None, fields: Sequence[tuple[str, int, int]] = (), row_tag: str = "row", flat: bool = True) -> DataFrame:
    """One table of a path or of many. fields: (name, start from 1, length) of fixed-width text."""
    paths = [path] if isinstance(path, str) else [*path]
    form = form or inner_format(paths[0])
    r = spark.read.schema(schema) if schema else spark.read
    match form:
        case "csv" | "tsv":
            return r.options(header=True, inferSchema=schema is None, sep="\t" if form == "tsv" else ",").csv(paths)
        case "json" | "jsonl":
            df = r.option("multiLine", form == "json").json(paths)
        case "xml":
            df = r.format("xml").option("rowTag", row_tag).load(",".join(paths))
        case "parquet":
            return r.parquet(*paths)
        case "orc":
            return r.orc(paths)
        case "fixed":
            return spark.read.text(paths).select(*[F.trim(F.substring("value", s, n)).alias(name) for name, s, n in fields])
        case "avro":
            return r.format("avro").load(paths)  # needs the spark-avro package
        case _:
            raise ValueError(f"unknown format: {form}")
    return flatten(df) if flat else df


def quoted(spark: SparkSession, url: str, name: str) -> str:
    """A checked column name in the quotes of the database."""
    return spark.sparkContext._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(check_identifier(name))


def read_database(spark: SparkSession, url: str, table: str | None = None, query: str | None = None, columns: Sequence[str] = (), where: str | None = None, key: str | None = None, bounds: tuple[int, int] | None = None, partitions: int = 8, ordered: bool = False, **options: str) -> DataFrame:
    """A table or query of a JDBC source, or a table of a SQLite file (see sources.sqlite); columns and the filter go to the source.

    A numeric key reads it in parts; its bounds are asked of the source unless given. ordered: by the key, else by all columns.
    """
    if sqlite.is_file(url):
        if query or bounds or not table:
            raise ValueError("a database file is read by table, and asked for its bounds")
        parts = sqlite.ranges(url, table, check_identifier(key), partitions, where) if key else [where or "1 = 1"]
        df = sqlite.read(spark, url, table, columns, parts)
        return df.orderBy(*([key] if key else df.columns)) if ordered else df
    source = f"({query}) q" if query else table
    read = lambda what: spark.read.format("jdbc").options(url=url, dbtable=what, **options)
    if key and not bounds:
        name = quoted(spark, url, key)
        found = read(f"(SELECT min({name}) AS lo, max({name}) AS hi FROM {source}) b").load().first()
        bounds = (found[0], found[1]) if isinstance(found[0], int) and found[0] < found[1] else None
    r = read(source)
    if key and bounds:
        r = r.options(partitionColumn=key, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions)
    df = r.load()
    if where:
        df = df.filter(where)
    df = df.select(*columns) if columns else df
    return df.orderBy(*([key] if key else df.columns)) if ordered else df


def fingerprints(spark: SparkSession, path: str, form: str | None = None) -> DataFrame:
    """file, bytes, sha256 of every file; of a named row format also its rows and columns. A file is hashed in one value, so of 2 GB at most."""
    found = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    if not form:
        return found
    rows = read_files(spark, [path], form)
    return found.join(per_file(rows).withColumnRenamed("_file", "file"), "file", "left").fillna(0, ["rows"]).withColumn("columns", F.lit(len(rows.columns) - 1))


def read_files(spark: SparkSession, paths: Sequence[str], form: str, schema: StructType | str | None = None) -> DataFrame:
    """Many files as one table with _file: one job, so a file's count is a group and not a run of its own."""
    return read(spark, paths, form, schema, flat=False).withColumn("_file", F.element_at(F.split(F.input_file_name(), "/"), -1))


def per_file(df: DataFrame) -> DataFrame:
    return df.groupBy("_file").agg(F.count("*").alias("rows"))


def copy_table(source: DataFrame, path: str) -> DataFrame:
    source.write.mode("overwrite").parquet(path)
    return source.sparkSession.read.parquet(path)


# First words that only read, and words that change something.
READING, CHANGING = ("select", "with", "explain"), ("insert", "update", "delete", "drop", "alter", "create", "truncate", "merge", "replace", "grant", "revoke", "call", "set", "load", "refresh", "add", "cache", "uncache")


def query(spark: SparkSession, tables: dict[str, DataFrame], sql: str) -> DataFrame:
    """Reading SQL over the given tables; other statements are refused."""
    import re

    bare = re.sub(r"'(?:[^']|'')*'", "''", re.sub(r"--[^\n]*|/\*.*?\*/", " ", sql, flags=re.S)).strip().rstrip(";").lower()
    first = bare.split(None, 1)[0] if bare else ""
    if first not in READING or ";" in bare or re.search(rf"(^|[\s(])({'|'.join(CHANGING)})\s+(into|table|from|view|schema|database|function|or)\b", bare):
        raise PermissionError("only reading statements are allowed")
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql)
