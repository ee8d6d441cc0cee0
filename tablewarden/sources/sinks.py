"""Writers: files, lake tables, JDBC, topics, embedding tables, by destination."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.loads import upsert
from . import sqlite
from .readers import quoted

# Destinations by the writer that serves them.
WRITERS = {
    "files": ("parquet", "s3", "gcs", "azure_blob", "fabric", "athena", "duckdb", "motherduck"),
    "lake": ("deltalake", "iceberg", "databricks"),
    "jdbc": ("sqlite", "postgresql", "postgres", "mysql", "mssql", "snowflake", "bigquery", "redshift", "synapse", "oracle", "db2", "hana", "firebolt", "yellowbrick", "cockroachdb", "clickhouse", "postgis"),
    "topic": ("kafka",),
    "vectors": ("pgvector", "lancedb", "chroma", "milvus", "qdrant", "weaviate", "pinecone", "bigquery_vector", "snowflake_vector"),
}


def writer_of(destination: str) -> str:
    for writer, names in WRITERS.items():
        if destination in names:
            return writer
    raise ValueError(f"unknown destination: {destination}")


def write_files(df: DataFrame, path: str, form: str = "parquet", mode: str = "append", by: Sequence[str] = (), compression: str | None = None) -> None:
    w = df.write.mode("overwrite" if mode == "replace" else mode)
    if by:
        w = w.partitionBy(*by).option("partitionOverwriteMode", "dynamic")
    if compression:
        w = w.option("compression", compression)
    w.format({"jsonl": "json"}.get(form, form)).save(path)


def upsert_files(df: DataFrame, path: str, out: str, keys: Sequence[str]) -> DataFrame:
    """A new version of the table at `out`: what the source replaces is left out."""
    upsert(df.sparkSession.read.parquet(path), df, keys).write.parquet(out)
    return df.sparkSession.read.parquet(out)


def write_database(df: DataFrame, url: str, table: str, mode: str = "append", keys: Sequence[str] = (), batch: int = 10_000, primary: Sequence[str] = (), **options: str) -> None:
    """append, replace or upsert: only the source's rows are staged, then the database replaces rows by key in one transaction. primary: of a new table in a SQLite file."""
    if sqlite.is_file(url):
        sqlite.write(df, url, table, mode, keys, primary)
        return
    if primary:
        raise ValueError("over JDBC a primary key is added by run_statements")
    save = lambda t, m: df.write.format("jdbc").options(url=url, dbtable=t, batchsize=batch, **options).mode(m).save()
    if mode != "upsert":
        save(table, "overwrite" if mode == "replace" else "append")
        return
    if not keys:
        raise ValueError("an upsert needs keys")
    spark, staged = df.sparkSession, f"{table}_staged"
    save(staged, "overwrite")
    names = ", ".join(quoted(spark, url, c) for c in df.columns)
    same = " AND ".join(f"s.{c} = {table}.{c}" for c in (quoted(spark, url, k) for k in keys))
    _execute(spark, url, [f"DELETE FROM {table} WHERE EXISTS (SELECT 1 FROM {staged} s WHERE {same})", f"INSERT INTO {table} ({names}) SELECT {names} FROM {staged}"], options)
    _execute(spark, url, [f"DROP TABLE {staged}"], options)


def run_statements(spark: SparkSession, url: str, statements: Sequence[str], **options: str) -> None:
    """Statements of the caller in one transaction."""
    _execute(spark, url, statements, options)


def write_archive(spark: SparkSession, folder: str, path: str) -> None:
    """The part files of a folder as the members of a zip or tgz, or one after the other as a frame of lz4 or zst; copied as streams, by the driver."""
    import shutil
    import tarfile
    import zipfile

    import pyarrow as pa

    from .archives import CODECS, _files, kind

    fs, at = _files(folder)
    files = sorted(i.path for i in fs.get_file_info(pa.fs.FileSelector(at)) if i.base_name.startswith("part-"))
    out_fs, out = _files(path)
    codec = kind(path)
    if codec == "zip":
        with out_fs.open_output_stream(out) as f, zipfile.ZipFile(f, "w", zipfile.ZIP_DEFLATED) as z:
            for p in files:
                with fs.open_input_stream(p) as raw, z.open(p.rsplit("/", 1)[-1], "w", force_zip64=True) as member:
                    shutil.copyfileobj(raw, member, 1 << 20)
    elif codec == "tar":
        with out_fs.open_output_stream(out) as f, tarfile.open(fileobj=f, mode="w|gz") as t:
            for p in files:
                info = tarfile.TarInfo(p.rsplit("/", 1)[-1])
                info.size = fs.get_file_info(p).size
                with fs.open_input_stream(p) as raw:
                    t.addfile(info, raw)
    elif codec in CODECS.values():
        with out_fs.open_output_stream(out, compression=codec) as f:
            for p in files:
                with fs.open_input_stream(p) as raw:
                    shutil.copyfileobj(raw, f, 1 << 20)
    else:
        raise ValueError(f"no archive: {path}")


def _execute(spark: SparkSession, url: str, statements: Sequence[str], options: dict[str, str]) -> None:
    """Statements in one transaction, over the driver's own connection."""
    jvm = spark.sparkContext._jvm
    properties = jvm.java.util.Properties()
    for k, v in options.items():
        properties.setProperty(k, v)
    connection = jvm.java.sql.DriverManager.getConnection(url, properties)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        for s in statements:
            statement.executeUpdate(s)
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def topic_rows(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """key, value as texts: what a topic is written from."""
    value = F.to_json(F.struct(*df.columns)).alias("value")
    return df.select(F.concat_ws("|", *keys).alias("key") if keys else F.lit(None).cast("string").alias("key"), value)


def write_topic(df: DataFrame, servers: str, topic: str, keys: Sequence[str] = ()) -> None:
    topic_rows(df, keys).write.format("kafka").options(**{"kafka.bootstrap.servers": servers, "topic": topic}).save()  # needs the Kafka package


def write_vectors(df: DataFrame, path: str, vector: str, key: str, mode: str = "append") -> None:
    """Rows whose vector has entries, all finite, and a key; the others are an error."""
    bad = df.filter(F.col(key).isNull() | F.col(vector).isNull() | (F.size(vector) == 0) | F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    if bad.limit(1).count():
        raise ValueError("vectors must have a key and finite entries")
    write_files(df, path, mode=mode)
