"""Dead letters, loads, reconciliation, reversible loads, snapshots."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .commits import CommitLog

META = ["_dlq_pipeline_id", "_dlq_reason", "_dlq_timestamp"]


def split_bad(df: DataFrame, bad: Column, pipeline_id: str, reason: str, at: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, dead letters with their meta columns); an unknown verdict counts as good."""
    hit = F.coalesce(bad, F.lit(False))
    return df.filter(~hit), df.filter(hit).withColumns({"_dlq_pipeline_id": F.lit(pipeline_id), "_dlq_reason": F.lit(reason), "_dlq_timestamp": F.lit(at)})


def write_dead(dead: DataFrame, path: str) -> None:
    """Appended; columns may differ from batch to batch."""
    dead.write.mode("append").partitionBy("_dlq_pipeline_id").parquet(path)


def replay(spark: SparkSession, path: str, transform=None, pipeline_id: str | None = None) -> DataFrame:
    """The dead letters without meta columns, transformed, ready to load."""
    dead = spark.read.option("mergeSchema", "true").parquet(path)
    if pipeline_id:
        dead = dead.filter(F.col("_dlq_pipeline_id") == pipeline_id)
    rows = dead.drop(*META)
    return transform(rows) if transform else rows


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], merge: bool = False, order: Sequence[Column] = ()) -> DataFrame:
    """Target rows whose key is not in the source, and all source rows; merge: one source row a key, the first in the order."""
    if not keys:
        raise ValueError("an upsert needs keys")
    if merge:
        from .joins import first_per_key

        source = first_per_key(source, keys, order)
    return target.join(source.select(*keys).distinct(), list(keys), "left_anti").select(*target.columns).unionByName(source, allowMissingColumns=True)


def write_rows(df: DataFrame, path: str, mode: str = "append", by: Sequence[str] = (), form: str = "parquet", dry_run: bool = False, **options: str) -> DataFrame:
    """rows, written, path: append, replace, or replace of only the partitions that df has (replace with `by`)."""
    from ..functions.names import check_columns

    check_columns(df)
    if not dry_run:
        writer = df.write.mode({"append": "append", "replace": "overwrite"}[mode]).options(**options)
        if by:
            writer = writer.partitionBy(*by).option("partitionOverwriteMode", "dynamic")
        writer.format(form).save(path)
    return df.agg(F.count("*").alias("rows")).select("rows", F.lit(not dry_run).alias("written"), F.lit(path).alias("path"))


def compact(spark: SparkSession, path: str, out: str, rows_per_file: int = 1_000_000) -> DataFrame:
    """A copy of the dataset in few files, in a new folder."""
    df = spark.read.parquet(path)
    n = max(1, -(-df.count() // rows_per_file))
    df.repartition(n).write.parquet(out)
    return spark.read.parquet(out)


def reconcile(source: DataFrame, destination: DataFrame, baseline: int = 0, tolerance: float = 0.0) -> DataFrame:
    """source_rows, loaded_rows, verdict: OK, SHORT beyond the tolerance, EXCESS for any row too many."""
    one = source.agg(F.count("*").alias("source_rows")).crossJoin(destination.agg((F.count("*") - baseline).alias("loaded_rows")))
    short = F.col("source_rows") - F.col("loaded_rows")
    return one.withColumn("verdict", F.when(short < 0, "EXCESS").when(short > F.col("source_rows") * tolerance, "SHORT").otherwise("OK"))


def column_reconciliation(source: DataFrame, destination: DataFrame) -> DataFrame:
    """column, status (missing, extra), whatever the case."""
    a, b = {c.lower() for c in source.columns}, {c.lower() for c in destination.columns}
    rows = [(c, "missing") for c in sorted(a - b)] + [(c, "extra") for c in sorted(b - a)]
    return source.sparkSession.createDataFrame(rows, "column string, status string")


def content_hash(df: DataFrame) -> DataFrame:
    """rows, hash: the same for the same rows in any order; sums and xors of row hashes, so partial sums are small."""
    h = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)])
    wide = h.cast("decimal(38,0)")
    return df.agg(F.count("*").alias("rows"), F.sha2(F.concat_ws("|", F.count("*").cast("string"), F.coalesce(F.sum(wide), F.lit(0)).cast("string"), F.coalesce(F.bit_xor(h), F.lit(0)).cast("string"), F.lit(",".join(sorted(df.columns)))), 256).alias("hash"))


class SnapshotStore:
    """Versions of datasets as folders, and a commit log of them (dataset, version, hash, rows, message, author, at, path).

    Rows are written first, to a folder that nobody else knows; the version exists once its entry is in the log, so two
    writers get two versions, and readers see whole ones only.
    """

    MANIFEST = "dataset string, version long, hash string, rows long, message string, author string, at string, path string, deleted boolean"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.log = CommitLog(spark, f"{root}/manifest", self.MANIFEST)

    @staticmethod
    def _there(entries: DataFrame) -> DataFrame:
        gone = entries.filter("deleted").select("dataset", "version").distinct()
        return entries.filter("not deleted").join(gone, ["dataset", "version"], "left_anti")

    def manifest(self) -> DataFrame:
        """The entries of the versions that are not deleted."""
        return self._there(self.log.entries()).drop("_commit")

    def last(self, dataset: str):
        return self.manifest().filter(F.col("dataset") == dataset).orderBy(F.desc("version")).first()

    def snapshot(self, df: DataFrame, dataset: str, message: str = "", author: str = "", at: str = "") -> int:
        """The new version; the last one if nothing changed."""
        now, last = content_hash(df).first(), self.last(dataset)
        if last and last["hash"] == now["hash"]:
            return last["version"]
        path = f"{self.root}/data/{dataset}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        found = {}

        def entry(entries: DataFrame) -> dict | None:
            # deleted versions keep their numbers
            most = entries.filter(F.col("dataset") == dataset).agg(F.max("version").alias("v")).first()["v"] or 0
            newest = self._there(entries).filter(F.col("dataset") == dataset).orderBy(F.desc("version")).first()
            if newest and newest["hash"] == now["hash"]:
                found["version"] = newest["version"]
                return None
            found["version"] = most + 1
            return {"dataset": dataset, "version": most + 1, "hash": now["hash"], "rows": now["rows"], "message": message, "author": author, "at": at, "path": path, "deleted": False}

        self.log.append(entry)
        return found["version"]

    def checkout(self, dataset: str, version: int | None = None) -> DataFrame:
        rows = self.manifest().filter(F.col("dataset") == dataset)
        row = (rows.filter(F.col("version") == version) if version else rows.orderBy(F.desc("version"))).first()
        if row is None:
            raise KeyError(f"no version {version} of {dataset}")
        return self.spark.read.parquet(row["path"])

    def delete(self, dataset: str, version: int) -> None:
        self.log.append(lambda _: {"dataset": dataset, "version": version, "hash": "", "rows": 0, "message": "deleted", "author": "", "at": "", "path": "", "deleted": True})


class ReversibleLoads:
    """Loads that keep the table before them as a snapshot, to go back to by run or by one step."""

    def __init__(self, spark: SparkSession, root: str):
        self.store, self.spark = SnapshotStore(spark, root), spark

    def load(self, before: DataFrame, after: DataFrame, table: str, run_id: str, at: str) -> DataFrame:
        self.store.snapshot(before, f"{table}/{run_id}", "before", run_id, at)
        return after

    def rollback(self, table: str, run_id: str) -> DataFrame:
        found = self.store.last(f"{table}/{run_id}")
        if found is None:
            raise KeyError(f"no load {run_id} of {table}")
        rows = self.store.checkout(f"{table}/{run_id}")
        if content_hash(rows).first()["hash"] != found["hash"]:
            raise ValueError("the snapshot was changed")
        return rows

    def rollback_latest(self, table: str) -> DataFrame:
        row = self.store.manifest().filter(F.col("dataset").startswith(f"{table}/")).orderBy(F.desc("at"), F.desc("dataset")).first()
        if row is None:
            raise KeyError(f"no load of {table}")
        return self.rollback(table, row["author"])

    def purge(self, before: str) -> int:
        old = self.store.manifest().filter(F.col("at") < before).select("dataset", "version").collect()  # one row a load
        for r in old:
            self.store.delete(r["dataset"], r["version"])
        return len(old)


