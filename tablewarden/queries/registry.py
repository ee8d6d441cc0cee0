"""Registered queries: a name, a Spark query over the tables of a folder, and DuckDB SQL for the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_folder, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


class Tables:
    """The tables of a folder as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return table(self.spark, self.sf_dir, name)

    def folder(self) -> str:
        """A new folder under the one that the cluster shares."""
        return f"{shared_folder(self.spark)}/{uuid.uuid4().hex}"

    def keep(self, df: DataFrame) -> DataFrame:
        """df as a written table: what is random or read twice stays the same."""
        path = self.folder()
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def query(name: str, sql: str | None = None):
    def register(f: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            SQL[name] = sql
        return f

    return register
