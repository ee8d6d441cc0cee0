"""SQLite databases in files that the driver and all executors can open: written and read by tasks, each over its own connection.

A database of the driver's process (an embedded one behind JDBC) is not there for executors of other processes; a file in the
folder that the cluster shares is. Urls are sqlite:/path or sqlite:file:///path. Rows are written by tasks to part files of
their own, so no task waits for another's lock and a task that runs twice counts once; the database then takes the parts in
and exchanges rows in one transaction. Reading is one partition a predicate, in batches of ROWS.

Columns are integers, floats, booleans, texts or binaries.
"""

from __future__ import annotations

import json
import os
import shutil
import sqlite3
import uuid
from collections.abc import Iterator, Sequence
from contextlib import closing

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from ..functions.names import check_identifier
from ..session import ship
from .archives import _files

#: Rows of a batch; seconds to wait for another's lock.
ROWS, WAIT = 8192, 600
# Declared types by Spark's, and the types that columns are read as.
TYPES = {"tinyint": "TINYINT", "smallint": "SMALLINT", "int": "INT", "bigint": "BIGINT", "float": "FLOAT", "double": "DOUBLE", "boolean": "BOOLEAN", "string": "TEXT", "binary": "BLOB"}
ARROW = {"TINYINT": pa.int8(), "SMALLINT": pa.int16(), "INT": pa.int32(), "INTEGER": pa.int64(), "BIGINT": pa.int64(), "FLOAT": pa.float32(), "DOUBLE": pa.float64(), "REAL": pa.float64(), "BOOLEAN": pa.bool_(), "TEXT": pa.string(), "BLOB": pa.binary()}
SPARK = {v: k for k, v in TYPES.items()} | {"INTEGER": "bigint", "REAL": "double"}


def is_file(url: str) -> bool:
    return url.startswith("sqlite:")


def location(url: str) -> str:
    fs, at = _files(url.removeprefix("sqlite:"))
    if not isinstance(fs, pyarrow.fs.LocalFileSystem):
        raise ValueError(f"a database file must be in a mounted folder: {url}")
    return at


def make_folder(path: str) -> None:
    """A folder for a database file, where it is missing."""
    os.makedirs(location(f"sqlite:{path}"), exist_ok=True)


def connect(url: str) -> closing[sqlite3.Connection]:
    return closing(sqlite3.connect(location(url), timeout=WAIT, isolation_level=None))


def ask(url: str, sql: str) -> tuple | None:
    """The first row of a query."""
    with connect(url) as c:
        return c.execute(sql).fetchone()


def execute(url: str, statements: Sequence[str]) -> None:
    """Statements in one transaction."""
    with connect(url) as c:
        c.execute("BEGIN IMMEDIATE")
        try:
            for s in statements:
                c.execute(s)
            c.execute("COMMIT")
        except BaseException:
            c.execute("ROLLBACK")
            raise


def table_columns(url: str, table: str) -> dict[str, str]:
    """Columns and their declared types."""
    with connect(url) as c:
        found = {r[1]: r[2].upper() for r in c.execute(f"PRAGMA table_info({check_identifier(table)})")}
    if not found:
        raise LookupError(f"no table {table}")
    return found


def primary_key(url: str, table: str) -> list[str]:
    with connect(url) as c:
        rows = c.execute(f"PRAGMA table_info({check_identifier(table)})").fetchall()
    return [r[1] for r in sorted(rows, key=lambda r: r[5]) if r[5]]


class Part(InputPartition):
    def __init__(self, sql: str):
        self.sql = sql


class TableReader(DataSourceReader):
    def __init__(self, options: dict):
        self.url, self.columns, self.queries = options["url"], json.loads(options["columns"]), json.loads(options["queries"])

    def partitions(self) -> Sequence[InputPartition]:
        return [Part(q) for q in self.queries]

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        types = [ARROW[t] for t in self.columns.values()]
        with connect(self.url) as c:
            cursor = c.execute(part.sql)
            while rows := cursor.fetchmany(ROWS):
                values = [[v if v is None else bool(v) for v in x] if t == pa.bool_() else x for x, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(values, types, strict=True)], names=list(self.columns))


class TableSource(DataSource):
    """Options: url, columns (JSON, names to declared types), queries (a JSON list)."""

    @classmethod
    def name(cls) -> str:
        return "sqlite_table"

    def schema(self) -> str:
        return ", ".join(f"`{n}` {SPARK[t]}" for n, t in json.loads(self.options["columns"]).items())

    def reader(self, schema: StructType) -> TableReader:
        return TableReader(self.options)


def read(spark: SparkSession, url: str, table: str, columns: Sequence[str] = (), predicates: Sequence[str] = ("1 = 1",)) -> DataFrame:
    """Columns (all, if none is named) of the rows of each predicate, a partition each."""
    ship(spark)
    spark.dataSource.register(TableSource)
    known = table_columns(url, table)
    chosen = {n: known[n] for n in columns or known}
    names = ", ".join(f'"{n}"' for n in chosen)
    queries = [f"SELECT {names} FROM {check_identifier(table)} WHERE {p}" for p in predicates]
    return spark.read.format("sqlite_table").option("url", url).option("columns", json.dumps(chosen)).option("queries", json.dumps(queries)).load()


def ranges(url: str, table: str, key: str, partitions: int, where: str | None = None) -> list[str]:
    """Predicates that part a table by even steps of a whole-numbered key; keys that are null go with the lowest."""
    only = f"({where})" if where else "1 = 1"
    low, high = ask(url, f'SELECT min("{key}"), max("{key}") FROM {table} WHERE {only}')
    if not isinstance(low, int) or low == high:
        return [only]
    borders = sorted({low + (high - low) * i // partitions for i in range(1, partitions)} - {low})
    bounds = [[*([f'"{key}" >= {a}'] if a is not None else []), *([f'"{key}" < {b}'] if b is not None else [])] for a, b in zip([None, *borders], [*borders, None], strict=True)]
    found = [" AND ".join([only, *b]) for b in bounds]
    found[0] = f'{only} AND ({" AND ".join(bounds[0]) or "1 = 1"} OR "{key}" IS NULL)'
    return found


def write(df: DataFrame, url: str, table: str, mode: str = "append", keys: Sequence[str] = (), primary: Sequence[str] = ()) -> None:
    """append, replace or upsert by keys, all or nothing; primary: the primary key of a table that is made here."""
    spark = df.sparkSession
    check_identifier(table)
    names = [check_identifier(c) for c in df.columns]
    if bad := [f.name for f in df.schema if f.dataType.simpleString() not in TYPES]:
        raise TypeError(f"columns of a type that is not stored: {bad}")
    if mode == "upsert" and not keys:
        raise ValueError("an upsert needs keys")
    quote = lambda of: ", ".join(f'"{c}"' for c in of)
    declared = ", ".join(f'"{f.name}" {TYPES[f.dataType.simpleString()]}' for f in df.schema)
    parts = f"{location(url)}-{uuid.uuid4().hex}"
    os.makedirs(parts)
    marks = ", ".join("?" * len(names))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A file for each attempt; only those of attempts that Spark counts are told."""
        task = TaskContext.get()
        file = f"{parts}/{task.partitionId()}-{task.taskAttemptId()}.db"
        with closing(sqlite3.connect(file, isolation_level=None)) as c:
            c.execute("PRAGMA journal_mode = OFF")
            c.execute(f"CREATE TABLE part ({declared})")
            c.execute("BEGIN")
            for b in batches:
                c.executemany(f"INSERT INTO part VALUES ({marks})", zip(*[x.to_pylist() for x in b.columns], strict=True))
            c.execute("COMMIT")
        yield pa.RecordBatch.from_arrays([pa.array([file])], names=["file"])

    try:
        files = sorted(r["file"] for r in df.mapInArrow(put, "file string").collect())  # a name a task
        staged = f"{table}_staged_{uuid.uuid4().hex[:8]}"
        with connect(url) as c:
            c.execute(f"CREATE TABLE {staged} ({declared})")
            for file in files:
                c.execute("ATTACH ? AS part", (file,))
                c.execute(f"INSERT INTO {staged} SELECT * FROM part.part")
                c.execute("DETACH part")
        made = f"CREATE TABLE {'' if mode == 'replace' else 'IF NOT EXISTS '}{table} ({declared}{f', PRIMARY KEY ({quote(primary)})' if primary else ''})"
        first = [f"DROP TABLE IF EXISTS {table}"] if mode == "replace" else []
        gone = []
        if mode == "upsert":
            same = " AND ".join(f'{table}."{k}" = s."{k}"' for k in keys)
            # the staged keys in a tree, so that each row of the table asks once
            gone = [f"CREATE INDEX {staged}_keys ON {staged} ({quote(keys)})", f"DELETE FROM {table} WHERE EXISTS (SELECT 1 FROM {staged} s WHERE {same})"]
        fill = f"INSERT INTO {table} ({quote(names)}) SELECT {quote(names)} FROM {staged}{f' ORDER BY {quote(primary)}' if primary else ''}"
        try:
            execute(url, [*first, made, *gone, fill])
        finally:
            execute(url, [f"DROP TABLE {staged}"])
    finally:
        shutil.rmtree(parts, ignore_errors=True)
