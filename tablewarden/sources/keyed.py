"""Tables of a database read in ranges of their key: any key, of several columns or none that Spark could part by itself.

The key is the one given, else the table's primary key, as the database's metadata says, else all of its columns. The database is
asked for the keys at even places of the key's order (a query each, so as many as partitions less one), and every range
between two of them is a predicate of its own, read as one partition. Rows whose key has a null are a partition more. Ranges
follow one another and are sorted inside, so the whole is in the order of the key, and a read can go on after its last key.

The database compares keys with its own collation; for texts that is the order of the ranges, inside of which Spark
sorts by code points.
"""

from __future__ import annotations

import datetime
import decimal
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import check_identifier
from . import sqlite
from .readers import quoted


def primary_key(spark: SparkSession, url: str, table: str, **options: str) -> list[str]:
    """The columns of the primary key in its order; none without one. table: name or schema.name, as the database writes it."""
    if sqlite.is_file(url):
        return sqlite.primary_key(url, table)
    jvm = spark.sparkContext._jvm
    properties = jvm.java.util.Properties()
    for k, v in options.items():
        properties.setProperty(k, v)
    if "driver" in options:
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(options["driver"])
    connection = jvm.java.sql.DriverManager.getConnection(url, properties)
    try:
        schema, _, name = table.rpartition(".")
        rows = connection.getMetaData().getPrimaryKeys(None, schema or None, name)
        found = []
        while rows.next():
            found.append((rows.getInt("KEY_SEQ"), rows.getString("COLUMN_NAME")))
        return [c for _, c in sorted(found)]
    finally:
        connection.close()


def literal(value) -> str:
    """A value in SQL; dates and times in the escapes that drivers translate."""
    match value:
        case bool():
            return "TRUE" if value else "FALSE"
        case int() | decimal.Decimal():
            return format(value, "f") if isinstance(value, decimal.Decimal) else str(value)
        case float():
            return repr(value)
        case datetime.datetime():
            return "{ts '" + value.isoformat(" ", "microseconds") + "'}"
        case datetime.date():
            return "{d '" + value.isoformat() + "'}"
        case str():
            return "'" + value.replace("'", "''") + "'"
    raise TypeError(f"a key can't be a {type(value).__name__}")


def after(names: Sequence[str], values: Sequence, equal: bool) -> str:
    """Keys that come after the values in the order of the names, or also equal to them."""
    parts = []
    for i, (name, value) in enumerate(zip(names, values, strict=True)):
        same = [f"{n} = {literal(v)}" for n, v in zip(names[:i], values, strict=False)]
        last = i == len(names) - 1
        parts.append("(" + " AND ".join([*same, f"{name} {'>=' if last and equal else '>'} {literal(value)}"]) + ")")
    return "(" + " OR ".join(parts) + ")"


def _page(url: str, order: str, skip: int) -> str:
    """The row at a place of an order, in the database's words."""
    if url.startswith(("jdbc:mysql", "jdbc:mariadb", "jdbc:sqlite", "sqlite:")):
        return f"ORDER BY {order} LIMIT 1 OFFSET {skip}"
    return f"ORDER BY {order} OFFSET {skip} ROWS FETCH NEXT 1 ROWS ONLY"


def read_keyed(spark: SparkSession, url: str, table: str, key: Sequence[str] = (), columns: Sequence[str] = (), where: str | None = None, partitions: int = 8, resume_after: Sequence | None = None, **options: str) -> DataFrame:
    """The table's rows in ranges of its key, in its order; resume_after: only those whose key comes after this one (keys with nulls, which come first, are then read already)."""
    names = [check_identifier(c) for c in (key or primary_key(spark, url, table, **options))]
    file = sqlite.is_file(url)
    read = lambda what: spark.read.format("jdbc").options(url=url, dbtable=what, **options)
    ask = lambda sql: sqlite.ask(url, sql) if file else read(f"({sql}) t").load().first()
    if not names:
        names = [*sqlite.table_columns(url, table)] if file else read(f"(SELECT * FROM {table} WHERE 1 = 0) t").load().columns
    own = [quoted(spark, url, c) for c in names]
    full = " AND ".join(f"{c} IS NOT NULL" for c in own)
    only = [full, *([after(own, resume_after, False)] if resume_after is not None else []), *([f"({where})"] if where else [])]
    inside = " AND ".join(only)
    rows = ask(f"SELECT COUNT(*) AS n FROM {table} WHERE {inside}")[0]
    borders = []
    for i in range(1, partitions):
        place = rows * i // partitions
        if place and (not borders or place != rows * (i - 1) // partitions):
            found = ask(f"SELECT {', '.join(own)} FROM {table} WHERE {inside} {_page(url, ', '.join(own), place)}")
            if found is not None and (not borders or tuple(found) != borders[-1]):
                borders.append(tuple(found))
    ranges = []
    for low, high in zip([None, *borders], [*borders, None], strict=True):
        bounds = [after(own, low, True)] if low else []
        bounds += [f"NOT {after(own, high, True)}"] if high else []
        ranges.append(" AND ".join([*only, *bounds]))
    if resume_after is None:
        lacking = " OR ".join(f"{c} IS NULL" for c in own)
        ranges.insert(0, " AND ".join([f"({lacking})", *([f"({where})"] if where else [])]))
    if file:
        df = sqlite.read(spark, url, table, list(dict.fromkeys([*columns, *names])) if columns else (), ranges).sortWithinPartitions(*names)
        return df.select(*columns) if columns else df
    options_ = {k: str(v) for k, v in options.items()}
    df = spark.read.jdbc(url, table, predicates=ranges, properties=options_).sortWithinPartitions(*names)
    return df.select(*columns) if columns else df


def last_key(df: DataFrame, key: Sequence[str]) -> tuple | None:
    """The greatest key without nulls, to go on after; compared by Spark, so for texts in code points."""
    found = df.dropna(subset=list(key)).agg(F.max(F.struct(*key)).alias("k")).first()["k"]
    return tuple(found) if found is not None else None
