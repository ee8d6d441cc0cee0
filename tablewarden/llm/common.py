"""Helpers shared by the corpus operators: scratch tables, byte hashing, safe column names.

Missing texts count as empty everywhere. Inputs are narrowed to the columns an operator needs before any
shuffle, so further columns, clashing names included, never reach the operator.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import set_own_folder


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


_shipped: set[str] = set()


#: Rows that go to a Python worker at once, unless the session sets a number: whole texts are large rows.
ROWS_AT_ONCE = 1000


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once an application: they may start in a folder where it can't be imported."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_AT_ONCE)
    if spark.sparkContext.applicationId not in _shipped:
        _shipped.add(spark.sparkContext.applicationId)
        top = Path(__file__).parent.parent
        path = f"{tempfile.mkdtemp(prefix='spark-tablewarden-')}/{top.name}.zip"
        with zipfile.ZipFile(path, "w") as z:
            for f in sorted(top.rglob("*.py")):
                z.write(f, f.relative_to(top.parent))
        spark.sparkContext.addPyFile(path)


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; one of this machine only where it is unset in local mode, as in tests."""
    return spark.conf.get("spark.checkpoint.dir", None) or set_own_folder(spark)


def scratch(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: the lineage is cut, and lost executors cost nothing."""
    spark = df.sparkSession
    ship(spark)
    path = f"{shared_dir(spark)}/tablewarden/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def narrow(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns; a null text becomes the empty one."""
    return df.select(*[F.coalesce(F.col(n), F.lit("")).alias(n) if n == "text" else F.col(n) for n in names])


def give_back() -> None:
    """Return freed memory to the system: Python workers live on after a task, and all share an executor's memory."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def plain(column: pa.Array) -> list:
    """column.to_pylist(); lists of whole numbers are cut from one list of their values, as an object an element costs several times as much."""
    if not (pa.types.is_list(column.type) and pa.types.is_integer(column.type.value_type)) or column.values.null_count:
        return column.to_pylist()
    ends = column.offsets.to_numpy()
    at, values = (ends - ends[0]).tolist(), column.values[ends[0] : ends[-1]].to_numpy().tolist()
    out = [values[a:b] for a, b in zip(at, at[1:], strict=False)]
    return [x if ok else None for x, ok in zip(out, column.is_valid().to_pylist(), strict=True)] if column.null_count else out


def map_rows(df: DataFrame, make: Callable[[], Callable[[dict[str, list]], dict[str, list]]], schema: pa.Schema, rows: int = 512) -> DataFrame:
    """mapInArrow over small slices. make() runs once a task and returns columns -> columns."""
    from pyspark.sql.pandas.types import from_arrow_schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                out = step({n: plain(part.column(i)) for i, n in enumerate(part.schema.names)})
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in schema], schema=schema)
        give_back()

    ship(df.sparkSession)
    return df.mapInArrow(run, from_arrow_schema(schema))


# --- hashing of byte spans -------------------------------------------------------------------------------

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20240607).integers(0, 2**64, 256, dtype=np.uint64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        for i, base in enumerate((_BASE, _INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[i] = np.cumprod(p, dtype=np.uint64)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit murmur finaliser."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums modulo 2**64 of n bytes, n + 1 long."""
    return sums_of(_BYTE[data])


def sums_of(values: np.ndarray) -> np.ndarray:
    power, _ = _tables(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[: len(values)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mixed hashes of the spans [start, end); equal bytes have equal hashes wherever they stand."""
    _, inverse = _tables(len(prefix))
    return mix((prefix[ends] - prefix[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).astype(np.int8)))
    return edge[::2], edge[1::2]


SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_hashes(text: bytes, is_word: np.ndarray = ~SPACE, lower: bool = True) -> np.ndarray:
    """64-bit hashes of a text's words in order: maximal runs of bytes in is_word, A-Z lower-cased."""
    data = np.frombuffer(text, np.uint8)
    if lower:
        data = LOWER[data]
    starts, ends = runs(is_word[data])
    return span_hash(prefix_hash(data), starts, ends)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
