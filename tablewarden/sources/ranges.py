"""Files of any size by byte ranges: a data source whose rows are the hashes of ranges, so no file is ever one value.

Two fingerprints come from it. `sha256` is the plain one, read as a stream by one task a file, as the hash asks for. `tree` is
SHA-256 over the hashes of RANGE bytes each, in order, with the size and RANGE before them; its ranges are hashed by PARTS tasks
a file or by one for each SPAN bytes, if these are more; small ranges that follow one another are rows of one task. Equal files have equal values of both; a tree is no plain hash and is compared with trees of the same RANGE only.

Paths are those that sources.archives can open. An empty file has no ranges.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..session import ship
from .archives import _files

#: Bytes of a range, of a task's ranges, and of a read; tasks of a file of fewer bytes; rows of a batch.
RANGE, SPAN, BYTES, PARTS, ROWS = 64 << 20, 64 << 20, 1 << 20, 64, 4096
SCHEMA = "file string, size long, at long, bytes long, sha256 string"


class Part(InputPartition):
    """Ranges of `step` bytes each, the last one shorter, that begin at `at` and are `length` bytes together."""

    def __init__(self, path: str, size: int, at: int, length: int, step: int):
        self.path, self.size, self.at, self.length, self.step = path, size, at, length, step


def _found(paths: Sequence[str]) -> Iterator[tuple[str, int]]:
    """Files and their sizes; of a folder all in it, but for those that writers hide."""
    for path in paths:
        fs, at = _files(path)
        info = fs.get_file_info(at)
        if info.type == pyarrow.fs.FileType.Directory:
            prefix = path[: len(path) - len(at)] if path.endswith(at) else "file:"
            inside = fs.get_file_info(pyarrow.fs.FileSelector(at, recursive=True))
            yield from ((prefix + i.path, i.size) for i in sorted(inside, key=lambda i: i.path) if i.is_file and not i.base_name.startswith(("_", ".")))
        elif info.type == pyarrow.fs.FileType.File:
            yield path, info.size
        else:
            raise FileNotFoundError(path)


class RangeReader(DataSourceReader):
    def __init__(self, options: dict):
        step = int(options["range"])
        self.parts = []
        for p, size in _found(json.loads(options["paths"])):
            span = step * max(1, min(SPAN // step, -(-size // (step * PARTS)))) if step else size
            self.parts += [Part(p, size, at, min(span, size - at), step or size) for at in (range(0, size, span) if size else [0])]

    def partitions(self) -> Sequence[InputPartition]:
        return self.parts

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        fs, at = _files(part.path)
        types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        rows: list[tuple] = []
        batch = lambda: pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows, strict=True), types, strict=True)], names=["file", "size", "at", "bytes", "sha256"])
        with fs.open_input_file(at) as f:
            f.seek(part.at)
            for start in range(part.at, part.at + part.length, part.step) if part.length else [part.at]:
                length = min(part.step, part.at + part.length - start)
                digest, left = hashlib.sha256(), length
                while left:
                    data = f.read(min(BYTES, left))
                    if not data:
                        raise OSError(f"{part.path} has become shorter while it was read")
                    digest.update(data)
                    left -= len(data)
                rows.append((part.path, part.size, start, length, digest.hexdigest()))
                if len(rows) == ROWS:
                    yield batch()
                    rows = []
        if rows:
            yield batch()


class RangeSource(DataSource):
    """Options: paths (a JSON list), range (bytes; 0: whole files)."""

    @classmethod
    def name(cls) -> str:
        return "byte_ranges"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> RangeReader:
        return RangeReader(self.options)


def hash_ranges(spark: SparkSession, path: str | Sequence[str], size: int = RANGE) -> DataFrame:
    """file, size, at, bytes, sha256 of every range of `size` bytes (0: of every file)."""
    ship(spark)
    spark.dataSource.register(RangeSource)
    return spark.read.format("byte_ranges").option("paths", json.dumps([path] if isinstance(path, str) else [*path])).option("range", size).load()


def large_fingerprints(spark: SparkSession, path: str | Sequence[str], size: int = RANGE, plain: bool = True) -> DataFrame:
    """file (its name), bytes, ranges, tree, and with plain also sha256, of files of any size."""
    # the hashes of a file's ranges: 64 letters for each RANGE bytes
    hashes = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "sha256"))), lambda x: x["sha256"]), "")
    trees = hash_ranges(spark, path, size).groupBy("file").agg(F.max("size").alias("bytes"), F.count_if(F.col("bytes") > 0).alias("ranges"), F.sha2(F.concat_ws(":", F.max("size").cast("string"), F.lit(str(size)), hashes), 256).alias("tree"))
    if plain:
        trees = trees.join(hash_ranges(spark, path, 0).select("file", "sha256"), "file")
    return trees.withColumn("file", F.element_at(F.split("file", "/"), -1))
