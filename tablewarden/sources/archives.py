"""Files in archives and under codecs that Spark does not open, as a data source: one partition a member, read as a stream.

zip and tar (plain, gz, bz2, xz) archives hold members; lz4 frames, zst, gz and bz2 are one file each. A partition opens its
archive, goes to its member and yields Arrow batches of ROWS rows, so neither archive nor member is ever whole in memory. A
member of a tar is reached by reading what stands before it; a zip has a directory.

Paths are those that Python can open on every executor: mounted folders (file: or none), or the stores of Arrow's file systems (hdfs:, s3:,
gs:). The format of a member is told by its name, as readers.inner_format does: csv, tsv, json lines, fixed width or text. Values
are texts; with a schema they are cast, and what can't be cast is null. Members of other formats are passed over if the
path names a folder or archive, and refused if it names them.
"""

from __future__ import annotations

import csv
import io
import json
import tarfile
import zipfile
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

from ..session import ship

#: Rows of a batch, and bytes of a read.
ROWS, BYTES = 4096, 1 << 20
# Extensions of archives and of codecs.
TARS = (".tar", ".tgz", ".tar.gz", ".tbz2", ".tar.bz2", ".txz", ".tar.xz")
CODECS = {".lz4": "lz4", ".zst": "zstd", ".gz": "gzip", ".bz2": "bz2"}
MEMBERS = {"csv": "csv", "tsv": "tsv", "jsonl": "jsonl", "ndjson": "jsonl", "txt": "text"}


def _files(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        if path.startswith("file:"):
            return pyarrow.fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
        return pyarrow.fs.FileSystem.from_uri(path)
    return pyarrow.fs.LocalFileSystem(), path


def kind(path: str) -> str | None:
    """zip, tar, the codec of a single file, or None."""
    low = path.lower()
    if low.endswith(".zip"):
        return "zip"
    if low.endswith(TARS):
        return "tar"
    return next((codec for end, codec in CODECS.items() if low.endswith(end)), None)


def member_format(name: str) -> str | None:
    """By the extension, under a codec's if there is one."""
    parts = name.rsplit("/", 1)[-1].lower().split(".")
    if f".{parts[-1]}" in CODECS:
        parts.pop()
    return MEMBERS.get(parts[-1]) if len(parts) > 1 else None


def members(path: str) -> list[str]:
    """Names of the files in an archive, or of the one under a codec."""
    fs, at = _files(path)
    match kind(path):
        case "zip":
            with fs.open_input_file(at) as f, zipfile.ZipFile(f) as z:
                return [i.filename for i in z.infolist() if not i.is_dir()]
        case "tar":
            with fs.open_input_file(at) as f, tarfile.open(fileobj=f, mode="r|*") as t:
                return [m.name for m in t if m.isfile()]
        case None:
            raise ValueError(f"no archive: {path}")
    name = at.rsplit("/", 1)[-1]
    return [name[: name.rindex(".")]]


class _Read(io.RawIOBase):
    """A stream of something that can only read."""

    def __init__(self, inner):
        self.inner = inner

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        found = self.inner.read(len(buffer))
        buffer[: len(found)] = found
        return len(found)


def _opened(path: str, member: str) -> Iterator[io.BufferedIOBase]:
    """The member's bytes as a stream, inside its own codec if its name has one."""
    fs, at = _files(path)

    def inside(raw):
        codec = next((c for end, c in CODECS.items() if member.lower().endswith(end)), None)
        return io.BufferedReader(_Read(pa.CompressedInputStream(pa.PythonFile(_Read(raw), "r"), codec) if codec else raw), BYTES)

    match kind(path):
        case "zip":
            with fs.open_input_file(at) as f, zipfile.ZipFile(f) as z, z.open(member) as raw:
                yield inside(raw)
        case "tar":
            with fs.open_input_file(at) as f, tarfile.open(fileobj=f, mode="r|*", bufsize=BYTES) as t:
                for m in t:
                    if m.name == member:
                        yield inside(t.extractfile(m))
                        return
        case codec:
            with fs.open_input_stream(at, compression=codec) as raw:
                yield io.BufferedReader(_Read(raw), BYTES)


def _rows(stream, form: str, names: list[str] | None) -> Iterator[tuple[list[str], list[list[str | None]]]]:
    """(column names, rows) in pieces of ROWS."""
    text = io.TextIOWrapper(stream, "utf-8-sig", errors="replace", newline="" if form in ("csv", "tsv") else None)
    wait: list[list[str | None]] = []
    if form in ("csv", "tsv"):
        read = csv.reader(text, delimiter="\t" if form == "tsv" else ",")
        head = next(read, None)
        if head is None:
            return
        for row in read:
            if row:
                wait.append([x if x != "" else None for x in row[: len(head)]] + [None] * (len(head) - len(row)))
                if len(wait) == ROWS:
                    yield head, wait
                    wait = []
    else:
        head = names or ["value"]
        for line in text:
            line = line.rstrip("\r\n")
            if form == "text":
                wait.append([line])
            elif line.strip():
                try:
                    found = json.loads(line)
                except ValueError:
                    found = None
                found = found if isinstance(found, dict) else {}
                said = lambda v: v if isinstance(v, str) or v is None else json.dumps(v)
                wait.append([said(found.get(n)) for n in head] if names else [line])
            if len(wait) == ROWS:
                yield head, wait
                wait = []
    if wait:
        yield head, wait


class Member(InputPartition):
    def __init__(self, path: str, name: str, form: str):
        self.path, self.name, self.form = path, name, form


class ArchiveReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.names = [f.name for f in schema.fields][:-1]
        self.found = [Member(p, m, form) for p in _archives(options) for m in members(p) if (form := options.get("format") or member_format(m))]

    def partitions(self) -> Sequence[InputPartition]:
        return self.found

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, pa.string()) for n in [*self.names, "_member"]])
        for stream in _opened(partition.path, partition.name):
            for head, rows in _rows(stream, partition.form, self.names if partition.form == "jsonl" else None):
                at = {n: i for i, n in enumerate(head)}
                own = [[r[at[n]] for r in rows] if n in at else [None] * len(rows) for n in self.names]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in [*own, [partition.name] * len(rows)]], schema=schema)


def _archives(options: dict) -> list[str]:
    """The paths; of a folder all archives in it."""
    out = []
    for path in json.loads(options["paths"]):
        fs, at = _files(path)
        if fs.get_file_info(at).type == pyarrow.fs.FileType.Directory:
            prefix = path[: len(path) - len(at)] if path.endswith(at) else "file:"
            out += [prefix + i.path for i in sorted(fs.get_file_info(pyarrow.fs.FileSelector(at)), key=lambda i: i.path) if i.is_file and kind(i.path)]
        else:
            out.append(path)
    return out


class ArchiveSource(DataSource):
    """Options: paths (a JSON list), format (of all members, if their names don't tell)."""

    @classmethod
    def name(cls) -> str:
        return "archive"

    def schema(self) -> StructType:
        """The columns of the first member that has any."""
        for path in _archives(self.options):
            for m in members(path):
                form = self.options.get("format") or member_format(m)
                if not form:
                    continue
                for stream in _opened(path, m):
                    if form == "jsonl":
                        line = stream.readline()
                        head = list(json.loads(line)) if line.strip() else []
                    elif form == "text":
                        head = ["value"]
                    else:
                        head = next(csv.reader(io.TextIOWrapper(stream, "utf-8-sig", errors="replace", newline=""), delimiter="\t" if form == "tsv" else ","), [])
                    if head:
                        return StructType([StructField(n, StringType()) for n in [*head, "_member"]])
        return StructType([StructField("_member", StringType())])

    def reader(self, schema: StructType) -> ArchiveReader:
        return ArchiveReader(schema, self.options)


def read_archives(spark: SparkSession, path: str | Sequence[str], form: str | None = None, schema: StructType | None = None) -> DataFrame:
    """The rows of all members of one archive, of many, or of a folder's; _member: the file in the archive that a row comes from."""
    ship(spark)
    spark.dataSource.register(ArchiveSource)
    r = spark.read.format("archive").option("paths", json.dumps([path] if isinstance(path, str) else [*path]))
    if form:
        r = r.option("format", form)
    if schema is None:
        return r.load()
    texts = StructType([StructField(f.name, StringType()) for f in schema.fields] + [StructField("_member", StringType())])
    return r.schema(texts).load().select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields], "_member")
