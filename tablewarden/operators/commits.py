"""A log of commits that two writers cannot both win: numbered files, each put only where there is none.

An entry is written to a name of its own first and then put under its number whole, so readers never see a part of it. In
a local or mounted folder that is a hard link, elsewhere a rename, which stores with atomic renames refuse if the number is
taken. The loser makes its entry anew from what the winner left, and takes the next number.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

NUMBER = "_commit long"


class CommitLog:
    """Entries (dicts of the schema's columns) under root, in order; _commit is an entry's number, from 1."""

    def __init__(self, spark: SparkSession, root: str, schema: str):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), f"{schema}, {NUMBER}"

    def _fs(self):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _local(self) -> str | None:
        uri = self._fs().makeQualified(self._path("commits")).toUri()
        return os.path.dirname(uri.getPath()) if uri.getScheme() == "file" else None

    def last(self) -> int:
        """The number of the last entry, 0 without one. Only names are listed."""
        fs, folder = self._fs(), self._path("commits")
        if not fs.exists(folder):
            return 0
        return max((int(s.getPath().getName().split(".")[0]) for s in fs.listStatus(folder)), default=0)

    def entries(self) -> DataFrame:
        if not self.last():
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).json(f"{self.root}/commits")

    def put(self, number: int, entry: dict) -> bool:
        """Whether the entry became this number; False if another one has it."""
        fs, tmp, final = self._fs(), f"writing/{uuid.uuid4().hex}.json", f"commits/{number:020d}.json"
        body = json.dumps(entry | {"_commit": number}, default=str)
        for folder in ("writing", "commits"):
            fs.mkdirs(self._path(folder))
        local = self._local()
        if local:
            with open(f"{local}/{tmp}", "w") as f:
                f.write(body + "\n")
            try:
                os.link(f"{local}/{tmp}", f"{local}/{final}")
            except FileExistsError:
                return False
            finally:
                os.remove(f"{local}/{tmp}")
            return True
        out = fs.create(self._path(tmp), False)
        out.write(bytearray((body + "\n").encode()))
        out.close()
        if fs.exists(self._path(final)) or not fs.rename(self._path(tmp), self._path(final)):
            fs.delete(self._path(tmp), False)
            return False
        return True

    def append(self, make: Callable[[DataFrame], dict | None]) -> tuple[int, dict | None]:
        """Put make(entries so far) as the next entry, again from what is there if another writer was first; None commits nothing."""
        while True:
            last = self.last()
            entry = make(self.entries())
            if entry is None or self.put(last + 1, entry):
                return last + 1, entry

