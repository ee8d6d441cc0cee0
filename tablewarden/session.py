"""Sessions and tables."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def session(master: str = "local[*]", partitions: int = 8, **conf: str) -> SparkSession:
    """A UTC session with adaptive execution; ANSI stays on, so lenient conversions use the try_ functions."""
    builder = SparkSession.builder.master(master).config("spark.sql.session.timeZone", "UTC").config("spark.sql.shuffle.partitions", str(partitions)).config("spark.ui.enabled", "false")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def set_own_folder(spark: SparkSession) -> str:
    """A folder for spark.checkpoint.dir where it is unset: one of this machine, so only in local mode; elsewhere the cluster must name one."""
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    found = tempfile.mkdtemp(prefix="spark-tablewarden-")
    spark.conf.set("spark.checkpoint.dir", found)
    return found


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a temporary one only where it is unset, in local mode."""
    return f"{spark.conf.get('spark.checkpoint.dir', None) or set_own_folder(spark)}/tables"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once an application: they may start in a folder where it can't be imported."""
    if spark.sparkContext.applicationId not in _shipped:
        _shipped.add(spark.sparkContext.applicationId)
        top = Path(__file__).parent
        path = f"{tempfile.mkdtemp(prefix='spark-tablewarden-')}/{top.name}-{uuid.uuid4().hex[:8]}.zip"
        with zipfile.ZipFile(path, "w") as z:
            for f in sorted(top.rglob("*.py")):
                z.write(f, f.relative_to(top.parent))
        spark.sparkContext.addPyFile(path)
