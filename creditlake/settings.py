"""Run settings and the shared scratch location."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Settings:
    # Business cutoff and arrears limit of the default definition.
    cutoff_date: str = "2026-04-30"
    default_after_days: int = 30


_local_base: dict[str, str] = {}
_shipped: set[str] = set()
_staged: list[str] = []


def scratch_base(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by `spark.checkpoint.dir`.

    Only a local session may fall back to a folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_base:
        _local_base[app] = tempfile.mkdtemp(prefix="creditlake-")
        atexit.register(shutil.rmtree, _local_base[app], ignore_errors=True)
    return _local_base[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the scratch folder; two calls never share one."""
    return f"{scratch_base(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, **options) -> DataFrame:
    """Write `df` as Parquet in scratch, with the writer's `options`, and read it back.

    Used between pipeline stages and before operators that scan their input several times.
    Unlike a cached plan it survives the loss of executors and keeps column pruning.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    _staged.append(path)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> int:
    """Remove all tables that `stage` wrote in this process, once nothing reads them any more; how many there were."""
    n = len(_staged)
    while _staged:
        path = spark._jvm.org.apache.hadoop.fs.Path(_staged.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return n


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, for sessions started without `--py-files`."""
    package = Path(__file__).parent
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        folder = tempfile.mkdtemp(prefix="creditlake-zip-")
        sc.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name))
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _shipped.add(sc.applicationId)
