"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}


def build_session(name: str = "castframe", cpus: int | str = "*", **settings: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    parallel = str(cpus) if str(cpus) != "*" else "8"
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", parallel)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    )
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def workspace(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    Only a local master may go without that setting; it then gets a temporary
    folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="castframe-")
    return _local_folders[context.applicationId]


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and continue from the written table.

    This cuts the lineage: a lost executor never causes the work before it to
    run again, and values that depend on the physical partitioning stay fixed
    for every later reader. The tables of an application share one folder,
    which can go when the application has ended.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path for an intermediate table of this application."""
    return f"{workspace(spark)}/castframe/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


_shipped: set[tuple[str, str]] = set()


def ship(spark: SparkSession, *packages: str) -> None:
    """Send packages of this repository to the executors, once per application.

    The same as ``--py-files`` on submission, for drivers that do without.
    """
    root = Path(__file__).resolve().parent.parent
    for package in packages or ("castframe",):
        key = (spark.sparkContext.applicationId, package)
        if key not in _shipped:
            archive = f"{tempfile.mkdtemp(prefix='castframe-ship-')}/{package}"
            spark.sparkContext.addPyFile(shutil.make_archive(archive, "zip", root, package))
            _shipped.add(key)
