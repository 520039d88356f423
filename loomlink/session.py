"""Spark session for local work and tests; a cluster brings its own."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()
_ONCE: dict[tuple[str, str], DataFrame] = {}


def ship(spark: SparkSession) -> None:
    """Gives this package to the session's Python workers, once; they need no path to it of their own."""
    key = spark.sparkContext.applicationId
    if key in _SHIPPED:
        return
    home = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="loomlink-"), "loomlink.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(home.rglob("*.py")):
            z.write(f, f"{home.name}/{f.relative_to(home)}")
    spark.sparkContext.addPyFile(str(target))
    _SHIPPED.add(key)


def local_session(cpus: int | str | None = None, partitions: int = 8, **conf: str) -> SparkSession:
    """A local session with UTC time, adaptive plans and Arrow transfer."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("loomlink")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LOOMLINK_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, which driver and executors share; only a local session gets a temporary one where it is unset."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset: the cluster must name a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="loomlink-"))
        found = sc.getCheckpointDir()
    return found.rstrip("/")


def kept(df: DataFrame) -> DataFrame:
    """df written as Parquet to the shared folder and read again; drop() removes it, or the end of the driver's process."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/loomlink-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    atexit.register(_remove, spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), path)
    made = spark.read.schema(df.schema).parquet(path)
    made._loomlink_path = path
    return made


def drop(*tables: DataFrame) -> None:
    """Removes kept tables. Nothing that is read later may stand on them."""
    for df in tables:
        sc = df.sparkSession.sparkContext
        _remove(sc._jvm, sc._jsc.hadoopConfiguration(), df._loomlink_path)


def once(key: str, make: Callable[[], DataFrame], spark: SparkSession) -> DataFrame:
    """The table of this key, made and written to the shared folder the first time in a session, and removed at the end."""
    at = (spark.sparkContext.applicationId, key)
    if at not in _ONCE:
        _ONCE[at] = kept(make())
    return _ONCE[at]


def _remove(jvm, conf, path: str) -> None:
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(conf).delete(where, True)


def checkpoint(df: DataFrame) -> DataFrame:
    """df written to the checkpoint folder, so that plans on it are short."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()
