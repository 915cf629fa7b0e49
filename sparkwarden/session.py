"""Session defaults and the one way this package cuts lineage."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "sparkwarden", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on. Cluster sizing stays with the caller."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Settings that change results, and the package for the workers, for a session made elsewhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # Joins on a hot key rely on being split at run time.
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # A line whose nested object repeats a key is still a good line: the last value wins.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application: Arrow functions import it there."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="sparkwarden-package-")
    context.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name))
    _SHIPPED.add(context.applicationId)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only where none is named, as in tests."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="sparkwarden-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back (an action).

    The written table cuts lineage, outlives lost executors and, unlike a row checkpoint, keeps column pruning
    and filter pushdown for the jobs that read it several times.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._scratch_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Remove tables that ``materialize`` wrote, once nothing reads them any more."""
    for df in tables:
        path = df.__dict__.pop("_scratch_path", None)
        if path is not None:
            jvm_path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            jvm_path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(jvm_path, True)


def even(df: DataFrame, key: str, least: int = 1) -> DataFrame:
    """Rows dealt by ``key`` over all cores, for heavy work on each row, and over ``least`` tasks or more.

    Adaptive execution merges partitions by bytes; a kernel that takes long over few bytes would end up in few tasks.
    """
    spark = df.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")), least)
    return df.repartition(tasks, key)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows of a badly split input, such as one small or one unsplittable file, over all cores.

    An input with at least as many splits as cores is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df
