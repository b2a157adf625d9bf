"""Session settings and the shared folder for stage tables."""

from __future__ import annotations

import contextlib
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs are written for.  They are defaults only: whatever the
# cluster or the caller sets wins.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8, **conf) -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("stockloom")
    settings = dict(DEFAULTS)
    settings.update(
        {
            "spark.sql.shuffle.partitions": str(shuffle_partitions),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
            # Test data is far below the default minimum partition, which
            # would run numeric steps on a single core.
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        }
    )
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Python steps hold a batch several times over (Arrow, objects, results), so batches
# are kept below Spark's default; a session that sets the limit itself keeps its own.
ARROW_BYTES, ARROW_DEFAULT, ARROW_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "8m"

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, and bound
    the batches that they are handed.

    Needed where it is not installed on the executors; the driver hands the
    archive to Spark, which distributes it.
    """
    if spark.conf.get(ARROW_BYTES) == ARROW_DEFAULT:
        spark.conf.set(ARROW_BYTES, ARROW_LIMIT)
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = Path(__file__).resolve().parent
        target = Path(os.path.realpath(tempfile.mkdtemp(prefix="stockloom-"))) / package.name
        archive = shutil.make_archive(str(target), "zip", package.parent, package.name)
        spark.sparkContext.addPyFile(archive)
        _shipped.add(app)


# Fallback folder of a local session without the setting, made once.
_local_folder: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder; on a cluster a
    missing setting is an error, since a machine-local path would lose data
    with the machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if not _local_folder:
            _local_folder.append(tempfile.mkdtemp(prefix="stockloom-"))
        folder = _local_folder[0]
    return folder.rstrip("/")


# Folders of the runs now open, the innermost last.
_runs: list[str] = []


@contextlib.contextmanager
def stage_folder(spark: SparkSession) -> Iterator[str]:
    """Stages written inside the block go to one folder, dropped at its end.

    Results that read stages must be written out, or collected, inside.
    """
    path = f"{shared_dir(spark)}/run-{uuid.uuid4().hex}"
    _runs.append(path)
    try:
        yield path
    finally:
        _runs.remove(path)
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a stage table; never one that is being read."""
    return f"{_runs[-1] if _runs else shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a stage that several later steps read, and read it back.

    Survives lost executors (unlike a cached or locally checkpointed frame)
    and gives the later steps real file statistics to plan with.
    """
    path = stage_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
