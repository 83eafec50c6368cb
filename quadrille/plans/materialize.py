"""Cutting lineage so that a result survives the loss of executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Directory for reliable checkpoints.

    A cluster names a shared folder in ``spark.checkpoint.dir``.  Only a local
    session without that setting gets a folder of its own.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="quadrille-checkpoint-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


#: Size estimates with more bits than this say nothing about the data any more.
_ESTIMATE_BITS = 56


def size_estimate_bits(df: DataFrame) -> int:
    """Bits of the optimizer's size estimate for ``df``."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()).bit_length()


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Actions on frames made inside drop their shuffle files when they end, not when the driver happens to collect garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and read it back from the checkpoint folder; its shuffle files are dropped.

    A checkpoint keeps the size estimate of the plan it cuts, and each join multiplies
    estimates, so in an iteration they grow to numbers that the planner spends its time
    on.  An estimate beyond 2 ** 56 is dropped: the plan starts afresh from the stored rows.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    with shuffles_released(spark):
        # the setting holds for the frame made here
        kept = df.select("*").checkpoint(eager=True)
    if size_estimate_bits(kept) <= _ESTIMATE_BITS:
        return kept
    rows = kept._jdf.queryExecution().toRdd()
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(rows, kept._jdf.schema(), False), spark)


def kept_folder(spark: SparkSession, name: str) -> str:
    """Folder below the checkpoint folder for results that are read later; deleted when the application ends."""
    folder = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


@contextmanager
def scratch_folder(spark: SparkSession, name: str) -> Iterator[str]:
    """Folder below the checkpoint folder that is deleted at the end."""
    folder = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
