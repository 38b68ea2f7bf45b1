"""Session settings the jobs are written for."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from claimspark.sources.files import Folder


def build_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "claimspark") -> SparkSession:
    """Session with adaptive execution, skew-join splitting and UTC dates.

    ``master`` and ``shuffle_partitions`` are for local runs; on a cluster leave
    them out so that the submit settings decide.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.optimizer.runtime.bloomFilter.enabled", "true")
    )
    if master:
        builder = (
            builder.master(master)
            .config("spark.ui.enabled", "false")
            .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A throw-away folder is made only for a local master with nothing set; on a
    cluster without the setting this fails instead of using a machine's own disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if named or current:
        if current is None:
            spark.sparkContext.setCheckpointDir(named)
        return named or current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="claimspark-", dir=os.environ.get("TMPDIR"))
    spark.sparkContext.setCheckpointDir(made)
    return made


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock = threading.Lock()
#: Blocks of ``shuffles_freed`` that are open, and the setting from before the first of them.
_freed: list[str | None] = []


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Executions in this block drop their shuffle files when they end, not when the driver collects garbage.

    For writes of frames that are read back: nothing reads those files any more. An executor lost on the way
    still has its stages run again.
    """
    with _lock:  # several frames may be written at the same time: the last one restores the setting
        _freed.append(_freed[0] if _freed else spark.conf.get(_FREED, None))
        spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        with _lock:
            before = _freed.pop()
            if not _freed and before is None:
                spark.conf.unset(_FREED)
            elif not _freed:
                spark.conf.set(_FREED, before)


def staged(df: DataFrame) -> DataFrame:
    """Write a frame used by several outputs to the shared folder and read it back.

    Survives executor loss, keeps later plans short, and gives them exact sizes and
    column pruning.
    """
    path = f"{shared_dir(df.sparkSession)}/staged/{uuid.uuid4().hex}"
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Run:
    """Frames that one job keeps until its results are written, in a folder of its own below the shared one.

    ``with Run(spark) as run``: ``run.keep(frame)`` writes a frame and reads it back like ``staged``; at the
    end the folder goes, so frames kept in it must not be read after that.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{shared_dir(spark)}/runs/{uuid.uuid4().hex}"

    def keep(self, df: DataFrame) -> DataFrame:
        path = f"{self.path}/{uuid.uuid4().hex}"
        with shuffles_freed(self.spark):
            df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        Folder(self.spark, self.path).delete()

    def __enter__(self) -> Run:
        return self

    def __exit__(self, *_) -> None:
        self.close()
