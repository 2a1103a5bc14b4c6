"""Session helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("deedmill")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate results that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``; only a local session
    without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir", None)
        if named is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
            named = tempfile.mkdtemp(prefix="deedmill-checkpoint-")
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


#: Folders of the jobs that run now, the innermost last.
_JOBS: ContextVar[tuple[str, ...]] = ContextVar("jobs", default=())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, or under that of the job that runs."""
    jobs = _JOBS.get()
    return f"{jobs[-1] if jobs else shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def job_folder(spark: SparkSession) -> Iterator[None]:
    """What is staged or frozen inside of the block is removed at its end.

    For jobs that write their results: frames made inside must not be read after.
    """
    path = scratch_path(spark, "job")
    token = _JOBS.set((*_JOBS.get(), path))
    try:
        yield
    finally:
        _JOBS.reset(token)
        fs, folder = filesystem(spark, path)
        fs.delete(folder, True)


def cleans_up(job):
    """Run a job in a folder of its own; its session is found among the arguments."""

    @wraps(job)
    def run(*args, **kwargs):
        given = [*args, *kwargs.values()]
        spark = next(a if isinstance(a, SparkSession) else a.sparkSession for a in given if isinstance(a, (SparkSession, DataFrame)))
        with job_folder(spark):
            return job(*args, **kwargs)

    return run


def freeze(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in reliable storage and cut its lineage.

    Used where two later passes must see the very same rows (sampled ranges,
    sketches), also after an executor is lost.
    """
    return staged(df, "frozen")


def filesystem(spark: SparkSession, path: str):
    """Hadoop's file system and path object for ``path``."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: for frames that several
    passes read, each of them some of the columns."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staging(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``staged`` for jobs that are through with the frame at the end of the block."""
    path = scratch_path(df.sparkSession, name)
    fs, folder = filesystem(df.sparkSession, path)
    try:
        df.write.parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        fs.delete(folder, True)
