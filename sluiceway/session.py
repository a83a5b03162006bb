"""Session defaults and the shared folder used for intermediate tables."""

from __future__ import annotations

import contextlib
import contextvars
import gc
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_OWN_FOLDERS: dict[str, str] = {}
#: The folders of the jobs at work in this thread, the innermost last.
_JOBS: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("jobs", default=())

# The JVM interprets, and never compiles, methods above 8000 bytes of code. Wide projections such as the
# device decoding reach that in one generated method. A cluster sets the same option for its executors.
COMPILE_LARGE_METHODS = "-XX:-DontCompileHugeMethods"


def local_session(cores: str = "*", **conf: str) -> SparkSession:
    """A local session for tests and the bench. On a cluster, pass the cluster's own session around."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sluiceway")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.extraJavaOptions", COMPILE_LARGE_METHODS)
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh sub-folder of the storage that every executor can reach.

    The cluster names the root in ``spark.checkpoint.dir``. Only a local session without that setting
    gets a temporary folder, because a machine-local path is lost to the other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if context.applicationId not in _OWN_FOLDERS:
            _OWN_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="sluiceway-")
        root = _OWN_FOLDERS[context.applicationId]
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def hand_over(df: DataFrame, purpose: str, beyond: bool = False) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    The stages of a long pipeline use this where a later step reads its input more than once, so that the
    earlier steps run once and a lost executor costs no more than the files it was reading. ``beyond`` is for what a
    job leaves to its caller: it belongs to the ``own_files`` block around the innermost one.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    jobs = _JOBS.get()[: -1 if beyond else None]
    if jobs:
        jobs[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sweep(spark: SparkSession) -> None:
    """Let go of what finished jobs have left, so that Spark deletes their shuffle files now.

    Spark deletes the files of a shuffle when the driver's memory no longer holds its plan, which without pressure on that
    memory may be long after. Call it after a large ``hand_over``, whose files take the place of the shuffles. The scheduler
    holds on to the job that ended last, so a small one is run first.
    """
    gc.collect()
    spark.range(1).count()
    spark._jvm.System.gc()


@contextlib.contextmanager
def own_files(spark: SparkSession) -> Iterator[list[str]]:
    """Delete, at the end, what is handed over inside the ``with`` block, and nothing else.

    For a job that stores its results: frames that were handed over inside cannot be read after. A block inside another has
    files of its own; other threads and frames planned before are not touched.
    """
    written: list[str] = []
    token = _JOBS.set((*_JOBS.get(), written))
    try:
        yield written
    finally:
        _JOBS.reset(token)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for folder in written:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)
