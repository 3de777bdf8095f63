"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import ctypes
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def build_session(app: str = "tidegate", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators rely on; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder; on a cluster an unset
    folder is an error, because executors could not read each other's files.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        # ``local-cluster`` has executors of its own, with folders of their own.
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="tidegate-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def package_archive(folder: str) -> str:
    """Zip of this package, as Python workers import it."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    return shutil.make_archive(f"{folder}/tidegate", "zip", root, "tidegate")


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever they start; once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    # Code, not data: the driver serves this file to the executors while the application lives.
    context.addPyFile(package_archive(tempfile.mkdtemp(prefix="tidegate-code-")))
    _SHIPPED.add(context.applicationId)


def materialise(df: DataFrame, label: str, row_group_rows: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    For results that several passes use: the plan behind them runs once, and a lost executor
    costs a re-read, not a recomputation. A file is split between tasks at its row groups, which
    have ``row_group_rows`` rows at most; wide rows need that.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write
    if row_group_rows:
        writer = writer.option("parquet.block.row.count.limit", row_group_rows)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Hand Python workers at most ``rows`` rows at once, in what is run meanwhile.

    The default of 10,000 is meant for slim rows: of texts, a batch stands in full in the executor,
    once more while its buffer grows, and in the worker. A smaller limit that is set already stays.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if not 0 < int(before) <= rows:
        spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def give_back(run: Callable) -> Callable:
    """``run`` for ``mapInArrow``, after which its worker hands freed memory back to the system.

    Spark keeps Python workers for later tasks, and the allocators of an idle one keep what its
    largest task took, beside all that later stages need.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        # Only glibc keeps freed blocks in this way, and only it has the call.
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return whole


def scratch_folder(spark: SparkSession) -> str:
    """Folder of all intermediates of this application; remove it when their results are used up."""
    return f"{shared_dir(spark)}/scratch-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch folder; one per call, so reruns never collide."""
    return f"{scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Remove the intermediates of this application; results still lazy then fail to read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
