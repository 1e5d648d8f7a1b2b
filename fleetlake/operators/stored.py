"""Intermediate results in the session's shared folder (BF-3, BF-4).

A job of many joins leaves the files of every shuffle on the executors' disks until the driver happens to
collect its garbage. What is written here ends as a statement of its own, and its shuffle files go with it.
Jobs over large files are written in steps, and their last joins in slices: by a hash of a key that these
joins and groupings keep, one slice after the other, so that only the shuffles of one exist at a time.
Every row is in one slice.
"""

from __future__ import annotations

import logging
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.functions._util import as_col
from fleetlake.session import ensure_checkpoint_dir

log = logging.getLogger(__name__)

SLICE_BYTES = 1 << 30  # bytes of files that a job reads in one slice, every reading counted
MAX_SLICES = 4
SLICE = "__slice"

Step = Callable[[DataFrame, str], DataFrame]

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock = threading.Lock()
_within: dict[str, int | str | None] = {"users": 0, "before": None}


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of statements that start in here are removed when these end. For writes and counts,
    after which nothing reads the shuffles again."""
    with _lock:
        if not _within["users"]:
            _within["before"] = spark.conf.get(_CLEANUP, None)
            spark.conf.set(_CLEANUP, "true")
        _within["users"] += 1
    try:
        yield
    finally:
        with _lock:
            _within["users"] -= 1
            if not _within["users"]:
                if _within["before"] is None:
                    spark.conf.unset(_CLEANUP)
                else:
                    spark.conf.set(_CLEANUP, _within["before"])


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path on the shared storage that the session's checkpoint folder lies on."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder of this module, once everything that read it is written elsewhere."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def store(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once to a shared folder and read it from there. This is where the job of ``df`` runs,
    and fails if it does; what follows reads the written rows only."""
    return store_parts(lambda k: df, 1, name, path)


def store_parts(build: Callable[[int], DataFrame], n: int, name: str, path: str | None = None) -> DataFrame:
    """``store`` for the rows of ``build(0)`` to ``build(n - 1)`` together, one job after the other."""
    for k in range(n):
        df = build(k)
        path = path or shared_folder(df.sparkSession, name)
        log.debug("%s: part %d of %d", name, k + 1, n)
        with shuffles_dropped(df.sparkSession):
            df.write.mode("append").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole(df: DataFrame, name: str) -> DataFrame:
    """The step of a job that runs in one piece: nothing is written."""
    return df


def slices_for(df: DataFrame) -> int:
    """In how many slices a job is worth being run: by the bytes of the files that it reads. Sources that
    don't know their size (a database, rows of the driver) are not cut, as each slice reads them again."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return max(1, min(MAX_SLICES, -(-sum(s for s in sizes if s < 1 << 60) // SLICE_BYTES)))


def steps_for(df: DataFrame) -> Step:
    """``store`` for a job over large files, else ``whole``."""
    return store if slices_for(df) > 1 else whole


def by_size(df: DataFrame, name: str) -> DataFrame:
    """A step that decides by the files that ``df`` reads."""
    return steps_for(df)(df, name)


def reason(e: Exception) -> str:
    """The first line of what went wrong in a job. An error that Spark hands over as it is names the call that
    met it, and only its last cause the fault."""
    cause = getattr(e, "java_exception", None)
    while cause is not None and cause.getCause() is not None:
        cause = cause.getCause()
    text = str(e) if cause is None else cause.getMessage()
    return ((text or "").strip("' \n") or repr(e)).splitlines()[0]


def in_slice(n: int, k: int, key) -> Column:
    """Whether a row belongs to slice ``k`` of ``n``; equal keys (and all NULL ones) belong together."""
    return _slice_of(n, key) == k


def _slice_of(n: int, key) -> Column:
    return F.pmod(F.xxhash64(as_col(key).cast("string")), F.lit(n)).cast("int")


def store_by_slice(df: DataFrame, n: int, key, name: str, path: str | None = None) -> list[DataFrame]:
    """``store`` in a folder for each of ``n`` slices by ``key``: the rows of every slice."""
    path = path or shared_folder(df.sparkSession, name)
    dealt = df.withColumn(SLICE, _slice_of(n, key))
    log.debug("%s: in %d slices", name, n)
    with shuffles_dropped(df.sparkSession):
        dealt.write.option("compression", "zstd").partitionBy(SLICE).parquet(path)
    read = df.sparkSession.read.schema(dealt.schema).parquet(path)
    return [read.where(F.col(SLICE) == k).drop(SLICE) for k in range(n)]


def store_sliced(df: DataFrame, key, name: str, path: str | None = None, most: int = 2) -> DataFrame:
    """``store`` in slices by a column of ``df`` that the filter of a slice can be pushed down by. Each slice
    reads the sources again, so there are few. Without a ``key``, or for small files, there is one."""
    n = 1 if key is None else min(most, slices_for(df))
    return store_parts(lambda k: df if n == 1 else df.where(in_slice(n, k, key)), n, name, path)
