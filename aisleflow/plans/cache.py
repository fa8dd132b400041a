"""Caches around iterative fits: who owns a cached frame, and when it goes.

``hold`` caches a frame for the enclosing ``owned()`` block (or memo entry), ``hold_for_fit`` one that
an iterative fit reads, in few partitions; its
release uncaches exactly those frames.  ``memo`` keeps a fit for the queries
that read it, by application, folder and name; the oldest go when there are
more than ``MAX_FITS``, and ``clear`` drops all.
"""

from __future__ import annotations

import gc
from collections import OrderedDict
from collections.abc import Callable
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

MAX_FITS = 24

# Session setting: "true" writes reused intermediates to the shared
# checkpoint folder instead of caching them on executors.
DURABLE_CONF = "spark.aisleflow.durableIntermediates"


class Owner:
    """The cached frames of one fit."""

    def __init__(self) -> None:
        self.frames: list[DataFrame] = []

    def release(self) -> None:
        while self.frames:
            self.frames.pop().unpersist()


_OWNERS: list[Owner] = [Owner()]  # the first is for frames held outside of any block
_FITS: OrderedDict[tuple, tuple[object, Owner]] = OrderedDict()


@contextmanager
def owned(keep: bool = False):
    """Frames held inside belong to the yielded owner; they are released at the
    end, unless ``keep`` hands that to the caller (an error always releases)."""
    owner = Owner()
    _OWNERS.append(owner)
    try:
        yield owner
    except BaseException:
        owner.release()
        raise
    finally:
        _OWNERS.remove(owner)
        if not keep:
            owner.release()


def adopt(df: DataFrame) -> DataFrame:
    """Put an already cached frame under the innermost owner."""
    _OWNERS[-1].frames.append(df)
    return df


def durable_enabled(spark: SparkSession) -> bool:
    return str(spark.conf.get(DURABLE_CONF, "false")).lower() == "true"


def stage_durable(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: one
    computation, lineage cut, and a lost executor costs a re-read of files."""
    from aisleflow.session import scratch_path
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def collect_garbage(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that nothing refers to any more.

    It does so when the driver's JVM happens to collect its garbage; a fit that fills little of the driver's memory would
    keep the files of all its passes until the end."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def hold(df: DataFrame) -> DataFrame:
    """Cache ``df`` for repeated reading, in at least as many partitions as the
    cluster runs tasks at once.

    Adaptive execution sizes the partitions of the cached plan by bytes.  Only where that
    leaves cores idle (then all of the data is less than one partition per core) are the
    cached rows dealt out again.  With durable intermediates the frame is written to the
    shared folder instead, and nothing is cached.
    """
    spark = df.sparkSession
    if durable_enabled(spark):
        return stage_durable(df)
    first = df.persist(StorageLevel.MEMORY_AND_DISK)
    first.count()
    n = spark.sparkContext.defaultParallelism
    if first.rdd.getNumPartitions() >= n:
        return adopt(first)
    even = first.repartition(n).persist(StorageLevel.MEMORY_AND_DISK)
    even.count()
    first.unpersist()
    return adopt(even)


def let_go(held: DataFrame) -> None:
    """Release one frame of the innermost owner before the others."""
    if held in _OWNERS[-1].frames:
        _OWNERS[-1].frames.remove(held)
        held.unpersist()


#: Partitions for each core of a frame that an iterative fit reads, at most.
FIT_PARTITIONS_PER_CORE = 2


def hold_for_fit(df: DataFrame) -> DataFrame:
    """``hold`` for the input of an iterative fit, in at most ``FIT_PARTITIONS_PER_CORE`` partitions a core.

    In each pass of a fit every task sends its statistics (for example classes x features doubles), and its
    metrics to the driver; with partitions by bytes that would grow with the rows times the passes.  Whole partitions
    are joined, so no rows are shuffled; a partition is read as a stream and need not fit in memory.
    """
    spark = df.sparkSession
    held = hold(df)
    most = FIT_PARTITIONS_PER_CORE * spark.sparkContext.defaultParallelism
    if held.rdd.getNumPartitions() <= most:
        return held
    few = held.coalesce(most)
    if durable_enabled(spark):
        return few  # nothing is cached
    few = few.persist(StorageLevel.MEMORY_AND_DISK)
    few.count()
    let_go(held)
    return adopt(few)


def in_few_partitions(df: DataFrame) -> DataFrame:
    """The held ``df`` for an iterative fit, like ``hold_for_fit``, but held as it lies, for wide rows.

    While a partition of a frame is stored, Spark's serializer keeps its last hundred batches of some 4 MB outside of the memory
    that it counts; joined partitions that are held again would take up to that in every running task."""
    most = FIT_PARTITIONS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(most) if df.rdd.getNumPartitions() > most else df


def memo(name: str, spark: SparkSession, folder: str, build: Callable):
    """``build()`` once for (application, folder, name)."""
    key = (spark.sparkContext.applicationId, folder, name)
    for old in [k for k in _FITS if k[0] != key[0]]:  # the frames went with their application
        del _FITS[old]
        _OWNERS[0].frames.clear()
    if key in _FITS:
        _FITS.move_to_end(key)
        return _FITS[key][0]
    with owned(keep=True) as owner:
        value = build()
    _FITS[key] = (value, owner)
    while len(_FITS) > MAX_FITS:
        _FITS.popitem(last=False)[1][1].release()
    return value


def clear() -> None:
    """Forget all fits and release what they hold, and what was held outside of
    any block."""
    while _FITS:
        _FITS.popitem()[1][1].release()
    _OWNERS[0].release()
