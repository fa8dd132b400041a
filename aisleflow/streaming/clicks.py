"""Category-click pivot over a stream of click events.

The batch jobs recompute the customer x category click counts from all
clicks.  Here new event files are read as a file stream; each micro-batch goes
through the batch operator with the static item table, and its partial pivot is written to its own
``batch_id=N`` folder with overwrite, so a replayed batch (after a failure,
from the checkpoint) replaces its own output and never double counts.  The
read side sums the partials per customer: an append-only rollup that needs
no MERGE-capable table format and no state store, and keeps the final
aggregate a partial-then-final hash aggregate over small rows.

``compact`` sums the partials of all batches but the last (which may be replayed)
into one ``base_upto=N`` folder; readers take the newest base and the batches after
it, so the rollup does not read every batch ever written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aisleflow.operators import pivots
from aisleflow.operators.pivots import DEFAULT_CATEGORIES
from aisleflow.sources import adapters

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def stream_path(spark: SparkSession, path: str) -> str:
    """File-stream sources take folders or glob patterns; a single file is turned
    into a pattern that matches only itself, on whatever file system it lies."""
    fs, p = _fs(spark, path)
    if fs.exists(p) and fs.getFileStatus(p).isFile():
        folder, name = path.rsplit("/", 1)
        return f"{folder}/[{name[0]}]{name[1:]}"
    return path


def start_click_rollup(spark: SparkSession, source: str, items: DataFrame, sink_dir: str,
                       checkpoint_dir: str, *, categories=DEFAULT_CATEGORIES,
                       available_now: bool = True, max_files_per_trigger: int | None = None):
    """Start the streaming rollup; returns the ``StreamingQuery``."""
    r = spark.readStream.schema(EVENTS_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    clicks = adapters.click_rows(r.parquet(stream_path(spark, source)))
    cats = list(categories)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        part = pivots.category_click_pivot(batch, items, categories=cats)
        part.write.mode("overwrite").parquet(f"{sink_dir}/batch_id={batch_id}")

    w = clicks.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def _folders(spark: SparkSession, sink_dir: str) -> tuple[dict[int, str], dict[int, str]]:
    """(bases, batches): folders of the sink by their number."""
    fs, root = _fs(spark, sink_dir)
    found: dict[str, dict[int, str]] = {"base_upto": {}, "batch_id": {}}
    for status in fs.listStatus(root) if fs.exists(root) else []:
        kind, _, number = status.getPath().getName().partition("=")
        if kind in found and number.isdigit() and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            found[kind][int(number)] = status.getPath().toString()
    return found["base_upto"], found["batch_id"]


def _current(spark: SparkSession, sink_dir: str) -> tuple[int, list[str]]:
    bases, batches = _folders(spark, sink_dir)
    upto = max(bases, default=-1)
    return upto, ([bases[upto]] if upto >= 0 else []) + [p for n, p in sorted(batches.items()) if n > upto]


def _summed(parts: DataFrame, categories) -> DataFrame:
    return parts.groupBy("wl_customer_id").agg(*[F.sum(f"clicks_in_{n}").alias(f"clicks_in_{n}") for n in categories])


def read_click_rollup(spark: SparkSession, sink_dir: str, *,
                      categories=DEFAULT_CATEGORIES) -> DataFrame:
    """Current per-customer click pivot: the newest base plus the batches after it."""
    return _summed(spark.read.parquet(*_current(spark, sink_dir)[1]), categories)


def compact(spark: SparkSession, sink_dir: str, *, categories=DEFAULT_CATEGORIES) -> int | None:
    """Sum the newest base and all later batches but the last into a new base, then
    drop what it replaces.  Returns the last batch in the base, None if there is
    nothing to do.  A base without its success mark is not read, so a
    failure on the way changes nothing."""
    upto, _ = _current(spark, sink_dir)
    bases, batches = _folders(spark, sink_dir)
    done = sorted(n for n in batches if n > upto)[:-1]
    if not done:
        return None
    paths = ([bases[upto]] if upto >= 0 else []) + [batches[n] for n in done]
    _summed(spark.read.parquet(*paths), categories).write.mode("overwrite").parquet(f"{sink_dir}/base_upto={done[-1]}")
    fs, _ = _fs(spark, sink_dir)
    for path in [p for n, p in batches.items() if n <= done[-1]] + list(bases.values()):
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(path), True)
    return done[-1]
