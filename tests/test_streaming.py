"""Streaming click rollup: incremental runs over new files equal the batch
pivot over all files, and re-running on the same checkpoint adds nothing."""

import os

from pyspark.sql import functions as F

from aisleflow.operators import pivots
from aisleflow.sources import adapters
from aisleflow.streaming import clicks as S


def _batch(spark, src, items):
    ev = spark.read.parquet(src)
    c = ev.select(F.col("user_id").alias("wl_customer_id"),
                  F.get_json_object("props", "$.k").cast("bigint").alias("wl_item_id"))
    return sorted(pivots.category_click_pivot(c, items).collect())


def test_incremental_rollup(spark, sf, tmp_path):
    events = spark.read.parquet(os.path.join(sf, "events.parquet"))
    src, sink, ckpt = str(tmp_path / "src"), str(tmp_path / "sink"), str(tmp_path / "ckpt")
    items = adapters.items(spark, sf)
    first, second = events.filter("event_id % 2 = 0"), events.filter("event_id % 2 = 1")
    first.coalesce(1).write.parquet(os.path.join(src, "part1"))
    # the source folder holds one sub-folder per arrival; read them by glob
    pattern = os.path.join(src, "part*")
    S.start_click_rollup(spark, pattern, items, sink, ckpt).awaitTermination()
    assert sorted(S.read_click_rollup(spark, sink).collect()) == _batch(spark, pattern, items)
    # same checkpoint, no new files: nothing is added
    S.start_click_rollup(spark, pattern, items, sink, ckpt).awaitTermination()
    assert sorted(S.read_click_rollup(spark, sink).collect()) == _batch(spark, pattern, items)
    # a new file arrives: only it is processed, totals equal the batch result
    second.coalesce(1).write.parquet(os.path.join(src, "part2"))
    S.start_click_rollup(spark, pattern, items, sink, ckpt).awaitTermination()
    assert sorted(S.read_click_rollup(spark, sink).collect()) == _batch(spark, pattern, items)
    assert len([d for d in os.listdir(sink) if d.startswith("batch_id=")]) == 2
    # compaction keeps the totals, and the last batch, which may be replayed
    assert S.compact(spark, sink) == 0 and S.compact(spark, sink) is None
    assert sorted(d for d in os.listdir(sink) if "=" in d) == ["base_upto=0", "batch_id=1"]
    assert sorted(S.read_click_rollup(spark, sink).collect()) == _batch(spark, pattern, items)
