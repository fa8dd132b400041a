"""Sharding by minimum-cost-flow resharding.

Given the shard that each row lies in now and the capacities of the new shards,
move as few bytes as possible:

1. Bytes are summed by (old shard, hash block); the old shard sizes follow.
2. A transport problem with a node per shard: a byte that stays costs nothing, a
   byte that moves costs ``move_cost`` (1 by default).  Successive shortest paths give
   the flow of least cost; it has at most ``old + new - 1`` transfers.
3. A transfer is a byte range of an old shard, in the order of a row hash: blocks
   of rows.  The block in which a range ends is split at the row whose middle
   passes the boundary, so sizes are off by a few rows, not by a block.
   Rows with the very hash of an end (one, or all repeats of a row) are numbered and split by
   their number: they are dealt by range, written with their places, and a place becomes a number by prefix sums.
4. Rows find their new shard by comparing their hash and number with the ends of the ranges
   (at most ``old + new - 1``, broadcast).  Shards that gain or lose rows are rewritten,
   the others stay untouched.

Slots number the rows of a shard without gaps, from row numbers in hash blocks
and prefix sums over the counts of the blocks.

Size of a row: UTF-8 bytes of its text, none for null, plus ``overhead``.
Defined results: null ids and null or empty texts are rows like others; so are repeated rows, which are split
where a range ends among them.  Old shards may be
null, negative or beyond the new ones: such rows always move.  An empty table
gives an empty result.  Columns of the input named ``shard`` or ``slot`` are replaced.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aisleflow.llm.common import cut, shared_path

BLOCK_BITS = 12
#: Bound of the number of (shard, block) counts that are broadcast.
MAX_BLOCKS = 1 << 16


@dataclass(frozen=True)
class ReshardConfig:
    n_shards: int = 40
    overhead: int = 16


@dataclass(frozen=True)
class Transfer:
    old: int | None
    new: int
    n_bytes: int


def row_size(text: Column, overhead: int) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("long")


def even_capacities(total: int, n: int) -> list[int]:
    return [total // n + (j < total % n) for j in range(n)]


def min_cost_transfers(old: dict, capacities: list[int], move_cost: Callable | None = None) -> list[Transfer]:
    """Flows of least cost from old shards (name -> bytes) into new ones.

    Successive shortest paths with potentials on the bipartite graph; an
    augmentation saturates a supply, a capacity or a flow.  ``move_cost(i, j)`` is the cost of a byte.
    Without it a byte that stays costs 0 and one that moves 1: then the shortest paths are all arcs of cost 0
    first, and any arcs between what is left over after these, so the search is left out.
    """
    names = sorted(old, key=lambda k: (k is None, k if k is not None else 0))
    m, n = len(names), len(capacities)
    if sum(old.values()) > sum(capacities):
        raise ValueError("the new shards cannot hold the old ones")
    if move_cost is None:
        return _unit_cost_transfers(old, names, capacities)
    cost_of = move_cost
    cost = [[cost_of(i, j) for j in range(n)] for i in names]
    flow: dict[tuple[int, int], int] = {}
    supply, room = [old[i] for i in names], list(capacities)
    height = [0] * (m + n)
    while any(supply):
        # Dijkstra over reduced costs from all nodes with supply
        dist = [None] * (m + n)
        back = [None] * (m + n)
        queue = [(0, i) for i in range(m) if supply[i]]
        for _, i in queue:
            dist[i] = 0
        heapq.heapify(queue)
        done = [False] * (m + n)
        while queue:
            d, u = heapq.heappop(queue)
            if done[u]:
                continue
            done[u] = True
            if u < m:
                edges = ((m + j, cost[u][j]) for j in range(n))
            else:
                edges = ((i, -cost[i][u - m]) for i in range(m) if flow.get((i, u - m)))
            for v, c in edges:
                reach = d + c + height[u] - height[v]
                if not done[v] and (dist[v] is None or reach < dist[v]):
                    dist[v], back[v] = reach, u
                    heapq.heappush(queue, (reach, v))
        ends = [m + j for j in range(n) if room[j] and dist[m + j] is not None]
        end = min(ends, key=lambda v: (dist[v] + height[v], v))
        limit = dist[end]
        path = [end]
        while back[path[-1]] is not None:
            path.append(back[path[-1]])
        path.reverse()
        amount = min(supply[path[0]], room[end - m])
        for u, v in zip(path, path[1:]):
            if u >= m:
                amount = min(amount, flow[v, u - m])
        for u, v in zip(path, path[1:]):
            if u < m:
                flow[u, v - m] = flow.get((u, v - m), 0) + amount
            else:
                flow[v, u - m] -= amount
        supply[path[0]] -= amount
        room[end - m] -= amount
        height = [h + min(limit if d is None else d, limit) for h, d in zip(height, dist)]
    return [Transfer(names[i], j, f) for (i, j), f in sorted(flow.items()) if f]


def _unit_cost_transfers(old: dict, names: list, capacities: list[int]) -> list[Transfer]:
    """Bytes stay where there is room; then surplus fills room from both lists in order, which
    takes fewer transfers than shards."""
    own = lambda k: k if k is not None and 0 <= k < len(capacities) else None
    flow: dict[tuple, int] = {}
    room, left = list(capacities), dict(old)
    for k in names:
        j = own(k)
        if j is not None and min(left[k], room[j]):
            flow[k, j] = min(left[k], room[j])
            left[k] -= flow[k, j]
            room[j] -= flow[k, j]
    j = 0
    for k in names:
        while left[k]:
            while not room[j]:
                j += 1
            amount = min(left[k], room[j])
            flow[k, j] = flow.get((k, j), 0) + amount
            left[k] -= amount
            room[j] -= amount
    return [Transfer(k, j, f) for (k, j), f in sorted(flow.items(), key=lambda x: (x[0][0] is None, x[0][0] or 0, x[0][1]))]


def _row_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce(F.col("text"), F.lit("")))


def _block(h: Column, bits: int = BLOCK_BITS) -> Column:
    # the order of blocks is that of the hash
    return F.shiftright(h, 64 - bits)


@dataclass(frozen=True)
class Cut:
    """An end of a range: before it lie the rows of smaller hash and the first ``before`` of the ``n`` rows of its hash."""

    h: int
    before: int
    n: int


def plan(docs: DataFrame, old_shard: Column, cfg: ReshardConfig = ReshardConfig(),
         move_cost: Callable | None = None) -> tuple[list[Transfer], list[tuple]]:
    """(transfers, ranges); a range is (old, new, cut that it begins at, cut that it ends at), None at the ends."""
    spark = docs.sparkSession
    rows = docs.select(old_shard.cast("int").alias("old"), _row_hash().alias("h"), row_size(F.col("text"), cfg.overhead).alias("size"))
    blocks = rows.groupBy("old", _block(F.col("h")).alias("block")).agg(F.sum("size").alias("n"))
    upto = Window.partitionBy("old").orderBy("block")
    blocks = blocks.withColumn("end", F.sum("n").over(upto)).withColumn("begin", F.col("end") - F.col("n")).persist()
    try:
        sizes = {r["old"]: r["n"] for r in blocks.groupBy("old").agg(F.sum("n").alias("n")).collect()}
        transfers = min_cost_transfers(sizes, even_capacities(sum(sizes.values()), cfg.n_shards), move_cost)
        # byte offsets at which one transfer of an old shard ends and the next begins
        cuts, at = [], {}
        for t in transfers:
            at[t.old] = at.get(t.old, 0) + t.n_bytes
            if at[t.old] < sizes[t.old]:
                cuts.append((t.old, len(cuts), at[t.old]))
        ends: dict[int, Cut] = {}
        if cuts:
            cut_rows = F.broadcast(spark.createDataFrame(cuts, "old int, cut int, offset long"))
            hit = blocks.join(cut_rows, blocks["old"].eqNullSafe(cut_rows["old"]) & (F.col("begin") < F.col("offset")) & (F.col("offset") <= F.col("end"))) \
                .select(blocks["old"], "block", "cut", "offset", "begin")
            split = F.broadcast(hit.select(F.col("old").alias("old_"), F.col("block").alias("block_"), "begin").distinct())
            inside = rows.withColumn("block", _block(F.col("h"))).join(
                split, F.col("old").eqNullSafe(F.col("old_")) & (F.col("block") == F.col("block_"))).drop("old_", "block_")
            # rows with one hash are one piece
            pieces = inside.groupBy("old", "block", "begin", "h").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
            run = Window.partitionBy("old", "block").orderBy("h")
            pieces = pieces.withColumn("to", F.col("begin") + F.sum("size").over(run)).withColumn("from", F.col("to") - F.col("size"))
            # the piece in which the cut lies, and the number of its rows, to the nearest, before the cut
            found = hit.alias("c").join(pieces.alias("p"), F.col("c.old").eqNullSafe(F.col("p.old")) & (F.col("c.block") == F.col("p.block"))
                                        & (F.col("p.from") < F.col("c.offset")) & (F.col("c.offset") <= F.col("p.to"))) \
                .select("c.cut", "p.h", "p.n", F.round((F.col("c.offset") - F.col("p.from")) / F.col("p.size") * F.col("p.n")).cast("long").alias("before")).collect()
            ends = {r["cut"]: Cut(r["h"], r["before"], r["n"]) for r in found}
    finally:
        blocks.unpersist()
    ranges, low, c, at = [], {}, 0, {}
    for t in transfers:
        at[t.old] = at.get(t.old, 0) + t.n_bytes
        high = None
        if at[t.old] < sizes[t.old]:
            high, c = ends[c], c + 1
        ranges.append((t.old, t.new, low.get(t.old), high))
        low[t.old] = high
    return transfers, ranges


#: Rows of one hash that are numbered in a run, at least, and runs of one hash, at most.
RUN_ROWS, MAX_RUNS = 1 << 12, 1 << 9


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (of few hashes) with ``__nth``, their number from 0 among those of their old shard and hash.

    Rows are dealt by range of a place in the input, so repeats of a row spread over tasks; they are written with
    their places, and what is read back has the same numbers each time."""
    key = ["__old", "__h"]
    dealt = rows.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(*key, F.xxhash64("__tie")).sortWithinPartitions(*key)
    kept = cut(dealt.withColumn("__place", F.monotonically_increasing_id()).drop("__tie"), "cut-rows")
    # one row for each task and key
    part = F.shiftright("__place", 33)
    sizes = kept.groupBy(part.alias("__part"), *key).agg(F.count("*").alias("__n"), F.min("__place").alias("__first"))
    run = Window.partitionBy(*key).orderBy("__part")
    bases = sizes.select(F.col("__part").alias("b_part"), F.col("__old").alias("b_old"), F.col("__h").alias("b_h"), "__first",
                         (F.sum("__n").over(run) - F.col("__n")).alias("__base"))
    own = kept.join(bases, (part == F.col("b_part")) & F.col("__old").eqNullSafe(F.col("b_old")) & (F.col("__h") == F.col("b_h")))
    return own.withColumn("__nth", F.col("__base") + F.col("__place") - F.col("__first")).drop("b_part", "b_old", "b_h", "__first", "__base", "__place")


def assign(docs: DataFrame, old_shard: Column, ranges: list[tuple]) -> DataFrame:
    """``docs`` with ``__old``, ``__h``, ``__run`` (of rows that repeat many times) and ``__shard``.  The ranges are at most
    old + new - 1 rows."""
    spark = docs.sparkSession
    cuts = {(old, c.h): c for old, _, low, high in ranges for c in (low, high) if c is not None}
    rows = docs.withColumns({"__old": old_shard.cast("int"), "__h": _row_hash()})
    at_cut = F.broadcast(spark.createDataFrame([(old, h) for old, h in cuts], "c_old int, c_h long"))
    match = F.col("__old").eqNullSafe(F.col("c_old")) & (F.col("__h") == F.col("c_h"))
    plain = rows.join(at_cut, match, "left_anti").withColumn("__nth", F.lit(0).cast("long"))
    rows = plain.unionByName(_numbered(rows.join(at_cut, match, "left_semi"))) if cuts else plain
    flat = [(old, new, low and low.h, low and low.before, high and high.h, high and high.before) for old, new, low, high in ranges]
    table = spark.createDataFrame(flat, "r_old int, __shard int, low_h long, low_n long, high_h long, high_n long")
    h, nth = F.col("__h"), F.col("__nth")
    after = F.col("low_h").isNull() | (h > F.col("low_h")) | ((h == F.col("low_h")) & (nth >= F.col("low_n")))
    before = F.col("high_h").isNull() | (h < F.col("high_h")) | ((h == F.col("high_h")) & (nth < F.col("high_n")))
    most = max([c.n for c in cuts.values()], default=0)
    run = F.expr(f"cast(__nth div {max(RUN_ROWS, most // MAX_RUNS + 1)} as int)")
    return rows.join(F.broadcast(table), F.col("__old").eqNullSafe(F.col("r_old")) & after & before).withColumn("__run", run) \
        .drop("r_old", "low_h", "low_n", "high_h", "high_n", "__nth")


def with_slots(assigned: DataFrame, n_shards: int) -> DataFrame:
    """Adds ``__slot``, gapless from 0 in each shard, by order of hash and id.

    Rows are dealt once, by range of (shard, block, run), which also puts a shard's rows
    into few tasks.  The counts of the blocks are broadcast: a shard has so many
    blocks that all shards together have at most ``MAX_BLOCKS`` (or one each), and a cut ``MAX_RUNS`` runs.
    """
    bits = max(0, (MAX_BLOCKS // max(1, n_shards)).bit_length() - 1)
    block = _block(F.col("__h"), bits) if bits else F.lit(0).cast("long")
    place = ["__block", "__run"]
    counts = assigned.groupBy("__shard", block.alias("__block"), "__run").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("__shard").orderBy(*place)
    bases = counts.withColumn("__base", F.sum("n").over(upto) - F.col("n")).drop("n")
    dealt = assigned.withColumn("__block", block).repartitionByRange("__shard", *place)
    order = Window.partitionBy("__shard", *place).orderBy("__h", F.col("doc_id").cast("string"))
    numbered = dealt.withColumn("__row", F.row_number().over(order) - 1)
    return numbered.join(F.broadcast(bases), ["__shard", *place]).withColumn("__slot", (F.col("__base") + F.col("__row")).cast("long")) \
        .drop("__row", "__base", "__block", "__run", "__h")


def reshard(docs: DataFrame, old_shard: Column, cfg: ReshardConfig = ReshardConfig(), path: str | None = None,
            move_cost: Callable | None = None) -> tuple[DataFrame, list[Transfer]]:
    """Plan, then rewrite the affected shards below ``path`` (a fresh folder of
    the shared checkpoint folder by default) as ``shard=N`` folders of Parquet.

    Returns (rows, transfers): the columns of ``docs`` with ``shard`` and ``slot``,
    rewritten shards read back from the files, untouched ones as they were.
    """
    spark = docs.sparkSession
    columns = [c for c in docs.columns if c not in ("shard", "slot")]
    transfers, ranges = plan(docs, old_shard, cfg, move_cost)
    rows = with_slots(assign(docs, old_shard, ranges), cfg.n_shards).select(
        *columns, F.col("__slot").alias("slot"), F.col("__shard").alias("shard"))
    untouched = sorted({t.new for t in transfers} - {x for t in transfers if t.old != t.new for x in (t.old, t.new)})
    path = path or shared_path(spark, "shards")
    rows.where(~F.col("shard").isin(untouched)).write.partitionBy("shard").parquet(path)
    out = spark.read.schema(rows.schema).parquet(path)
    if untouched:
        out = out.unionByName(rows.where(F.col("shard").isin(untouched)))
    return out, transfers
