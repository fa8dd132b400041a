"""SimHash near-duplicates by vantage-point trees over Hamming distance.

1. Fingerprints: 64 bits per document from all its word shingles (``shingle``
   words, repeats included); a bit is set if it is set in over half the hashes.
2. Equal fingerprints collapse to one row (partial aggregation on the map side).
3. A vantage-point tree is grown on a sample of the distinct fingerprints, which follows
   the number of its leaves: a node has a vantage point v and a radius m; ``distance <= m``
   is inside.  The number of leaves follows the number of fingerprints, so that
   a leaf holds about ``leaf_size`` of them.
4. Every fingerprint walks down the tree.  By the triangle inequality two
   fingerprints within ``max_bits`` of each other have distances to v that
   differ by at most ``max_bits``.  Both overlap the boundary by half of that
   (``reach`` below and above), so at each node they share a child, and hence
   they share a leaf: no pair is lost.
5. In a leaf a local vantage-point tree is searched: a query visits a child only if the
   triangle bound allows it, and candidates are compared exactly.  A leaf of
   any size is searched in blocks of bounded memory.
6. Components of the exact pairs come from iterated minimum labels with pointer
   jumping, as joins; each round is written to the shared folder.

What is broadcast is the tree: two arrays with an entry per leaf, checked
against ``max_tree_bytes``.

Defined results: null and empty texts have no words; their fingerprint is zero,
and they are linked like any other.  The component id is the smallest non-null
doc_id of the component (null if it has none).  Repeated rows and ids are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aisleflow.llm.common import binary_values, cut, ship


@dataclass(frozen=True)
class SimHashConfig:
    shingle: int = 3
    max_bits: int = 2
    #: Fingerprints a leaf of the shared tree should hold.
    leaf_size: int = 4000
    #: Fingerprints on which the shared tree is grown: as many as this, or ``sample_per_leaf`` for
    #: each of its leaves if that is more (so ``max_tree_bytes`` bounds it too).
    sample: int = 100_000
    sample_per_leaf: int = 8
    max_tree_bytes: int = 64 << 20


# ---------------------------------------------------------------- fingerprints

def fingerprint(text: bytes | None, size: int) -> int:
    """Unsigned 64-bit SimHash of a text in UTF-8."""
    import xxhash

    words = text.lower().split() if text else []
    if not words:
        return 0
    hash64 = xxhash.xxh64_intdigest
    if len(words) <= size:
        return hash64(b" ".join(words), 42)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - size + 1
    sums = np.zeros(64, np.int64)
    step = 1 << 16
    for i in range(0, n, step):
        j = min(n, i + step)
        hashes = np.fromiter((hash64(joined[a:b], 42) for a, b in zip(begins[i:j].tolist(), ends[i + size - 1:j + size - 1].tolist())),
                             np.uint64, j - i)
        sums += bit_sums(hashes)
    return int((np.uint64(1) << np.flatnonzero(2 * sums > n).astype(np.uint64)).sum(dtype=np.uint64))


def bit_sums(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit, the lowest bit first."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(len(hashes), 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, cfg: SimHashConfig = SimHashConfig()) -> DataFrame:
    """doc_id, text_hash (xxhash64 of the text, 0 for null), fp (long) per row."""
    ship(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    size = cfg.shingle

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            fps = np.fromiter((fingerprint(t, size) for t in binary_values(batch.column(1))), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(fps.view(np.int64))],
                                             names=["doc_id", "text_hash", "fp"])

    text_hash = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.xxhash64("text")).alias("text_hash")
    return docs.select("doc_id", "text", text_hash).mapInArrow(run, f"doc_id {id_type}, text_hash long, fp long")


# ------------------------------------------------------- vantage-point trees

def grow_tree(sample: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Vantage points and radii of a complete tree in heap order.

    A radius is taken near the median so that few of the sample's distances
    lie on the boundary; -1 marks a node that cannot be split (all go outside).
    """
    points = np.zeros((1 << depth) - 1, np.uint64)
    radii = np.full(len(points), -1, np.int16)
    parts = {0: sample}
    for node in range(len(points)):
        own = parts.pop(node, sample[:0])
        if len(own) < 2:
            continue
        # the candidate vantage point whose distances spread most
        tries = own[np.linspace(0, len(own) - 1, min(8, len(own))).astype(int)]
        some = own[:: max(1, len(own) // 2000)]
        spread = [np.bitwise_count(some ^ v).astype(float).var() for v in tries]
        v = tries[int(np.argmax(spread))]
        d = np.bitwise_count(own ^ v).astype(np.int16)
        hist = np.bincount(d, minlength=66)
        below = np.cumsum(hist)
        best, cost = -1, None
        for m in range(int(d.min()), int(d.max())):
            left, right = below[m], len(own) - below[m]
            # rows in the larger child, overlap included
            c = max(left + hist[m + 1], right + hist[m]) + 0.5 * (hist[m] + hist[m + 1])
            if cost is None or c < cost:
                best, cost = m, c
        points[node], radii[node] = v, best
        if best >= 0 and 2 * node + 2 < len(points):
            parts[2 * node + 1], parts[2 * node + 2] = own[d <= best], own[d > best]
    return points, radii


def route(fps: np.ndarray, points: np.ndarray, radii: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) of every leaf that a fingerprint belongs to or overlaps.

    Inside goes ``distance - above <= m``, outside ``distance + below > m``,
    with ``above + below = max_bits``: of two fingerprints on different sides
    at most ``max_bits`` apart, one reaches over to the other.
    """
    above, below = (max_bits + 1) // 2, max_bits // 2
    rows, nodes = np.arange(len(fps)), np.zeros(len(fps), np.int64)
    while len(nodes) and nodes[0] < len(points):
        d = np.bitwise_count(fps[rows] ^ points[nodes]).astype(np.int16)
        m = radii[nodes]
        inside = (m >= 0) & (d - above <= m)
        outside = (m < 0) | (d + below > m)
        rows = np.concatenate([rows[inside], rows[outside]])
        nodes = np.concatenate([2 * nodes[inside] + 1, 2 * nodes[outside] + 2])
    return rows, nodes - len(points)


def near_pairs(fps: np.ndarray, max_bits: int, small: int = 256):
    """Exact pairs (indices i, j) of distinct fingerprints within ``max_bits``,
    by recursive vantage-point splits; yields blocks of bounded size."""
    todo = [np.arange(len(fps))]
    above, below = (max_bits + 1) // 2, max_bits // 2
    while todo:
        own = todo.pop()
        f = fps[own]
        if len(own) > small:
            v = f[len(f) // 2]
            d = np.bitwise_count(f ^ v).astype(np.int16)
            m = int(np.median(d))
            inside, outside = own[d - above <= m], own[d + below > m]
            if max(len(inside), len(outside)) < 0.95 * len(own):
                todo += [inside, outside]
                continue
        step = max(1, (1 << 20) // max(1, len(own)))
        for a in range(0, len(own), step):
            i, j = np.nonzero(np.bitwise_count(f[a:a + step, None] ^ f[None, a:]) <= max_bits)
            i, j = i + a, j + a
            ok = i < j
            if ok.any():
                yield own[i[ok]], own[j[ok]]


def leaf_links(fps: np.ndarray, max_bits: int, forest: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links among the distinct fingerprints of a leaf; with ``forest`` only a
    star to the smallest of each component of the leaf, which connects the same."""
    found = list(near_pairs(fps, max_bits))
    if not found:
        return fps[:0], fps[:0]
    a, b = np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])
    if not forest:
        lo, hi = np.minimum(fps[a], fps[b]), np.maximum(fps[a], fps[b])
        return lo, hi
    parent = np.arange(len(fps))
    while True:
        low = np.minimum(parent[a], parent[b])
        before = parent.copy()
        np.minimum.at(parent, parent[a], low)
        np.minimum.at(parent, parent[b], low)
        np.minimum.at(parent, a, low)
        np.minimum.at(parent, b, low)
        parent = parent[parent]
        if (parent == before).all():
            break
    child = np.flatnonzero(parent != np.arange(len(fps)))
    return fps[parent[child]], fps[child]


def links(fps: DataFrame, cfg: SimHashConfig = SimHashConfig(), forest: bool = False) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints (column ``fp``) within ``max_bits``,
    all of them, or with ``forest`` pairs that connect the same components."""
    spark = fps.sparkSession
    ship(spark)
    distinct = fps.select("fp")
    n = distinct.count()
    depth = max(0, int(np.ceil(np.log2(max(1.0, n / cfg.leaf_size)))))
    if 10 << depth > cfg.max_tree_bytes:
        raise ValueError(f"{n} fingerprints need a tree of {10 << depth} bytes; raise leaf_size or max_tree_bytes")
    # a seeded hash decides on the sample: the share is exact on average
    share = min(1.0, max(cfg.sample, cfg.sample_per_leaf << depth) / max(1, n))
    sampled = distinct.where(F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) < int(share * (1 << 30))) if share < 1 else distinct
    sample = np.sort(sampled.toArrow().column("fp").to_numpy().view(np.uint64))
    points, radii = grow_tree(sample, depth)
    shared = spark.sparkContext.broadcast((points, radii))
    max_bits = cfg.max_bits

    def deal(batches):
        import pyarrow as pa

        for batch in batches:
            own = batch.column(0).to_numpy().view(np.uint64)
            rows, leaves = route(own, *shared.value, max_bits)
            for i in range(0, len(rows), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(leaves[i:i + 100_000]), pa.array(own[rows[i:i + 100_000]].view(np.int64))],
                                                 names=["leaf", "fp"])

    def search(batches):
        import pyarrow as pa

        def out(leaf):
            a, b = leaf_links(np.concatenate(leaf).view(np.uint64), max_bits, forest)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        now, held = None, []
        for batch in batches:  # sorted by leaf: one leaf is held at a time
            leaves, own = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            ends = np.append(np.flatnonzero(leaves[1:] != leaves[:-1]) + 1, len(leaves))
            begin = 0
            for end in ends:
                if begin == end:
                    continue
                if held and leaves[begin] != now:
                    yield out(held)
                    held = []
                now = leaves[begin]
                held.append(own[begin:end])
                begin = end
        if held:
            yield out(held)

    dealt = distinct.mapInArrow(deal, "leaf long, fp long")
    pairs = dealt.repartition("leaf").sortWithinPartitions("leaf", "fp").mapInArrow(search, "a long, b long")
    return pairs.distinct()


# ------------------------------------------------------------------ components

def components(pairs: DataFrame) -> DataFrame:
    """(fp, root) for every fingerprint that has a link; the root is the smallest
    fingerprint reachable.  Each round hooks the label of a node to the smallest
    label among its neighbours and then jumps; rounds go as the logarithm of the
    longest path in practice."""
    edges = cut(pairs.select("a", "b").union(pairs.select(F.col("b"), F.col("a"))))
    labels = edges.groupBy(F.col("a").alias("fp")).agg(F.min("b").alias("m")) \
        .select("fp", F.least("fp", "m").alias("root"))
    labels = cut(labels)
    while True:
        # smallest label among the neighbours, for the node and for its root
        near = edges.join(labels.withColumnRenamed("fp", "b"), "b").groupBy(F.col("a").alias("fp")).agg(F.min("root").alias("low"))
        step = labels.join(near, "fp").select("fp", "root", F.least("root", "low").alias("low"))
        hooks = step.groupBy("root").agg(F.min("low").alias("hook"))
        moved = step.join(hooks, "root").select("fp", "root", F.least("low", "hook").alias("new"))
        jump = labels.select(F.col("fp").alias("new"), F.col("root").alias("far"))
        after = cut(moved.join(jump, "new", "left").select(
            "fp", F.least("new", F.coalesce("far", "new")).alias("next"), "root"))
        changed = after.where(F.col("next") != F.col("root")).limit(1).count()
        labels = after.select("fp", F.col("next").alias("root"))
        if not changed:
            return labels


def groups(prints: DataFrame, cfg: SimHashConfig = SimHashConfig()) -> DataFrame:
    """One row per distinct fingerprint: fp, n_rows, first_id (its smallest
    doc_id), root (the smallest fingerprint of its component), component_id (the
    smallest doc_id of its component; of several components where an id is repeated)."""
    equal = cut(prints.groupBy("fp").agg(F.count("*").alias("n_rows"), F.min("doc_id").alias("first_id")))
    linked = components(links(equal, cfg, forest=True))
    member = equal.join(linked, "fp")
    smallest = member.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_linked = linked.join(smallest, "root").select(F.col("fp").alias("linked_fp"), "root", "component_id")
    return cut(equal.join(of_linked, F.col("fp") == F.col("linked_fp"), "left").select(
        "fp", "n_rows", "first_id", F.coalesce("root", "fp").alias("root"),
        F.when(F.col("linked_fp").isNull(), F.col("first_id")).otherwise(F.col("component_id")).alias("component_id")))


def with_component(prints: DataFrame, grouped: DataFrame, hot_share: float = 1e-3) -> DataFrame:
    """Join rows to their fingerprint's group.  Fingerprints that hold more than
    ``hot_share`` of all rows number at most ``1 / hot_share``; they are broadcast,
    so that no task gets a hot fingerprint's rows.  The others are shuffled."""
    total = grouped.agg(F.sum("n_rows")).first()[0] or 0
    bound = max(1, int(total * hot_share))
    slim = grouped.select("fp", "n_rows", "root", "component_id")
    hot = F.broadcast(slim.where(F.col("n_rows") > bound).select(
        F.col("fp").alias("hot_fp"), F.col("root").alias("hot_root"), F.col("component_id").alias("hot_id")))
    marked = prints.join(hot, F.col("fp") == F.col("hot_fp"), "left")
    cold = marked.where("hot_fp is null").drop("hot_fp", "hot_root", "hot_id").join(slim.where(F.col("n_rows") <= bound).drop("n_rows"), "fp")
    return cold.unionByName(marked.where("hot_fp is not null").withColumnsRenamed({"hot_root": "root", "hot_id": "component_id"}).drop("hot_fp"))


def near_duplicates(docs: DataFrame, cfg: SimHashConfig = SimHashConfig()) -> DataFrame:
    """doc_id, text_hash, fp, root, component_id for every row of ``docs``."""
    prints = cut(fingerprints(docs, cfg))
    return with_component(prints, groups(prints, cfg))


def keep_one(docs: DataFrame, cfg: SimHashConfig = SimHashConfig()) -> DataFrame:
    """The rows of ``docs``, all columns, one for each component: that with the
    component's smallest doc_id (of several such rows the one with the smallest
    text hash, and of equal rows any one; a component without ids keeps one row)."""
    found = near_duplicates(docs, cfg)
    rank = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_hash"))
    # by root: component ids may be null, or stand for several components
    kept = found.groupBy("root").agg(F.min(rank).alias("first")).select(
        F.coalesce("first.doc_id", F.lit(0)).alias("__kept_id"), F.col("first.doc_id").isNull().alias("__kept_null"),
        F.col("first.text_hash").alias("__kept_hash"))
    columns = docs.columns
    keyed = docs.withColumns({
        "__kept_id": F.coalesce("doc_id", F.lit(0)), "__kept_null": F.col("doc_id").isNull(),
        "__kept_hash": F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.xxhash64("text"))})
    keys = ["__kept_id", "__kept_null", "__kept_hash"]
    return keyed.join(kept, keys, "left_semi").dropDuplicates(keys).select(*columns)
