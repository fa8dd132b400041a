"""Exact dedup, SimHash and decontamination against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import nasty
from aisleflow.llm import decontaminate, exact_dedup, simhash
from aisleflow.llm.common import table
from aisleflow.llm.queries import QUERIES

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def fingerprint(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    grams = [" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] if len(words) >= size else [" ".join(words)] if words else []
    count = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), 42)
        for b in range(64):
            count[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * count[b] > len(grams))


def classes(fps, bits=2):
    """Component number of each fingerprint, by comparing all with all."""
    distinct = sorted(set(fps))
    parent = {f: f for f in distinct}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= bits:
                parent[root(b)] = root(a)
    return {f: root(f) for f in distinct}


def expected_components(rows):
    fps = [fingerprint(t) for _, t in rows]
    root = classes(fps)
    smallest = {}
    for (i, _), f in zip(rows, fps):
        if i is not None:
            smallest[root[f]] = min(i, smallest.get(root[f], i))
    return sorted(((i, f, smallest.get(root[f])) for (i, _), f in zip(rows, fps)), key=str)


def got_components(docs):
    return sorted(((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in simhash.near_duplicates(docs).collect()), key=str)


def test_simhash_edge_cases(spark, docs, none):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect() if not r["text"] or len(r["text"]) < 10_000]
    small = docs.where("text is null or length(text) < 10000")
    assert got_components(small) == expected_components(rows)
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one(none).count() == 0
    kept = simhash.keep_one(docs)
    found = simhash.near_duplicates(docs)
    assert kept.columns == docs.columns
    # one row a component (two components may print the same id where ids repeat)
    assert kept.count() == found.select("root").distinct().count()


def test_simhash_keeps_one_row_of_each_root(spark):
    """Components that share their smallest id are kept apart; those without ids are kept whole."""
    texts = ["one two three four five six seven", "quite another text of other words here", "and a third that is like none of them"]
    rows = [(7, texts[0]), (7, texts[1]), (8, texts[1]), (9, texts[1].upper()), (None, texts[2])]
    # two fingerprints within two bits of each other, on rows without ids
    rnd = random.Random(3)
    while True:
        words = [f"w{rnd.randrange(10 ** 6)}" for _ in range(400)]
        near = [*words[:-1], "changed"]
        a, b = fingerprint(" ".join(words)), fingerprint(" ".join(near))
        if a != b and (a ^ b).bit_count() <= 2:
            break
    rows += [(None, " ".join(words)), (None, " ".join(near))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    root = classes([fingerprint(t) for _, t in rows])
    assert len(set(root.values())) == 4
    kept = [tuple(r) for r in simhash.keep_one(docs).collect()]
    assert len({root[fingerprint(t)] for _, t in kept}) == len(kept) == 4
    assert set(kept) >= {rows[0], rows[1], rows[4]}


def test_simhash_keeps_the_roots_of_the_edge_cases(spark, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert simhash.keep_one(docs).count() == len(set(classes([fingerprint(t) for _, t in rows]).values()))


def test_simhash_query_is_brute_force_on_a_table(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").collect()]
    got = sorted(((r["doc_id"], int(r["fingerprint"], 16), r["component_id"]) for r in QUERIES["op6_simhash_near_dedup"](spark, sf).collect()), key=str)
    assert got == expected_components(rows)


def cloud(n, seed):
    """Random fingerprints, balls around some of them, and chains."""
    rnd = random.Random(seed)
    out = {rnd.getrandbits(64) for _ in range(n)} | {0, (1 << 64) - 1, 1 << 63}
    for c in rnd.sample(sorted(out), 30):
        for _ in range(20):
            c ^= 1 << rnd.randrange(64)
            out.add(c)
            out.add(c ^ 1 << rnd.randrange(64) ^ 1 << rnd.randrange(64))
    return sorted(out)


@pytest.mark.parametrize("max_bits", [1, 2, 3])
def test_vantage_point_trees_lose_no_pair(spark, max_bits):
    fps = cloud(1500, max_bits)
    all_bits = np.array(fps, np.uint64)
    want = {(fps[i], fps[j]) for i in range(len(fps)) for j in i + 1 + np.flatnonzero(np.bitwise_count(all_bits[i + 1:] ^ all_bits[i]) <= max_bits)}
    frame = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    cfg = simhash.SimHashConfig(max_bits=max_bits, leaf_size=100, sample=700)
    got = {tuple(sorted((r["a"] % (1 << 64), r["b"] % (1 << 64)))) for r in simhash.links(frame, cfg).collect()}
    assert got == want and len(want) > 100
    forest = simhash.links(frame, cfg, forest=True)
    named = {r["fp"] % (1 << 64): r["root"] for r in simhash.components(forest).collect()}
    root = classes(fps, max_bits)
    linked = {f for pair in want for f in pair}
    assert set(named) == linked
    by_root = collections.defaultdict(set)
    for f in linked:
        by_root[root[f]].add(named[f])
    assert all(len(v) == 1 for v in by_root.values()) and len({next(iter(v)) for v in by_root.values()}) == len(by_root)


def test_simhash_hot_fingerprint_is_joined_whole(spark):
    """A third of all rows share one fingerprint, whatever the hot share is."""
    docs = spark.createDataFrame([(i, "same text here" if i % 3 == 0 else f"text {i} of its own number {i * 7}") for i in range(600)], "doc_id long, text string")
    prints = simhash.fingerprints(docs)
    grouped = simhash.groups(prints)
    for share in (1e-3, 0.1, 1.0):
        got = simhash.with_component(prints, grouped, share)
        assert got.count() == 600 and got.where("component_id = 0").count() >= 200


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_hits(docs, items, size=10):
    window = collections.defaultdict(set)
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            window[tuple(w[k:k + size])].add(item)
    out = []
    for doc_id, text in docs:
        w = words(text)
        hit, ids = [False] * len(w), set()
        for n in {len(x) for x in window}:
            for k in range(len(w) - n + 1):
                own = window.get(tuple(w[k:k + n]))
                if own:
                    ids |= own
                    hit[k:k + n] = [True] * n
        out.append((doc_id, len(w), sum(hit), sorted(str(i) for i in ids if i is not None)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_bytes", [4 << 20, 1500])
def test_decontamination_edge_cases(spark, docs, none, block_bytes):
    long = " ".join(words(nasty.texts()[22])[20:60])
    items = [(1, long), (1, long), (2, long.upper() + "!"), (3, None), (4, ""), (5, "a"), (None, "the thing"), (6, "absent words never seen"),
             (10, "the and of the and of the and of the and of the and of"), (7, "日本語"), (9, "the")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    cfg = decontaminate.DecontaminateConfig(block_bytes=block_bytes)
    got = [(r["doc_id"], r["n_words"], sum(x["end"] - x["start"] for x in r["hit_ranges"]), r["item_ids"]) for r in decontaminate.find(docs, bench, cfg).collect()]
    want = brute_hits([(r["doc_id"], r["text"]) for r in docs.collect()], items)
    assert sorted(got, key=str) == want
    kept = decontaminate.remove_contaminated(docs, bench, cfg)
    assert kept.columns == docs.columns and kept.count() == sum(1 for w in want if not w[2])
    assert decontaminate.find(none, bench, cfg).count() == 0
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.remove_contaminated(docs, nothing, cfg).count() == docs.count()


def test_decontamination_repeated_words_and_overlaps(spark):
    doc = "x x x x x x x x x x x x x b c d e f g h i j k a a"
    items = [(1, "x x x x x x x x x x x"), (2, "x b c d e f g h i j k"), (3, "a a a")]
    docs = spark.createDataFrame([(1, doc)], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find(docs, bench).first()
    want = brute_hits([(1, doc)], items)[0]
    assert (got["doc_id"], got["n_words"], sum(x["end"] - x["start"] for x in got["hit_ranges"]), got["item_ids"]) == want


def test_decontamination_tables(spark):
    """Blocks, counts passed on early and spread keys change no result."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)] + ["the"] * 60
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    passages = [text(14) for _ in range(30)]
    items = [(i, rng.choice(passages) + " " + text(8)) for i in range(40)] + [(900 + i, passages[0]) for i in range(20)] + [(990, " ".join(passages))]
    rows = [(i, text(rng.randint(0, 30)) + " " + " ".join(rng.sample(passages, rng.randint(0, 3)))) for i in range(120)] + [(7, passages[0]), (None, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute_hits(rows, items)
    for cfg in (decontaminate.DecontaminateConfig(),
                decontaminate.DecontaminateConfig(block_bytes=20_000, tally_rows=10, rows_per_task=5)):
        found = decontaminate.find(docs, bench, cfg).collect()
        got = [(r["doc_id"], r["n_words"], sum(x["end"] - x["start"] for x in r["hit_ranges"]), r["item_ids"]) for r in found]
        assert sorted(got, key=str) == want
    sizes = []
    for index, last in decontaminate.passes(docs, bench, decontaminate.DecontaminateConfig(block_bytes=4000)):
        # what one pass holds: about a block, though one item has all passages and one passage is in twenty items
        sizes.append(sum(len(b" ".join(w)) * len(ids) for by_size in index.value.values() for _, rests in by_size
                         for values in rests.values() for _, w, ids in values))
    assert len(sizes) > 5 and last and max(sizes) < 8000


def brute_exact(rows, largest):
    groups = collections.defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").translate(LOWER)].append(doc_id)
    out = []
    for norm, ids in groups.items():
        real = [i for i in ids if i is not None]
        keep = (max if largest else min)(real) if real else None
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(norm.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("heavy", [1, 2, 50])
def test_exact_dedup_edge_cases(spark, docs, none, keep, heavy):
    cfg = exact_dedup.ExactDedupConfig(keep=keep, heavy=heavy, salts=3)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in exact_dedup.exact_dedup(docs, cfg).collect()), key=str)
    assert got == brute_exact(rows, keep == "largest")
    assert exact_dedup.exact_dedup(none, cfg).count() == 0


def test_exact_dedup_hot_group_is_spread(spark):
    """A third of the rows are one text; its rows lie in many runs of the sort."""
    docs = spark.range(0, 3000, 1, 6).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("Copy")).otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted((tuple(r) for r in exact_dedup.exact_dedup(docs).collect()), key=str) == brute_exact(rows, False)


def test_salts_follow_the_copies(spark):
    """The sample sees every text of more rows than a task should hold, and its runs follow its rows."""
    rows = [(i, "hot text") for i in range(4000)] + [(4000 + i, "warm") for i in range(700)] + [(9000 + i, f"text {i}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    cfg = exact_dedup.ExactDedupConfig(sample=100, salts=2, rows_per_task=200)
    heavy = {r["heavy_hash"]: r["salts"] for r in exact_dedup.heavy_hashes(docs, F.col("text"), cfg).collect()}
    hashes = {r["text"]: r["h"] for r in docs.where("text in ('hot text', 'warm')").select("text", F.xxhash64("text").alias("h")).distinct().collect()}
    assert set(heavy) == set(hashes.values()) and 15 <= heavy[hashes["hot text"]] <= 25 and 2 <= heavy[hashes["warm"]] <= 6
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_dedup(docs, cfg).collect()}
    assert all(got[i] == (0, 4000, i == 0) for i in range(4000)) and all(got[4000 + i] == (4000, 700, i == 0) for i in range(700))
    assert all(got[9000 + i] == (9000 + i, 1, True) for i in range(3000))


def test_shared_tree_of_many_leaves_is_even(spark):
    """The sample follows the leaves, so that none holds many times the mean; the pairs are those of brute force."""
    rng = np.random.default_rng(5)
    fps = rng.integers(0, 1 << 63, 40_000, dtype=np.uint64)
    depth = 10
    own = np.sort(fps[rng.permutation(len(fps))[:8 << depth]])
    points, radii = simhash.grow_tree(own, depth)
    _, leaves = simhash.route(fps, points, radii, 2)
    sizes = np.bincount(leaves - leaves.min())
    assert sizes.max() < 10 * sizes[sizes > 0].mean()
    near = np.concatenate([fps[:300], fps[:100] ^ np.uint64(5), fps[50:90] ^ np.uint64(1 << 40)])
    frame = spark.createDataFrame([(int(x),) for x in near.view(np.int64)], "fp long").distinct()
    got = {tuple(sorted((r["a"], r["b"]))) for r in simhash.links(frame, simhash.SimHashConfig(leaf_size=4, sample=10)).collect()}
    values = sorted({int(x) for x in near.view(np.int64)})
    want = {(a, b) for i, a in enumerate(values) for b in values[i + 1:] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}
    assert got == want and len(want) >= 140
