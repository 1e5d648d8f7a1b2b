"""Divergence, sharding and centroids on small tables against brute force; odd rows; the structures
they rest on."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlake.llm import op11_divergence, op12_sharding, op13_centroids
from tests.llm.test_ops import CLASH, DOCS, by_id, odd_rows, prose

MORE_CLASH = CLASH + ["docs", "slot", "shard", "base", "v", "apex", "cluster", "distance", "value", "rank", "part", "item", "total", "tile", "size",
                      "__salt", "grown_shard", "compared"]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS).select("*", *[F.lit(0).alias(c) for c in MORE_CLASH])


# ---- 11 divergence -------------------------------------------------------------------------------------
def brute_divergence(rows, min_docs, top):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [(lang or "", source or "", [t.translate(low) for t in term.findall(text or "")]) for lang, source, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for _, _, ts in mine for t in set(ts))
        kept = sorted(t for t, n in df.items() if n >= min_docs)
        keep = set(kept)
        counts = defaultdict(Counter)
        for _, source, ts in mine:
            counts[source].update(t for t in ts if t in keep)
        def share(c):
            total = sum(c.values()) + 5 * len(kept)
            return {t: 1 + 10 ** 9 * (c[t] + 5) // total for t in kept}
        q = share(sum(counts.values(), Counter()))
        p = {s: share(c) for s, c in counts.items()}
        for s in p:
            found = {"pair": [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in p if o != s],
                     "term": [(p[s][t] - q[t], t) for t in kept if counts[s][t] > 0 and p[s][t] > q[t]]}
            for part, items in found.items():
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(items) if part == "pair" or k < top]
    return sorted(out)


def divergence_rows():
    rows = []
    for i in range(60):
        text = prose(60, i) + " Zoë ÀB-cd x9y" * (i % 3) + " common common" * (i % 5)
        rows.append(("en" if i % 3 else None, f"s{i % 7}" if i % 11 else None, text))
    rows += [("de", "only", prose(40, 1))] * 4 + [("fr", "a", "eins"), ("fr", "b", None), ("fr", None, ""), ("en", "empty", "12 34 !!")]
    return rows


@pytest.mark.parametrize("shard_terms, broadcast_bytes, tile", [(16_384, 64 << 20, 256), (20, 64 << 20, 2), (20, 1600, 3)])
def test_divergence_brute_force(spark, monkeypatch, shard_terms, broadcast_bytes, tile):
    rows = divergence_rows()
    df = spark.createDataFrame(rows, "lang string, source string, text string").repartition(3)
    got = op11_divergence.divergence(df, 3, 10, shard_terms, broadcast_bytes, tile)
    assert sorted(tuple(r) for r in got.collect()) == brute_divergence(rows, 3, 10)


def test_divergence_odd_rows(spark, odd):
    rows = [(r["lang"], r["source"], r["text"]) for r in odd.collect()]
    assert sorted(tuple(r) for r in op11_divergence.divergence(odd, 2, 50).collect()) == brute_divergence(rows, 2, 50)
    assert op11_divergence.divergence(odd.limit(0)).count() == 0


def test_divergence_tasks_emit_early(spark, monkeypatch):
    """Small bounds on what a task holds change nothing."""
    rows = divergence_rows()
    monkeypatch.setattr(op11_divergence, "HELD", 40)
    monkeypatch.setattr(op11_divergence, "DENSE", 30)
    import pyarrow as pa
    hashes = [{"lang": "", "shards": 1, "shard": 0, "base": 0}, {"lang": "en", "shards": 1, "shard": 0, "base": 0}]
    vocab = sorted({t for _, _, x in rows for t in op11_divergence.terms((x or "").encode())})
    seed, moves, stored = op11_divergence.build_hash(vocab)
    for h in hashes:
        h |= {"seed": seed, "moves": moves.astype("<i4").tobytes(), "stored": b" ".join(stored)}
    shared = type("B", (), {"value": hashes})
    batch = pa.RecordBatch.from_pydict({"lang": [r[0] or "" for r in rows], "source": [r[1] or "" for r in rows], "text": [(r[2] or "").encode() for r in rows]})
    found = Counter()
    pieces = [batch.slice(i, 5) for i in range(0, len(rows), 5)]
    for b in op11_divergence._recount(shared)(iter(pieces)):
        for lang, source, slot, n in zip(*(b.column(i).to_pylist() for i in range(4))):
            found[lang, source, stored[slot]] += n
    want = Counter()
    for lang, source, text in rows:
        if lang in (None, "en"):
            want.update((lang or "", source or "", t) for t in op11_divergence.terms((text or "").encode()))
    assert found == want


def test_perfect_hash_is_minimal_and_rejects_others():
    for n in (1, 2, 3, 50, 5000):
        keys = [b"k%d" % i for i in range(n)]
        seed, moves, stored = op11_divergence.build_hash(keys)
        assert sorted(stored) == sorted(keys)
        at = op11_divergence.places(keys, seed, moves, stored)
        assert sorted(at.tolist()) == list(range(n)) and all(stored[p] == k for p, k in zip(at, keys))
        assert (op11_divergence.places([b"other%d" % i for i in range(200)], seed, moves, stored) == -1).all()


def test_shares_are_exact_for_large_counts():
    rng = np.random.default_rng(3)
    for total in (7, 10 ** 6 + 3, 2 * 10 ** 14 + 1):
        n = np.append(rng.integers(1, total, 500), [1, total])
        assert op11_divergence.shares(n, np.full(len(n), total)).tolist() == [1 + 10 ** 9 * int(x) // total for x in n]


# ---- 12 sharding ---------------------------------------------------------------------------------------
def brute_shard(key, tree):
    """Descent with the draws of each level computed plainly."""
    def weight(node):
        return sum(map(weight, node.values())) if isinstance(node, dict) else node
    at, name = tree, ""
    while True:
        draws = []
        for child, below in at.items():
            path = f"{name}/{child}" if name else str(child)
            u = (int(hashlib.md5(f"{key}/{path}".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
            if weight(below) > 0:
                draws.append((-math.log(u) / weight(below), path, child, below))
        _, name, child, at = min(draws)
        if not isinstance(at, dict):
            return child


def placements(spark, tree, n=4000):
    return {r["id"]: r["s"] for r in spark.range(n).select("id", op12_sharding.shard_of(F.col("id").cast("string"), tree).alias("s")).collect()}


def test_tree_matches_plain_descent(spark):
    tree = op12_sharding.make_tree()
    tree["region1"]["rack2"][9] = 3.5
    tree["region2"]["rack4"][17] = 0.0
    got = placements(spark, tree)
    assert got == {i: brute_shard(i, tree) for i in got} and 17 not in got.values()


def test_new_shard_takes_rows_only_into_itself(spark):
    tree = op12_sharding.make_tree()
    before = placements(spark, tree)
    for _ in range(3):
        tree = op12_sharding.grow(tree)
        new = max(s for racks in tree.values() for rack in racks.values() for s in rack)
        after = placements(spark, tree)
        moved = {i for i in before if before[i] != after[i]}
        assert moved and all(after[i] == new for i in moved)
        assert 0.5 < len(moved) / (len(before) / (new + 1)) < 1.5
        before = after


def test_weights_move_rows_only_along_changed_subtrees(spark):
    tree = op12_sharding.make_tree()
    before = placements(spark, tree)
    changed = op12_sharding.make_tree()
    changed["region0"]["rack1"][5] = 2.0
    after = placements(spark, changed)
    for i in before:
        if before[i] != after[i]:
            a, b = before[i], after[i]
            # into the heavier region, inside it into the heavier rack, inside that into the heavier shard
            assert b // 8 == 0 and (a // 8 != 0 or b // 4 == 1) and (a // 4 != 1 or b == 5)
    share = sum(s == 5 for s in after.values()) / len(after)
    assert abs(share - 2 / 25) < 0.015
    counts = Counter(before.values())
    assert len(counts) == 24 and max(counts.values()) < 1.5 * 4000 / 24


def test_sharding_odd_rows(spark, odd):
    tree = op12_sharding.make_tree()
    rows = op12_sharding.deal(odd, tree, op12_sharding.grow(tree)).collect()
    source = odd.collect()
    want = [(r["doc_id"], len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode())) for r in source]
    assert by_id([(r["doc_id"], r["size"], r["text_crc32"]) for r in rows]) == by_id(want)
    for r in rows:
        key = "" if r["doc_id"] is None else str(r["doc_id"])
        assert r["shard"] == brute_shard(key, tree) and r["grown_shard"] == brute_shard(key, op12_sharding.grow(tree))
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert op12_sharding.deal(odd.limit(0), tree).count() == 0


def test_sharding_of_one_hot_id(spark):
    """A null id with most rows: its shard is numbered over several tasks."""
    df = spark.createDataFrame([(None if i % 4 else i, "same") for i in range(800)], "doc_id long, text string").repartition(5)
    rows = op12_sharding.deal(df, op12_sharding.make_tree()).collect()
    assert len(rows) == 800 and len({(r["shard"], r["slot"]) for r in rows}) == 800
    assert all(r["grown_shard"] is None for r in rows)


# ---- 13 centroids --------------------------------------------------------------------------------------
def brute_clusters(rows, k, rounds, dims):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == dims
            and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)[:k]
    centroids = [v for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        for n, vs in groups.items():
            centroids[n] = [sum(x) // len(vs) for x in zip(*vs)]
    found = [(i, *nearest(v)) for i, v in kept]
    per = Counter()
    for _, d, n in found:
        per[n] += d
    return [(i, n, d, per[n], sum(per.values()), hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest()) for i, d, n in found]


def vectors(kind, n=300, dims=6):
    rng = np.random.default_rng(11)
    if kind == "blobs":
        x = rng.normal(size=(n, dims)) * 0.1 + rng.normal(size=(12, dims))[rng.integers(0, 12, n)]
    elif kind == "grid":      # many ties
        x = rng.integers(-2, 3, (n, dims)) / 4
    elif kind == "line":      # pivots that span little
        x = np.outer(rng.normal(size=n), rng.normal(size=dims)) * 3
    else:                     # all equal
        x = np.full((n, dims), -0.3)
    return [(i, [float(v) for v in row]) for i, row in enumerate(x)]


@pytest.mark.parametrize("kind", ["blobs", "grid", "line", "equal"])
def test_centroids_brute_force(spark, kind):
    rows = vectors(kind)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = op13_centroids.cluster(df, 10, 3, 4, 6)
    assert by_id([tuple(r) for r in got.collect()]) == by_id(brute_clusters(rows, 10, 3, 6))


def test_centroids_odd_rows(spark):
    good = vectors("blobs", 30)
    rows = good + [good[0], good[0], (None, good[1][1]), (None, good[2][1]), (100, None), (101, []), (102, [1.0] * 5), (103, [1.0] * 7),
                   (104, [None] + [1.0] * 5), (105, [float("nan")] * 6), (106, [float("inf")] + [0.0] * 5), (107, [1000.5, -1000.5] * 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select("*", *[F.lit(0).alias(c) for c in MORE_CLASH])
    assert by_id([tuple(r) for r in op13_centroids.cluster(df, 8, 3, 4, 6).collect()]) == by_id(brute_clusters(rows, 8, 3, 6))
    few = df.where("vec_id < 3")
    assert by_id([tuple(r) for r in op13_centroids.cluster(few, 8, 3, 4, 6).collect()]) == by_id(
        brute_clusters([r for r in rows if r[0] is not None and r[0] < 3], 8, 3, 6))
    empty = op13_centroids.cluster(df.limit(0), 8, 3, 4, 6)
    assert empty.count() == 0 and empty.columns == got_columns()


def got_columns():
    return ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_component_out_of_range_is_an_error(spark):
    df = spark.createDataFrame([(1, [1e9] * 6)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="2\\^27"):
        op13_centroids.cluster(df, 2, 1, 2, 6).collect()


def test_simplex_bounds_hold_and_filter():
    rng = np.random.default_rng(5)
    v = np.floor(256 * (rng.normal(size=(500, 64)) * 0.05 + rng.normal(size=(20, 64))[rng.integers(0, 20, 500)])).astype(np.int64)
    simplex = op13_centroids.Simplex.choose(v[:40], 16)
    apex = simplex.apexes(v)
    # the apex keeps the distances to the pivots
    corner = np.vstack([np.zeros(simplex.base.shape[1]), simplex.base])
    for k, p in enumerate(simplex.pivots):
        flat = ((apex[:, :-1] - corner[k]) ** 2).sum(axis=1) + apex[:, -1] ** 2
        assert np.allclose(flat, ((v - p) ** 2).sum(axis=1), rtol=1e-6, atol=1e-3)
    d = ((v[:, None, :] - v[None, :40, :]) ** 2).sum(axis=2)
    x, h = apex[:, :-1], apex[:, -1]
    flat = ((x[:, None, :] - x[None, :40, :]) ** 2).sum(axis=2)
    assert (flat + (h[:, None] - h[:40]) ** 2 <= d * (1 + 1e-9) + 1).all()
    assert (flat + (h[:, None] + h[:40]) ** 2 >= d * (1 - 1e-9) - 1).all()
    best, least, compared = op13_centroids.assign(v, apex, v[:40], apex[:40])
    assert best.tolist() == d.argmin(axis=1).tolist() and least.tolist() == d.min(axis=1).tolist()
    assert compared < 0.25 * d.size
