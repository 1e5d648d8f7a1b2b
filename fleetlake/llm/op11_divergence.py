"""Source divergence audit: two passes over the texts, the second through minimal perfect hashes.

Pass 1 counts in how many documents of its language each term occurs, exactly, and keeps the terms
of at least ``min_docs`` documents. The kept terms of a language are cut into shards of about
SHARD_TERMS by hash. A task builds the minimal perfect hash of a shard: hash buckets, largest first,
get a displacement that sends their terms to free places; a bucket of one term gets a free place
itself. A term's slot is its place plus the sizes of the shards before, so the slots of a language
are dense.

Pass 2 broadcasts the shards with their terms. A place found counts only if the term stored there is
the term asked for; occurrences are then added to the dense slots of their (lang, source) group.
One round broadcasts at most BROADCAST_BYTES; larger vocabularies are split over more rounds, each a
pass over the texts. Tasks emit non-zero slots, which Spark sums.

Shares. p = 1 + floor(10^9 (count + 5) / (N + 5 V)), in 64-bit integers without overflow for up to
2.8 * 10^14 occurrences in a language. Part ``pair``: blocks of slots times tiles of sources are
dense matrices of bounded size; every pair of sources meets once per block, absent terms included,
and the sums over blocks are added by Spark. Part ``term``: the terms that a group has more often
than its language, ranked with a limit before the shuffle.

Null text, lang and source count as ''. Repeated rows and null ids are documents of their own. A
group without kept terms gets its pairs with value 0 if the language keeps no term, else with the
shares of count 0. A language with one source has no pairs. An empty table gives an empty result.
Whole texts are read; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlake.llm.common import cut_lineage, map_arrow, record_batch, ship_package, slices, table

MIN_DOCS = 30
TOP_TERMS = 50
SHARD_TERMS = 16_384
BROADCAST_BYTES = 64 << 20
SLOTS = 4096        # slots of a block
TILE = 256          # sources of a tile, about
HELD = 300_000      # distinct terms a task counts before it emits them
DENSE = 4_000_000   # dense slots a task holds before it emits them
HASH_SEED = 42      # that of Spark's xxhash64

# every byte that is no part of a term becomes a blank, A-Z become a-z; bytes of characters beyond
# ASCII are parts of terms
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_MASK = (1 << 64) - 1
_STEP, _SPIN = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return text.translate(_FOLD).split()


# ---- minimal perfect hash of one shard -----------------------------------------------------------------
def _hash(keys, seed: int) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(k, seed) for k in keys), dtype=np.uint64, count=len(keys))


def _place(h: int, d: int, n: int) -> int:
    x = (h + d * _STEP) & _MASK
    x = ((x ^ (x >> 31)) * _SPIN) & _MASK
    return ((x ^ (x >> 29)) >> 8) % n


def build_hash(keys: list[bytes]) -> tuple[int, np.ndarray, list[bytes]]:
    """(seed, displacements, keys in place order). A displacement below 0 is the place -d - 1."""
    n, seed = len(keys), HASH_SEED + 1
    while len(set((h := _hash(keys, seed)).tolist())) < n:  # equal hashes can't be told apart by any displacement
        seed += 1
    buckets: list[list[int]] = [[] for _ in range(n)]
    for i, b in enumerate((h % np.uint64(n)).tolist()):
        buckets[b].append(i)
    hs, found, free = h.tolist(), [-1] * n, [True] * n
    moves = np.zeros(n, dtype=np.int32)
    order = sorted(range(n), key=lambda b: -len(buckets[b]))
    at = 0
    while at < n and len(buckets[order[at]]) > 1:
        b = order[at]
        d = 0
        while True:
            places = [_place(hs[i], d, n) for i in buckets[b]]
            if all(free[p] for p in places) and len(set(places)) == len(places):
                break
            d += 1
        moves[b] = d
        for i, p in zip(buckets[b], places):
            free[p], found[p] = False, i
        at += 1
    spare = iter([p for p in range(n) if free[p]])
    for b in order[at:]:
        if buckets[b]:
            p = next(spare)
            moves[b], found[p] = -p - 1, buckets[b][0]
    return seed, moves, [keys[i] for i in found]


def places(keys: list[bytes], seed: int, moves: np.ndarray, stored: list[bytes]) -> np.ndarray:
    """The place of each key, -1 where the key stored there is another one."""
    n = np.uint64(len(stored))
    h = _hash(keys, seed)
    d = moves[h % n].astype(np.int64)
    x = h + d.astype(np.uint64) * np.uint64(_STEP)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(_SPIN)
    at = np.where(d < 0, -d - 1, (((x ^ (x >> np.uint64(29))) >> np.uint64(8)) % n).astype(np.int64))
    same = np.fromiter((stored[p] == k for p, k in zip(at.tolist(), keys)), dtype=bool, count=len(keys))
    return np.where(same, at, -1)


def _build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    seed, moves, stored = build_hash(sorted(t.encode() for t in rows["term"]))
    return pd.DataFrame({"lang": [key[0]], "shard": [key[1]], "n": [len(stored)], "seed": [seed],
                         "moves": [moves.astype("<i4").tobytes()], "stored": [b" ".join(stored)]})


# ---- the passes ----------------------------------------------------------------------------------------
def _rows(docs: DataFrame) -> DataFrame:
    def text(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`"), F.lit(""))
    return docs.select(text("lang").alias("lang"), text("source").alias("source"), text("text").cast("binary").alias("text"))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("lang", pa.string()), ("term", pa.string()), ("docs", pa.int64())])
    held: dict[str, Counter] = {}

    def flush():
        for lang, seen in held.items():
            yield record_batch(schema, lang=[lang] * len(seen), term=list(seen), docs=list(seen.values()))
        held.clear()

    for b in slices(batches, "text"):
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
            held.setdefault(lang, Counter()).update(set(terms(text)))
        if sum(map(len, held.values())) > HELD:
            yield from flush()
    yield from flush()


def vocabulary(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term) of the terms in at least ``min_docs`` documents of their language, exact."""
    found = map_arrow(_rows(docs).select("lang", "text"), _frequencies, "lang string, term string, docs long")
    return found.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs).select("lang", "term")


def perfect_hashes(kept: DataFrame, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """(lang, shard, shards, base, n, seed, moves, stored): one row per shard; its slots start at ``base``."""
    sizes = kept.groupBy("lang").agg(F.ceil(F.count("*") / shard_terms).alias("shards"))
    dealt = kept.join(sizes, "lang").select("lang", "term", F.pmod(F.xxhash64("term"), F.col("shards")).alias("shard"))
    ship_package(kept.sparkSession)
    built = cut_lineage(dealt.groupBy("lang", "shard").applyInPandas(
        _build, "lang string, shard long, n long, seed long, moves binary, stored binary"))
    before = F.sum("n").over(Window.partitionBy("lang").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    bases = built.select("lang", "shard", F.coalesce(before, F.lit(0)).alias("base"))
    return cut_lineage(built.join(sizes, "lang").join(bases, ["lang", "shard"]))


def slot_terms(hashes: DataFrame) -> DataFrame:
    """(lang, slot, term) of all kept terms."""
    stored = F.posexplode(F.split(F.col("stored").cast("string"), " "))
    return hashes.select("lang", "base", stored.alias("place", "term")).select("lang", (F.col("base") + F.col("place")).alias("slot"), "term")


def _recount(shared):
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("slot", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs: dict[str, tuple[int, dict]] = {}
        for r in shared.value:
            langs.setdefault(r["lang"], (r["shards"], {}))[1][r["shard"]] = (
                r["base"], r["seed"], np.frombuffer(r["moves"], dtype="<i4"), bytes(r["stored"]).split(b" "))
        words: dict[tuple, Counter] = {}
        slots: dict[tuple, np.ndarray] = {}   # (lang, source, shard) -> dense counts
        held = 0

        def add():
            """Counted terms into the dense slots of their group; emits slots where they get too many."""
            nonlocal held
            for (lang, source), seen in words.items():
                shards, there = langs[lang]
                dealt: dict[int, list[bytes]] = {0: list(seen)}
                if shards > 1:
                    dealt = {}
                    for t in seen:
                        s = xxhash.xxh64_intdigest(t, HASH_SEED)
                        s -= (s >> 63) << 64  # Spark's hash is signed
                        dealt.setdefault(s % shards, []).append(t)
                for shard, keys in dealt.items():
                    if shard not in there:  # of another round
                        continue
                    base, seed, moves, stored = there[shard]
                    at = places(keys, seed, moves, stored)
                    n = np.fromiter(map(seen.__getitem__, keys), dtype=np.int64, count=len(keys))
                    dense = slots.get((lang, source, shard))
                    if dense is None:
                        if held > DENSE:
                            yield from flush()
                        dense = slots[lang, source, shard] = np.zeros(len(stored), dtype=np.int64)
                        held += len(stored)
                    dense[at[at >= 0]] += n[at >= 0]  # distinct terms have distinct places
            words.clear()

        def flush():
            nonlocal held
            for (lang, source, shard), dense in slots.items():
                at = np.flatnonzero(dense)
                if len(at):
                    yield record_batch(schema, lang=[lang] * len(at), source=[source] * len(at),
                                       slot=at + langs[lang][1][shard][0], n=dense[at])
            slots.clear()
            held = 0

        for b in slices(batches, "text"):
            for lang, source, text in zip(*(b.column(c).to_pylist() for c in ("lang", "source", "text"))):
                if lang in langs:
                    words.setdefault((lang, source), Counter()).update(terms(text))
            if sum(map(len, words.values())) > HELD:
                yield from add()
        yield from add()
        yield from flush()
    return run


def recount(docs: DataFrame, hashes: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(lang, source, slot, n): occurrences of the kept terms by group, only where there are any."""
    spark = docs.sparkSession
    size = F.length("moves") + F.length("stored") + F.octet_length("lang") + 64
    total = hashes.agg(F.coalesce(F.sum(size), F.lit(0)).alias("b")).first()["b"]
    # shards are dealt by hash, so a round is planned for half of what it may hold
    rounds = 1 if total <= broadcast_bytes else -(-2 * total // broadcast_bytes)
    rows = _rows(docs)
    found = None
    for r in range(rounds):
        mine = hashes.where(F.pmod(F.xxhash64("lang", "shard"), F.lit(rounds)) == r)
        if rounds > 1 and (mine.agg(F.sum(size).alias("b")).first()["b"] or 0) > broadcast_bytes:
            raise ValueError("one round of perfect hashes exceeds broadcast_bytes; raise it or lower shard_terms")
        shared = spark.sparkContext.broadcast([x.asDict() for x in mine.collect()])
        part = map_arrow(rows, _recount(shared), "lang string, source string, slot long, n long")
        found = part if found is None else found.unionByName(part)
    return cut_lineage(found.groupBy("lang", "source", "slot").agg(F.sum("n").alias("n")))


# ---- shares --------------------------------------------------------------------------------------------
def _share(n: Column, total: Column) -> Column:
    """1 + floor(10^9 n / total) for n <= total: 10^9 = 31250 * 32000, so that no product overflows."""
    scaled = n * F.lit(31250)
    return F.lit(1) + F.call_function("div", scaled, total) * 32000 + F.call_function("div", (scaled % total) * 32000, total)


def shares(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    scaled = n * 31250
    return 1 + scaled // total * 32000 + scaled % total * 32000 // total


def _pairs(key: tuple, counts: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
    """Sums of |p - q| over one block of slots, for the pairs of two tiles of sources."""
    lang, block, i, j = key
    groups = groups.sort_values(["tile", "source"])
    names, tile = groups["source"].tolist(), groups["tile"].to_numpy()
    total = groups["total"].to_numpy(dtype=np.int64)
    width = int(min(SLOTS, groups["v"].iloc[0] - block * SLOTS)) if len(groups) else 0
    out: list[tuple] = []
    if width > 0:
        row = {s: k for k, s in enumerate(names)}
        n = np.full((len(names), width), 5, dtype=np.int64)
        n[counts["source"].map(row).to_numpy(dtype=np.int64), counts["slot"].to_numpy(dtype=np.int64) - block * SLOTS] += counts["n"].to_numpy(dtype=np.int64)
        p = shares(n, total[:, None])
    left = np.flatnonzero(tile == i)
    for a in left:
        others = np.arange(a + 1, len(names)) if i == j else np.flatnonzero(tile == j)
        apart = np.abs(p[others] - p[a]).sum(axis=1) if width > 0 else np.zeros(len(others), dtype=np.int64)
        out.extend((lang, names[a], names[o], int(v)) for o, v in zip(others.tolist(), apart.tolist()))
    return pd.DataFrame(out, columns=["lang", "a", "b", "value"])


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS, shard_terms: int = SHARD_TERMS,
               broadcast_bytes: int = BROADCAST_BYTES, tile: int = TILE) -> DataFrame:
    """(lang, source, part, item, value, rank): see the module docstring."""
    hashes = perfect_hashes(cut_lineage(vocabulary(docs, min_docs)), shard_terms)
    counts = recount(docs, hashes, broadcast_bytes)
    sizes = hashes.groupBy("lang").agg(F.sum("n").alias("v"))
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("sum"))
    named = _rows(docs).groupBy("lang", "source").agg(F.count("*").alias("rows")).select("lang", "source")
    groups = cut_lineage(named.join(sums, ["lang", "source"], "left").join(sizes, "lang", "left").select(
        "lang", "source", F.coalesce("v", F.lit(0)).alias("v"), (F.coalesce("sum", F.lit(0)) + 5 * F.coalesce("v", F.lit(0))).alias("total")))
    by_lang = groups.groupBy("lang").agg(F.count("*").alias("sources"), (F.sum(F.col("total") - 5 * F.col("v")) + 5 * F.max("v")).alias("lang_total"))

    tiles = F.ceil(F.col("sources") / tile)
    placed = cut_lineage(groups.join(by_lang, "lang").withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("source"), F.col("tiles"))))

    def meeting(rows: DataFrame) -> DataFrame:
        """Each row for every pair of tiles that its own is part of."""
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
        return rows.withColumn("i", F.least("tile", "other")).withColumn("j", F.greatest("tile", "other"))

    last = F.greatest(F.ceil(F.col("v") / SLOTS) - 1, F.lit(0)).cast("long")
    sides = meeting(placed.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), last))))
    cells = meeting(counts.join(placed.select("lang", "source", "tile", "tiles"), ["lang", "source"]).withColumn(
        "block", F.floor(F.col("slot") / SLOTS).cast("long")))
    keys = ["lang", "block", "i", "j"]
    apart = cells.select(*keys, "source", "slot", "n").groupBy(*keys).cogroup(
        sides.select(*keys, "source", "tile", "v", "total").groupBy(*keys)).applyInPandas(_pairs, "lang string, a string, b string, value long")
    apart = cut_lineage(apart.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    pairs = apart.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(
        apart.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))

    everywhere = counts.groupBy("lang", "slot").agg(F.sum("n").alias("all"))
    own = counts.join(everywhere, ["lang", "slot"]).join(placed.select("lang", "source", "total", "lang_total"), ["lang", "source"])
    more = own.withColumn("value", _share(F.col("n") + 5, F.col("total")) - _share(F.col("all") + 5, F.col("lang_total"))).where("value > 0")
    marked = more.join(slot_terms(hashes), ["lang", "slot"]).select("lang", "source", F.col("term").alias("item"), "value")

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [rows.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit(part)) for part, rows in (("pair", pairs), ("term", marked))]
    return ranked[0].unionByName(ranked[1].where(F.col("rank") <= top)).select("lang", "source", "part", "item", "value", "rank")


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of the sources of each language over all documents."""
    return divergence(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(text, '') AS t, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents
), w AS (
  SELECT rid, lang, source, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT rid, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS raw FROM d)
), kept AS (
  SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT rid) >= 30
), g AS (
  SELECT DISTINCT lang, source FROM d
), seen AS (
  SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term
), cells AS (
  SELECT g.lang, g.source, kept.term, coalesce(seen.n, 0) AS n
  FROM g JOIN kept ON kept.lang = g.lang
  LEFT JOIN seen ON seen.lang = g.lang AND seen.source = g.source AND seen.term = kept.term
), own AS (
  SELECT lang, source, term, n,
    1 + 1000000000::HUGEINT * (n + 5) // (sum(n) OVER grp + 5 * count(*) OVER grp) AS p
  FROM cells WINDOW grp AS (PARTITION BY lang, source)
), whole AS (
  SELECT lang, term, 1 + 1000000000::HUGEINT * (n + 5) // (sum(n) OVER l + 5 * count(*) OVER l) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM cells GROUP BY lang, term) WINDOW l AS (PARTITION BY lang)
), apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM own a JOIN own b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
), pairs AS (
  SELECT x.lang, x.source, y.source AS item, coalesce(apart.value, 0) AS value
  FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN apart ON apart.lang = x.lang AND apart.source = x.source AND apart.item = y.source
), marked AS (
  SELECT lang, source, term AS item, p - q AS value FROM own JOIN whole USING (lang, term) WHERE n > 0 AND p > q
), ranked AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL
  SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS r FROM marked QUALIFY r <= 50
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked
"""
