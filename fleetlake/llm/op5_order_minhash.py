"""Near duplicates by Order MinHash, verified by banded alignment.

Sketch. A text is the sequence of its 5-word shingles (lower-case words), each labelled with its
occurrence number, so all labels of a text differ. Each of 32 components takes the two labels with
the smallest hash values and keeps them in text order; two components make a band. Texts that agree
in a band are candidates.

Candidates. Nodes are distinct texts. A bucket of up to SMALL nodes gives all its pairs. In larger
ones each node is compared with one hub, the node with most bucket mates among those of its buckets.
The rest is settled exactly over the large buckets that still hold several classes. Such a bucket has
a core C, the labels that more than half of a sample of its nodes have (any set would give right
results). Take the labels of a node outside C first, then those in C. Two similar nodes share a label
among the first n - l + 1 of each, n labels in all and l the least overlap a node of n labels can
have (prefix filter). If that label is outside C, both are listed under it in an index, where up to
SMALL nodes give all their pairs. Otherwise all their labels outside C are among those first ones and
none is shared, so that their overlap is |C| less the labels of C that either lacks. Nodes that
lack few are compared with the node that lacks least; those left in other classes, and the nodes of index
entries above SMALL, meet in rounds: up to HUBS nodes of a bucket outside its largest class with all nodes
of other classes whose overlap can be large enough (as above, or by the bits that differ in the marks of
both, a few words for a node), until none is left.
Nodes that are in the largest class of all their buckets list only the labels that others list.
Texts that differ from a common source in different places, or share only a passage, thus make no
pairs that grow with the square of their number.

Verification. Labels common to two texts that lie within the band of places an alignment of the
required similarity can reach; the longest increasing run of places among them is the aligned part
L; similarity is L / (n + m - L) and must be 0.8 or more. Classes are connected components of the
verified links, found by minimum labels with pointer jumping.

Texts with fewer than five words are one shingle. Texts without any word (null counts as empty) are
alike only if they are equal. Each row gets class_id, the smallest doc_id of its class (null if the
class has none), and class_size. Repeated rows and null ids are kept, each with its class. An empty
table gives an empty result. Texts are told apart by a 64-bit hash.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlake.llm.common import cut_lineage, fresh, in_files, map_arrow, record_batch, rename_inputs, slices, table

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 16
ROWS_PER_BAND = 2   # components of a band; each component has two labels
SMALL = 16          # nodes of a bucket that gives all its pairs
HUBS = 1024         # nodes of a larger bucket that meet the others in one round
SAMPLE = 32         # nodes that the core of a bucket is taken from
TOLD = 1_000_000    # labels of nodes outside the main classes that the other nodes are told at most
CACHE = 300_000     # words a task keeps the hashes of
MARKS = 16          # 64-bit words of the marks of a node
MEMBER = ["bucket", "n", "size", "lacks", "width", "marks"]

_WORD = re.compile(r"[^\W_]+")
_RNG = np.random.default_rng(20240229)
_FACTORS = _RNG.integers(0, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SEEDS = _RNG.integers(0, 1 << 63, BANDS * ROWS_PER_BAND, dtype=np.uint64)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _A
    return x ^ (x >> np.uint64(29))


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > CACHE:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word.encode())
        return h


_HASHES = WordHashes()


def labels(text: str | None) -> np.ndarray:
    """Occurrence-labelled shingle hashes of a text, in order; all different."""
    words = _WORD.findall((text or "").lower())
    if not words:
        return np.empty(0, dtype=np.uint64)
    w = np.fromiter(map(_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))
    n = max(1, len(w) - SHINGLE + 1)
    s = np.zeros(n, dtype=np.uint64)
    for k in range(min(SHINGLE, len(w))):
        s += w[k:k + n] * _FACTORS[k]
    s = _mix(s)
    order = np.argsort(s, kind="stable")
    r = s[order]
    first = np.concatenate(([True], r[1:] != r[:-1]))
    if not first.all():
        at = np.arange(n)
        number = at - np.maximum.accumulate(np.where(first, at, 0))
        s[order] = np.where(number > 0, _mix(r + number.astype(np.uint64) * _B), r)
    return s


def sketch(s: np.ndarray) -> np.ndarray:
    """One value per band."""
    m = len(_SEEDS)
    low, high = np.empty(m, dtype=np.int64), np.empty(m, dtype=np.int64)
    step = max(1, min(m, 4_000_000 // len(s)))
    for k in range(0, m, step):
        h = _mix(s[None, :] ^ _SEEDS[k:k + step, None])
        i = h.argmin(axis=1)
        j = i
        if len(s) > 1:
            h[np.arange(len(h)), i] = np.iinfo(np.uint64).max
            j = h.argmin(axis=1)
        low[k:k + step], high[k:k + step] = np.minimum(i, j), np.maximum(i, j)
    c = _mix(s[low] * _A + s[high] * _B + np.arange(m, dtype=np.uint64)).reshape(BANDS, ROWS_PER_BAND)
    v = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS_PER_BAND):
        v = _mix(v * _B + c[:, k])
    return v.view(np.int64)


def _least_common(total: int, similarity: float) -> int:
    """The smallest L with L / (total - L) >= similarity, by the same division as the result."""
    least = int(similarity * total / (1 + similarity))
    while least > 0 and (least - 1) / (total - least + 1) >= similarity:
        least -= 1
    while least < total and least / (total - least) < similarity:
        least += 1
    return least


def aligned(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> float:
    """Similarity of two label sequences by banded alignment; 0 if it cannot reach ``similarity``."""
    n, m = len(a), len(b)
    least = _least_common(n + m, similarity)
    if not n or not m or min(n, m) < least:
        return 0.0
    i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)[1:]
    if len(i) < least:
        return 0.0
    near = np.abs(i - j) <= n + m - 2 * least  # insertions and deletions at that similarity
    order = np.argsort(i[near])
    places = j[near][order]
    length = len(places) if (np.diff(places) > 0).all() else _longest_increasing(places.tolist())
    return length / (n + m - length)


def _longest_increasing(places: list[int]) -> int:
    tails: list[int] = []
    for p in places:
        at = bisect.bisect_left(tails, p)
        tails[at:at + 1] = [p]
    return len(tails)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("n", pa.int64()), ("size", pa.int64()), ("bands", pa.list_(pa.int64()))])
    for b in slices(batches, "text"):
        out = [labels(t) for t in b.column("text").to_pylist()]
        yield record_batch(schema, n=b.column("n"), size=[len(s) for s in out], bands=[sketch(s) if len(s) else [] for s in out])


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("n", pa.int64()), ("packed", pa.binary())])
    pack = zstandard.ZstdCompressor(level=1).compress
    for b in slices(batches, "text"):
        yield record_batch(schema, n=b.column("n"), packed=[pack(t.encode()) for t in b.column("text").to_pylist()])


def _unpack(packed: bytes | None) -> str:
    return "" if packed is None else zstandard.ZstdDecompressor().decompress(packed).decode()


def _verify(similarity: float):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, hub_labels = None, None
        for batch in slices(batches, "text_b"):
            left, right = [], []
            for a, b, x, y in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b"))):
                if a != hub:
                    hub, hub_labels = a, labels(_unpack(x))
                if aligned(hub_labels, labels(_unpack(y)), similarity) >= similarity:
                    left.append(a)
                    right.append(b)
            yield record_batch(schema, a=left, b=right)
    return run


def components(links: DataFrame) -> DataFrame:
    """(n, c): smallest node of the component of every node that has a link (a, b)."""
    rows = 2 * links.count()
    edges = cut_lineage(in_files(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), rows))
    state = cut_lineage(in_files(edges.groupBy(F.col("a").alias("n")).agg(F.least(F.min("b"), F.col("a")).alias("c")), rows))
    while True:
        seen = edges.select(fresh("b").alias("k"), F.col("a").alias("n")).join(
            state.select(F.struct(F.col("n").alias("b")).alias("k"), "c"), "k").groupBy("n").agg(F.min("c").alias("near"))
        step = state.join(seen, "n").select("n", "c", F.least("c", "near").alias("low"))
        jump = step.select(F.struct("low").alias("k"), "n", "c").join(
            state.select(F.struct(F.col("n").alias("low")).alias("k"), F.col("c").alias("up")), "k")
        new = cut_lineage(in_files(jump.select("n", F.col("c").alias("was"), F.least("k.low", "up").alias("c")), rows))
        moved = new.where("was <> c").limit(1).count()
        state = new.select("n", "c")
        if not moved:
            return state


def _joined(classes: DataFrame, links: DataFrame) -> DataFrame:
    """Classes (n, c) after more links (a, b): the components of the classes that the links join."""
    ends = links
    for x in "ab":
        found = classes.select(F.struct(F.col("n").alias(x)).alias("k"), F.col("c").alias("of"))
        ends = ends.withColumn("k", F.struct(x)).join(found, "k", "left").withColumn(x, F.coalesce("of", x)).drop("k", "of")
    joined = components(cut_lineage(in_files(ends, links.count())))
    moved = classes.withColumn("k", F.struct("c")).join(
        joined.select(F.struct(F.col("n").alias("c")).alias("k"), F.col("c").alias("low")), "k", "left").select("n", F.coalesce("low", "c").alias("c"))
    return cut_lineage(in_files(moved.unionByName(joined.join(classes.select("n"), "n", "left_anti")), classes.count()))


def _labelled(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Members (bucket, n, ...) with the class of each node so far."""
    found = classes.select(F.struct("n").alias("k"), "c")
    return members.withColumn("k", F.struct("n")).join(found, "k", "left").drop("k").withColumn("c", F.coalesce("c", "n"))


def _first_pairs(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of a first look, all nodes being classes of their own: everything in small buckets,
    one hub for every node of a large one. Also the members of the large buckets with their hub."""
    stats = members.groupBy("bucket").agg(F.count("*").alias("size"), F.max(F.struct("support", "n")).alias("hub"))
    stats = stats.select(fresh("bucket").alias("k"), "size", "hub")
    count = members.count()
    sized = cut_lineage(in_files(members.withColumn("k", fresh("bucket")).join(stats, "k").drop("k"), count))
    small = sized.where(F.col("size") <= SMALL).select("bucket", "n")
    inside = small.join(small.select("bucket", F.col("n").alias("b")), "bucket").where("n < b").select(F.col("n").alias("a"), "b")
    best = sized.where(F.col("size") > SMALL).groupBy("n").agg(
        F.max("hub").alias("hub"), F.first("support").alias("support"), F.collect_list("bucket").alias("buckets"))
    best = cut_lineage(in_files(best.select("n", F.col("hub.n").alias("hub"), "support", "buckets"), count))
    star = best.where("hub <> n").select(F.col("hub").alias("a"), F.col("n").alias("b"))
    return inside.unionByName(star).distinct(), best.select(F.explode("buckets").alias("bucket"), "n", "support", "hub")


def _least_overlap(n: int, similarity: float) -> int:
    """The smallest overlap that a text of n labels can have with a similar one."""
    least = int(similarity * n)
    while least > 0 and (least - 1) / n >= similarity:
        least -= 1
    while least < n and least / n < similarity:
        least += 1
    return least


def _cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("bucket", pa.int64()), ("core", pa.binary())])
    for b in slices(batches, rows=16):
        cores = []
        for texts in b.column("texts").to_pylist():
            found, counts = np.unique(np.concatenate([labels(_unpack(t)) for t in texts]), return_counts=True)
            cores.append(found[2 * counts > len(texts)].tobytes())
        yield record_batch(schema, bucket=b.column("bucket"), core=cores)


def _profiles(similarity: float, told: np.ndarray | None):
    """Per node its first labels outside the cores of its buckets (only those in ``told``, if given), and per
    bucket that it is near to the core of, what it lacks."""
    near = pa.struct([("bucket", pa.int64()), ("lacks", pa.list_(pa.int32())), ("width", pa.int32())])
    schema = pa.schema([("n", pa.int64()), ("labels", pa.list_(pa.int64())), ("near", pa.list_(near))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "packed", rows=64):
            listed, close = [], []
            for packed, places in zip(b.column("packed").to_pylist(), b.column("places").to_pylist()):
                own = np.sort(labels(_unpack(packed)))
                least = _least_overlap(len(own), similarity)
                first = len(own) - least + 1
                mine, rows = [], []
                for place in places:
                    core = np.frombuffer(place["core"], dtype=np.uint64)
                    outside = np.setdiff1d(own, core, assume_unique=True)
                    mine.append(outside[:first])
                    lacks = np.flatnonzero(~np.isin(core, own, assume_unique=True))
                    if len(outside) < first and len(core) - len(lacks) >= least:
                        rows.append({"bucket": place["bucket"], "lacks": lacks.tolist(), "width": len(core)})
                mine = np.unique(np.concatenate(mine)).view(np.int64)
                if told is not None:  # sorted, and far longer than what a node lists
                    at = np.searchsorted(told, mine)
                    mine = mine[np.searchsorted(told, mine, side="right") > at]
                listed.append(mine)
                close.append(rows)
            yield record_batch(schema, n=b.column("n"), labels=listed, near=close)
    return run


def marks(s: np.ndarray) -> np.ndarray:
    """A bit for each of 64 MARKS groups of labels, set if an odd number of the labels ``s`` is in it. Two texts
    have at least as many labels that the other lacks as bits that differ."""
    counts = np.bincount((_mix(s) % np.uint64(64 * MARKS)).astype(np.int64), minlength=64 * MARKS)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("n", pa.int64()), ("marks", pa.list_(pa.int64()))])
    for b in slices(batches, "packed", rows=64):
        yield record_batch(schema, n=b.column("n"), marks=[marks(labels(_unpack(x))) for x in b.column("packed").to_pylist()])


def _reaches(common, total, similarity: float):
    """Whether ``common`` labels of ``total`` in two texts can make them similar; a little less is let
    through, so that rounding loses no tie (the verification decides). ``common`` is evaluated once."""
    return common >= F.ceil(F.lit(similarity / (1 + similarity)) * total - 1e-6)


def _main_classes(members: DataFrame) -> DataFrame:
    """(k, main): the largest class of every bucket that holds several."""
    counts = members.groupBy("bucket", "c").agg(F.count("*").alias("size"))
    return counts.groupBy("bucket").agg(F.max(F.struct("size", "c")).alias("main"), F.count("*").alias("classes")).where(
        "classes > 1").select(fresh("bucket").alias("k"), F.col("main.c").alias("main"))


def _next_pairs(members: DataFrame, count: int, similarity: float) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) between classes, and the members that stay, of ``count`` members. In each bucket up to HUBS nodes outside
    its largest class meet all nodes of other classes for which the bound holds, and leave it; a bucket
    whose nodes are of one class is finished. The overlap is bounded by what both lack of the core, or,
    where the members bring ``marks``, by the bits that differ."""
    open_ = cut_lineage(in_files(members.withColumn("k", fresh("bucket")).join(_main_classes(members), "k").drop("k"), count))
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy(F.size("lacks"), "n"))
    hubs = cut_lineage(in_files(open_.where("c <> main").withColumn("rank", rank).where(F.col("rank") <= HUBS).select(
        fresh("bucket").alias("k"), F.col("n").alias("a"), F.col("c").alias("ca"), F.col("size").alias("sa"), F.col("lacks").alias("la"),
        F.col("marks").alias("ma")), count))
    rows = open_.withColumn("k", fresh("bucket"))
    total = F.col("size") + F.col("sa")
    differ = sum((F.bit_count(F.col("marks")[i].bitwiseXOR(F.col("ma")[i])) for i in range(1, MARKS)), F.bit_count(F.col("marks")[0].bitwiseXOR(F.col("ma")[0])))
    common = F.when(F.col("width").isNull(), (total - differ) / 2).otherwise(F.col("width") - F.size(F.array_union("lacks", "la")))
    bound = _reaches(F.least("size", "sa"), total, similarity) & _reaches(common, total, similarity)
    pairs = rows.join(hubs, "k").where((F.col("c") != F.col("ca")) & bound).select(F.least("a", "n").alias("a"), F.greatest("a", "n").alias("b")).distinct()
    gone = hubs.select(F.struct(F.col("k.bucket").alias("bucket"), F.col("a").alias("n")).alias("k"))
    left = open_.withColumn("k", fresh("bucket", "n")).join(gone, "k", "left_anti").select(*MEMBER)
    return pairs, left


def classes_of(texts: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """Classes (n, c) of the texts of rows (n, text), only of nodes with a link, and the links (a, b).
    Equal texts have equal ``n``."""
    # one map pass for the sketches, then slim rows only
    sketches = cut_lineage(map_arrow(texts.select("n", "text"), _sketches, "n long, size long, bands array<long>").groupBy("n").agg(
        F.first("size").alias("size"), F.first("bands").alias("bands")))
    flat = sketches.select("n", F.explode("bands").alias("bucket"))
    shared = flat.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1").select(fresh("bucket").alias("k"), "size")
    mates = cut_lineage(flat.withColumn("k", fresh("bucket")).join(shared, "k").drop("k"))
    support = mates.groupBy("n").agg(F.sum("size").alias("support"))
    members = cut_lineage(in_files(mates.join(support, "n").select("bucket", "n", "support"), mates.count()))
    # one shuffle of texts: partially aggregated, then only the nodes with a bucket mate stay, compressed
    whole = texts.groupBy("n").agg(F.first("text").alias("text")).join(support.select("n"), "n", "left_semi")
    kept = cut_lineage(map_arrow(whole.select("n", "text"), _compress, "n long, packed binary"))

    def verified(pairs: DataFrame) -> DataFrame:
        left = kept.select(F.struct(F.col("n").alias("a")).alias("ka"), F.col("packed").alias("text_a"))
        right = kept.select(F.struct(F.col("n").alias("b")).alias("kb"), F.col("packed").alias("text_b"))
        both = pairs.select(fresh("a").alias("ka"), fresh("b").alias("kb")).join(right, "kb").join(left, "ka")
        return cut_lineage(map_arrow(both.select("ka.a", "kb.b", "text_a", "text_b"), _verify(similarity), "a long, b long"))

    pairs, large = _first_pairs(members)
    links = verified(pairs)
    classes = components(links)

    # the exact rest, over the large buckets that still hold several classes
    placed_ = cut_lineage(in_files(_labelled(large, classes).join(sketches.select("n", "size"), "n"), large.count()))
    rows = cut_lineage(in_files(placed_.withColumn("k", fresh("bucket")).join(_main_classes(placed_), "k").drop("k"), placed_.count()))
    count = rows.count()
    if not count:
        return classes, links
    chosen = rows.withColumn("rank", F.row_number().over(Window.partitionBy("bucket").orderBy(F.xxhash64("n"), "n"))).where(F.col("rank") <= SAMPLE)
    packs = chosen.select("bucket", fresh("n").alias("k")).join(kept.select(fresh("n").alias("k"), "packed"), "k")
    cores = cut_lineage(map_arrow(packs.groupBy("bucket").agg(F.collect_list("packed").alias("texts")), _cores, "bucket long, core binary"))
    sites = rows.withColumn("k", fresh("bucket")).join(cores.select(fresh("bucket").alias("k"), "core"), "k").groupBy("n").agg(
        F.collect_list(F.struct("bucket", "core")).alias("places"), F.max(F.col("c") != F.col("main")).alias("open"))
    sites = cut_lineage(sites.join(kept, "n").select("n", "packed", "places", "open"))
    ddl = "n long, labels array<long>, near array<struct<bucket: long, lacks: array<int>, width: int>>"
    apart = cut_lineage(map_arrow(sites.where("open").select("n", "packed", "places"), _profiles(similarity, None), ddl))
    index = cut_lineage(apart.select("n", F.explode("labels").alias("label")))  # each label becomes a row once, then rows are read
    known = index.select("label").distinct().limit(TOLD + 1).toArrow().column("label").to_numpy()
    within = cut_lineage(map_arrow(sites.where(~F.col("open")).select("n", "packed", "places"),
                                   _profiles(similarity, np.sort(known) if len(known) <= TOLD else None), ddl))
    profiles = apart.unionByName(within)

    index = index.unionByName(cut_lineage(within.select("n", F.explode("labels").alias("label"))))
    held = index.groupBy("label").agg(F.count("*").alias("holders")).where("holders > 1").select(fresh("label").alias("k"), "holders")
    index = cut_lineage(in_files(index.withColumn("k", fresh("label")).join(held, "k").select("n", "label", "holders"), index.count()))
    nodes = rows.groupBy("n").agg(F.first("c").alias("c"), F.first("size").alias("size"))
    rare = cut_lineage(in_files(index.where(F.col("holders") <= SMALL).select("n", "label").join(nodes, "n"), index.count()))
    pairs = rare.join(rare.select("label", F.col("n").alias("b"), F.col("c").alias("cb"), F.col("size").alias("sb")), "label").where(
        "n < b AND c <> cb").where(_reaches(F.least("size", "sb"), F.col("size") + F.col("sb"), similarity)).select(F.col("n").alias("a"), "b")
    near = cut_lineage(in_files(profiles.select("n", F.inline("near")).join(nodes, "n"), count))
    least = near.groupBy("bucket").agg(F.min(F.struct(F.size("lacks").alias("lack"), F.col("n").alias("a"), F.col("c").alias("ca"))).alias("least"))
    star = near.withColumn("k", fresh("bucket")).join(least.select(fresh("bucket").alias("k"), "least"), "k").where("c <> least.ca").select(
        F.least("n", "least.a").alias("a"), F.greatest("n", "least.a").alias("b"))
    pairs = cut_lineage(pairs.unionByName(star).distinct())
    crowded = index.where(F.col("holders") > SMALL).select(F.col("label").alias("bucket"), "n")
    texts_ = kept.join(crowded.select("n").distinct(), "n", "left_semi")
    crowded = crowded.join(map_arrow(texts_.select("n", "packed"), _marked, "n long, marks array<long>"), "n").join(nodes, "n").select(
        "bucket", "n", "size", F.array().cast("array<int>").alias("lacks"), F.lit(None).cast("int").alias("width"), "marks")
    members = cut_lineage(near.withColumn("marks", F.lit(None).cast("array<long>")).select(*MEMBER).unionByName(crowded.select(*MEMBER)))
    done = None
    while True:
        found = verified(pairs)
        if found.limit(1).count():
            links = cut_lineage(in_files(links.unionByName(found), links.count()))
            classes = _joined(classes, found)
        done = pairs if done is None else cut_lineage(in_files(done.unionByName(pairs), done.count()))
        count = members.count()
        pairs, members = _next_pairs(_labelled(members, classes), count, similarity)
        pairs, members = cut_lineage(pairs.join(done, ["a", "b"], "left_anti")), cut_lineage(in_files(members, count))
        if not members.limit(1).count() and not pairs.limit(1).count():
            return classes, links


def _nodes(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return rename_inputs(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("n"),
                                                        text.alias("text"))


def placed(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, n, c) of every row: ``n`` is xxhash64 of the text, ``c`` the smallest ``n`` of its class."""
    rows = _nodes(docs)
    classes, _ = classes_of(rows.select("n", "text"), similarity)
    return cut_lineage(rows.select("doc_id", "n").withColumn("k", F.struct("n")).join(
        classes.select(F.struct("n").alias("k"), "c"), "k", "left").select("doc_id", "n", F.coalesce("c", "n").alias("c")))


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id, class_size) of every row."""
    found = placed(docs, similarity)
    heads = found.groupBy("c").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    return found.withColumn("k", F.struct("c")).join(heads.select(F.struct("c").alias("k"), "class_id", "class_size"), "k").select(
        "doc_id", "class_id", "class_size")


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Rows of ``docs`` that stay: of every class the one with the smallest doc_id (ids before nulls,
    then the smaller text hash); of repeated rows one."""
    best = placed(docs, similarity).groupBy("c").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "n")).alias("head"))
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"),
                   F.xxhash64(F.coalesce("text", F.lit(""))).alias("n"))
    stay = best.select(F.struct("head.none", F.coalesce("head.doc_id", F.lit(0)).alias("doc_id"), "head.n").alias("k"))
    rows = docs.select(key.alias("k"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    kept = rows.join(stay, "k", "left_semi").dropDuplicates(["k"])
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))
