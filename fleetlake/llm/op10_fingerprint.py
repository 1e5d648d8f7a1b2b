"""Document fingerprints: a Merkle tree over sentences, paragraphs and sections.

A text splits into paragraphs (lines), these into sentence-like pieces of at most LEAF bytes, the
leaves. A paragraph is the hash of its leaves, a section the hash of consecutive paragraphs (it ends
where a paragraph's own hash says so, so an insertion moves no later border), the root the hash of
all sections. Equal roots mean equal texts; ``differences`` descends only into branches whose hashes
differ and returns the edits as ranges of paragraphs on both sides (column ``edits`` of the query). A fingerprint is the root and, after a colon, 32 bits of
every leaf in text order (base64), so two fingerprints alone give a likeness: twice the leaves they
share over all leaves of both, 1 for equal roots only.

The query pairs every document with the next one in ascending doc_id (the first after the last).
Rows are dealt into ranges of doc_id whose first ids are known; the first row of a range is also
sent to the range before it, so each task streams its sorted rows and holds two texts at a time.

A null text is an empty text. A row with a null id has no place in the order and counts as its own
next document, as does the only row of a table. Repeated ids are ordered by their text. An empty
table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm.common import map_arrow, record_batch, rename_inputs, table, text_bytes
from fleetlake.llm.op3_license import longest_increasing

LEAF = 48             # bytes of a leaf without a sentence end
SECTION = 4           # a section has this many paragraphs on average
RANGE_ROWS = 5_000    # documents of one range of ids
MAX_RANGES = 50_000   # beyond 250 million rows ranges get longer; their rows are streamed

_PIECE = re.compile(rb"[^.!?]{1,%d}[.!?]*[\x20\x09-\x0D]*|[.!?]+[\x20\x09-\x0D]*" % LEAF)


class Tree:
    """The Merkle tree of one text: ``sections`` -> ``paragraphs`` -> leaf digests."""

    def __init__(self, body: bytes):
        digest = xxhash.xxh3_128_digest
        self.leaves: list[bytes] = []
        self.paragraphs: list[tuple[bytes, int]] = []   # digest, leaves up to its end
        self.sections: list[tuple[bytes, int]] = []     # digest, paragraphs up to its end
        open_: list[bytes] = []
        for line in body.split(b"\n") if body else ():
            mine = [digest(x) for x in _PIECE.findall(line)]
            self.leaves += mine
            d = digest(b"p" + b"".join(mine))
            self.paragraphs.append((d, len(self.leaves)))
            open_.append(d)
            if d[0] % SECTION == 0:
                self.sections.append((digest(b"s" + b"".join(open_)), len(self.paragraphs)))
                open_ = []
        if open_:
            self.sections.append((digest(b"s" + b"".join(open_)), len(self.paragraphs)))
        self.root = hashlib.sha256(b"r" + b"".join(d for d, _ in self.sections)).hexdigest()[:32]

    def fingerprint(self) -> str:
        return f"{self.root}:{base64.b64encode(b''.join(d[:4] for d in self.leaves)).decode()}"


def likeness(a: str, b: str) -> float:
    """Likeness of two fingerprints, 0 to 1."""
    (root, _, mine), (other, _, theirs) = a.partition(":"), b.partition(":")
    if root == other:
        return 1.0
    x, y = (np.frombuffer(base64.b64decode(t), dtype="<u4").tolist() for t in (mine, theirs))
    return min(0.999999, _shared(x, y))


def _shared(x: list, y: list) -> float:
    if not x or not y:
        return 0.0
    if len(x) > len(y):
        x, y = y, x
    counts = Counter(x)
    both = sum(min(n, counts[k]) for k, n in Counter(z for z in y if z in counts).items())
    return 2 * both / (len(x) + len(y))


def _blocks(x: list[bytes], y: list[bytes]) -> list[tuple[int, int, int, int]]:
    """Where two sequences differ: (from, to, from, to) of every block of ``x`` that stands for one of ``y``.
    Equal ends are taken off, digests that occur once in both anchor the rest (their longest increasing
    run), and each gap between anchors is treated alike; a gap without anchors is a block."""
    out, open_ = [], [(0, len(x), 0, len(y))]
    while open_:
        a, b, c, d = open_.pop()
        while a < b and c < d and x[a] == y[c]:
            a, c = a + 1, c + 1
        while a < b and c < d and x[b - 1] == y[d - 1]:
            b, d = b - 1, d - 1
        if a == b and c == d:
            continue
        once = {k for k, n in Counter(x[a:b]).items() if n == 1} & {k for k, n in Counter(y[c:d]).items() if n == 1}
        at = {k: j for j, k in enumerate(y[c:d], c) if k in once}
        pairs = longest_increasing([(i, at[k]) for i, k in enumerate(x[a:b], a) if k in once])
        if not pairs:
            out.append((a, b, c, d))
            continue
        for (i, j), (i2, j2) in zip([(a - 1, c - 1), *pairs], [*pairs, (b, d)]):
            open_.append((i + 1, i2, j + 1, j2))
    return sorted(out)


def differences(a: Tree, b: Tree) -> list[tuple[int, int, int, int]]:
    """The edits between two texts as (from, to, from, to): paragraphs of ``a`` that paragraphs of ``b``
    replace; one side is empty where paragraphs were added or removed. Roots are compared first, then
    sections, and only paragraphs of sections that differ."""
    if a.root == b.root:
        return []
    ends_a, ends_b = [0, *[e for _, e in a.sections]], [0, *[e for _, e in b.sections]]
    out = []
    for i, j, k, m in _blocks([d for d, _ in a.sections], [d for d, _ in b.sections]):
        x, y = a.paragraphs[ends_a[i]:ends_a[j]], b.paragraphs[ends_b[k]:ends_b[m]]
        out += [(ends_a[i] + p, ends_a[i] + q, ends_b[k] + r, ends_b[k] + t) for p, q, r, t in _blocks([d for d, _ in x], [d for d, _ in y])]
    return out


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the next document."""
    n = len(text) // 2
    return text[:len(text) - n] + following[:n]


# an edit: paragraphs of the text that stand for paragraphs of the edited text
_EDIT = ("from", "to", "edited_from", "edited_to")
_RESULT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                     ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()),
                     ("near_next", pa.float64()), ("edits", pa.list_(pa.struct([(n, pa.int32()) for n in _EDIT])))])


def _ring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of one range, the first row of the next range last (``ghost``)."""
    rows = []

    def finish(doc_id, body, tree, next_body, next_tree):
        text = body.decode("utf-8", "replace")
        half = len(text) // 2
        new = edited(text, next_body[:4 * half].decode("utf-8", "ignore")).encode()
        new_tree = Tree(new)
        print_, new_print = tree.fingerprint(), new_tree.fingerprint()
        rows.append((doc_id, len(text), hashlib.sha256(new).hexdigest(), print_, new_print, likeness(print_, new_print),
                     likeness(print_, next_tree.fingerprint()), [dict(zip(_EDIT, e)) for e in differences(tree, new_tree)]))

    def batch():
        out = record_batch(_RESULT, **{n: [r[i] for r in rows] for i, n in enumerate(_RESULT.names)})
        rows.clear()
        return out

    held = None
    for b in batches:
        for doc_id, ghost, body in zip(b.column("doc_id").to_pylist(), b.column("ghost").to_pylist(), b.column("body")):
            if ghost and held is None:
                continue
            body = body.as_py()
            tree = Tree(body)
            if doc_id is None:
                finish(None, body, tree, body, tree)
            else:
                if held is not None:
                    finish(*held, body, tree)
                held = None if ghost else (doc_id, body, tree)
            if len(rows) >= 256:
                yield batch()
    if rows:
        yield batch()


def fingerprint_pairs(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Fingerprints of every text and of its edited text, their likenesses, and where the two trees differ."""
    src = rename_inputs(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("body"))
    ids = src.select("doc_id").where("doc_id IS NOT NULL")
    ranges = min(MAX_RANGES, -(-ids.count() // range_rows)) or 1
    firsts = np.array(sorted(r[0] for r in ids.repartitionByRange(ranges, "doc_id").groupBy(F.spark_partition_id()).agg(
        F.min("doc_id")).select("min(doc_id)").collect()), dtype=np.int64)
    ranges = max(1, len(firsts))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            known = np.asarray(b.column("doc_id").is_valid())
            doc_id = np.asarray(b.column("doc_id").fill_null(0))
            at = np.searchsorted(firsts, doc_id, side="right") - 1
            at[~known] = np.arange((~known).sum()) % ranges
            out = b.append_column("range", pa.array(at.astype(np.int32))).append_column("ghost", pa.array(np.zeros(len(at), bool)))
            yield out
            again = np.flatnonzero(known & (firsts[at.clip(min=0)] == doc_id)) if len(firsts) else np.empty(0, np.int64)
            if len(again):
                g = b.take(pa.array(again))
                yield g.append_column("range", pa.array(((at[again] - 1) % ranges).astype(np.int32))).append_column(
                    "ghost", pa.array(np.ones(len(again), bool)))

    dealt = map_arrow(src, deal, "doc_id long, body binary, range int, ghost boolean")
    ranged = dealt.repartitionById(ranges, F.col("range")).sortWithinPartitions("ghost", "doc_id", "body")
    return map_arrow(ranged.select("doc_id", "ghost", "body"), _ring,
                     "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                     "near_edited double, near_next double, "
                     "edits array<struct<`from`: int, `to`: int, edited_from: int, edited_to: int>>")


def op10_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their edited texts."""
    return fingerprint_pairs(table(spark, sf_dir, "documents"))
