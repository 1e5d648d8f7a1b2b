"""Best-fit packing of tokenised documents into fixed-length sequences by the sum-of-squares rule.

Every text becomes its token ids and one end id; only documents longer than a sequence are cut,
into whole-sequence pieces after a first piece that takes the remainder. Pieces (ids stay out: a
piece is its place, length and checksum) are dealt evenly into groups of bounded size, and each
group is packed by one task, longest piece first: a piece goes to the open bin, or a new one, for
which the sum over residual gaps of (number of open bins with that gap) squared becomes smallest;
ties go to the tightest bin. The pieces of the few bins left with much room are placed once more, by
best fit, if that saves bins. Groups are dealt round robin, so neither a hot source nor
repeated rows load one task, and a group costs at most a few half-empty sequences.

A null text is an empty text: one piece with just the end id. Null ids and repeated rows are kept,
each row with its own pieces. An empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm.common import cut_lineage, map_arrow, record_batch, rename_inputs, slices, table
from fleetlake.llm.tokens import codec, default_vocabulary

SEQUENCE_TOKENS = 2048
END_ID = 0
GROUP_PIECES = 50_000  # pieces packed by one task

_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                     ("ids_crc32", pa.int64())])
_PACKED = pa.schema([*_PIECES, ("sequence_id", pa.int64()), ("offset", pa.int64())])


def piece_lengths(n: int, size: int) -> list[int]:
    """Lengths of the pieces of a document of ``n`` ids: the remainder first, then whole sequences."""
    if n <= size:
        return [n]
    return [n % size] * (n % size > 0) + [size] * (n // size)


def pieces(docs: DataFrame, vocabulary: str | None = None, size: int = SEQUENCE_TOKENS, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every row of ``docs``."""
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in slices(batches, "text"):
            rows, out = [], {n: [] for n in _PIECES.names[1:]}
            for row, text in enumerate(b.column("text").to_pylist()):
                ids = np.append(c.encode(text or ""), np.uint32(end_id)).astype("<u4")
                start = 0
                for k, n in enumerate(piece_lengths(len(ids), size)):
                    rows.append(row)
                    for name, value in zip(out, (k, start, n, zlib.crc32(ids[start:start + n]))):
                        out[name].append(value)
                    start += n
            yield record_batch(_PIECES, doc_id=b.column("doc_id").take(pa.array(rows, pa.int32())), **out)

    src = rename_inputs(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_arrow(src, run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def sum_of_squares(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each item, placed in the given order. Open bins are counted by residual gap."""
    counts = np.zeros(capacity + 1, dtype=np.int64)  # counts[g]: open bins with gap g; full bins are closed
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    out = np.empty(len(sizes), dtype=np.int64)
    new, never = 0, np.iinfo(np.int64).max
    for i, s in enumerate(sizes.tolist()):
        if s >= capacity:
            out[i], new = new, new + 1
            continue
        # sum of squares after taking a bin of gap g away and adding one of gap g - s, less the sum before
        change = 2 * (counts[:capacity - s] - counts[s:capacity]) + 2
        change[0] -= 1 + 2 * counts[0]  # gap s: the bin is then full and no longer counted
        change[counts[s:capacity] == 0] = never
        k = int(change.argmin())
        gap = s + k
        if change[k] >= 2 * counts[capacity - s] + 1:  # no better than a new bin
            gap = capacity
        if gap == capacity:
            bin_, new = new, new + 1
        else:
            bin_ = stacks[gap].pop()
            counts[gap] -= 1
        out[i] = bin_
        if gap > s:
            counts[gap - s] += 1
            stacks[gap - s].append(bin_)
    return out


def best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each item, placed in the given order into the tightest bin with room."""
    gaps: list[tuple[int, int]] = []  # (gap, bin), sorted
    out = np.empty(len(sizes), dtype=np.int64)
    new = 0
    for i, s in enumerate(sizes.tolist()):
        at = bisect.bisect_left(gaps, (s, -1))
        if at < len(gaps):
            gap, bin_ = gaps.pop(at)
        else:
            gap, bin_, new = capacity, new, new + 1
        out[i] = bin_
        if gap > s:
            bisect.insort(gaps, (gap - s, bin_))
    return out


def pack(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece: the rule over all pieces, longest first; the pieces of bins that
    it leaves with more than 1/256 of room are placed once more, by best fit, where that saves bins."""
    order = np.argsort(-lengths, kind="stable")
    bins = np.empty(len(lengths), dtype=np.int64)
    bins[order] = sum_of_squares(lengths[order], capacity)
    fill = np.bincount(bins, weights=lengths)
    loose = capacity - fill > capacity / 256
    again = order[loose[bins[order]]]
    refit = best_fit(lengths[again], capacity)
    if len(again) and refit.max() + 1 < loose.sum():
        bins[again] = len(fill) + refit
    bins = np.unique(bins, return_inverse=True)[1]
    by_bin = np.lexsort((np.arange(len(bins)), bins))
    ends = np.cumsum(lengths[by_bin])
    first = np.concatenate(([True], np.diff(bins[by_bin]) > 0))[:len(bins)]
    offsets = np.empty(len(bins), dtype=np.int64)
    base = (ends - lengths[by_bin])
    offsets[by_bin] = base - np.maximum.accumulate(np.where(first, base, 0))
    return bins, offsets


def pack_pieces(parts: DataFrame, size: int = SEQUENCE_TOKENS, group: int = GROUP_PIECES) -> DataFrame:
    """Adds (sequence_id, offset) to a table of pieces."""
    parts = cut_lineage(parts)
    groups = max(1, -(-parts.count() // group))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        t = pa.Table.from_batches(held).combine_chunks()
        if not t.num_rows:
            return
        bins, offsets = pack(t.column("length").to_numpy(), size)
        base = TaskContext.get().partitionId() << 32
        t = t.append_column("sequence_id", pa.array(bins + base)).append_column("offset", pa.array(offsets))
        yield from t.cast(_PACKED).to_batches(max_chunksize=10_000)

    return map_arrow(parts.repartition(groups), run, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                                      "sequence_id long, offset long")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return pack_pieces(pieces(table(spark, sf_dir, "documents")))
