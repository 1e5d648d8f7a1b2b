"""Line dedup: range-partitioned line hashes, streamed runs, compressed per-document bitmaps.

Every line of every text is reduced to a 128-bit hash of its key (ASCII white space stripped at
both ends, A-Z lower-cased). The hashes are range-partitioned and sorted by (hash, document,
position); each task streams its sorted rows, counts the documents of every run and emits the
positions to drop. The range also covers document and position, so a line that a third of all
documents hold is spread over many tasks; runs that touch a task's edge are settled in a second,
tiny step. Texts never take part in that shuffle: the result is a bitmap per document
(``zlib(packbits(keep))`` over its line numbers, all later lines kept).

A document is one ``doc_id``; rows with a null id are documents of their own text. Repeated rows
count once and get the same decision. A null or empty text is one empty line; keys shorter than
``min_chars`` code points are never dropped. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm.common import cut_lineage, map_arrow, record_batch, rename_inputs, same, slices, table, text_bytes

MIN_DOCS = 10
MIN_CHARS = 1

_LINES = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc_id", pa.int64()), ("th", pa.int64()),
                    ("pos", pa.int64())])
_RUNS = pa.schema([("edge", pa.bool_()), ("many", pa.bool_()), *[(f.name, f.type) for f in _LINES]])
_LINES_DDL = "h1 long, h2 long, doc_id long, th long, pos long"
_RUNS_DDL = f"edge boolean, many boolean, {_LINES_DDL}"


def _line_hashes(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "body"):
            digests, rows, places = [], [], []
            for row, body in enumerate(b.column("body").to_pylist()):
                for pos, line in enumerate(body.split(b"\n")):
                    key = line.strip().lower()  # bytes: strips and lower-cases ASCII only
                    if len(key) >= min_chars and (min_chars <= 1 or len(key.decode("utf-8", "replace")) >= min_chars):
                        digests.append(xxhash.xxh3_128_digest(key))
                        rows.append(row)
                        places.append(pos)
            if digests:
                h = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
                take = pa.array(rows, pa.int32())
                yield record_batch(_LINES, h1=h[:, 0], h2=h[:, 1], doc_id=b.column("doc_id").take(take),
                                   th=b.column("th").take(take), pos=places)
    return run


def _stream_runs(min_docs: int, keep_first: bool):
    """Rows sorted by (hash, document, position). Emits dropped positions; of the first and the last
    run of the task, which may go on in a neighbour, what the neighbours need to know."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, held = True, None
        for b in batches:
            t = pa.Table.from_batches([b] if held is None else [held, b])
            t = t.combine_chunks().to_batches()
            if not t:
                continue
            t = t[0]
            cols = _columns(t)
            starts = _starts(cols)
            last = int(starts[-1])
            out = _settle(cols, starts[:-1], last, min_docs, keep_first, first)
            if len(starts) > 1:
                first = False
                if out is not None:
                    yield out
            held = t.slice(last)
            if held.num_rows <= 4096:
                continue
            # a long run: one row of each of its first documents stays, the others go out now; they are
            # dropped if the run has enough documents, and else it is settled as an edge
            cols = _columns(held)
            heads = np.concatenate(([0], np.flatnonzero(_differs(cols, held.num_rows)) + 1))
            stay = heads[:max(min_docs, 1)]
            rest = np.ones(held.num_rows, bool)
            rest[stay] = False
            many = len(heads) >= min_docs
            yield _rows(cols, not many, False, np.flatnonzero(rest))
            first |= not many
            held = held.take(pa.array(stay))
        if held is not None and held.num_rows:
            cols = _columns(held)
            yield _edge(cols, min_docs)
    return run


def _columns(b: pa.RecordBatch) -> dict[str, np.ndarray]:
    out = {n: np.asarray(b.column(n)) for n in ("h1", "h2", "th", "pos")}
    out["null"] = np.asarray(b.column("doc_id").is_null())
    out["doc_id"] = np.asarray(b.column("doc_id").fill_null(0))
    return out


def _starts(c: dict[str, np.ndarray]) -> np.ndarray:
    new = (c["h1"][1:] != c["h1"][:-1]) | (c["h2"][1:] != c["h2"][:-1])
    return np.concatenate(([0], np.flatnonzero(new) + 1))


def _differs(c: dict[str, np.ndarray], end: int) -> np.ndarray:
    """Whether each row but the first is of another document than the one before it."""
    differs = (c["doc_id"][1:end] != c["doc_id"][:end - 1]) | (c["null"][1:end] != c["null"][:end - 1])
    return differs | c["null"][1:end] & (c["th"][1:end] != c["th"][:end - 1])


def _documents(c: dict[str, np.ndarray], starts: np.ndarray, end: int) -> np.ndarray:
    """Distinct documents of each run (rows of a document are neighbours)."""
    new = np.concatenate(([1], _differs(c, end).astype(np.int64)))
    new[starts] = 1
    return np.add.reduceat(new, starts)


def _rows(c: dict[str, np.ndarray], edge: bool, many: bool, pick: np.ndarray | None = None) -> pa.RecordBatch:
    pick = np.arange(len(c["pos"])) if pick is None else pick
    n = len(pick)
    cols = {k: c[k][pick] for k in ("h1", "h2", "th", "pos")}
    return record_batch(_RUNS, edge=np.full(n, edge), many=np.full(n, many), **cols,
                        doc_id=pa.array(c["doc_id"][pick], mask=c["null"][pick]))


def _edge(c: dict[str, np.ndarray], min_docs: int) -> pa.RecordBatch:
    """One run that may go on elsewhere. If it has enough documents by itself, its rows but the first
    can be dropped whatever the neighbours hold; the first is settled with them."""
    n = len(c["pos"])
    if _documents(c, np.array([0]), n)[0] < min_docs:
        return _rows(c, True, False)
    edge = np.zeros(n, bool)
    edge[0] = True
    out = _rows(c, False, True)
    return out.set_column(0, _RUNS.field(0), pa.array(edge))


def _settle(c, starts, end, min_docs, keep_first, first) -> pa.RecordBatch | None:
    """The whole runs before ``end``; the very first run of a task is an edge."""
    if not len(starts):
        return None
    parts = []
    if first:
        stop = int(starts[1]) if len(starts) > 1 else end
        parts.append(_edge({k: v[:stop] for k, v in c.items()}, min_docs))
        starts = starts[1:]
    if len(starts):
        at = int(starts[0])
        sub = {k: v[at:end] for k, v in c.items()}
        rel = starts - at
        many = _documents(sub, rel, end - at) >= min_docs
        sizes = np.diff(np.append(rel, end - at))
        drop = np.repeat(many, sizes)
        if keep_first:
            drop[rel] = False
        pick = np.flatnonzero(drop)
        if len(pick):
            parts.append(_rows(sub, False, True, pick))
    if not parts:
        return None
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0] if len(parts) > 1 else parts[0]


def line_keep_bitmaps(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
                      keep_first: bool = False) -> DataFrame:
    """(doc_id, th, keep) of the documents that lose a line; ``th`` is xxhash64 of the text and
    ``keep`` the compressed bitmap. ``keep_first`` spares the first occurrence of each line in
    (document, position) order."""
    src = rename_inputs(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_bytes()).alias("th"), text_bytes().alias("body"))
    lines = map_arrow(src, _line_hashes(min_chars), _LINES_DDL)
    order = ["h1", "h2", "doc_id", "th", "pos"]
    ranged = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    runs = cut_lineage(map_arrow(ranged, _stream_runs(min_docs, keep_first), _RUNS_DDL))
    edges = runs.where("edge")
    ident = F.struct(F.col("doc_id").isNull(), F.coalesce("doc_id", "th"))
    verdict = edges.groupBy("h1", "h2").agg(
        (F.max("many") | (F.count_distinct(ident) >= min_docs)).alias("frequent"),
        F.min(F.struct(F.col("doc_id"), F.col("th"), F.col("pos"))).alias("head")).where("frequent")
    settled = edges.join(verdict, ["h1", "h2"])
    if keep_first:
        settled = settled.where(~same(F.struct("doc_id", "th", "pos"), F.col("head")))
    cols = ["doc_id", "th", "pos"]
    dropped = runs.where("not edge").select(*cols).unionByName(settled.select(*cols))
    per_doc = dropped.groupBy("doc_id", "th").agg(F.collect_set("pos").alias("dropped"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("keep", pa.binary())])
        for b in slices(batches):
            maps = []
            for places in b.column("dropped").to_pylist():
                keep = np.ones((max(places) // 8 + 1) * 8, dtype=bool)  # whole bytes: no padding that reads as dropped
                keep[places] = False
                maps.append(zlib.compress(np.packbits(keep).tobytes(), 1))
            yield record_batch(schema, doc_id=b.column("doc_id"), th=b.column("th"), keep=maps)

    return map_arrow(per_doc, pack, "doc_id long, th long, keep binary")


def kept_lines(body: bytes, keep: bytes | None) -> tuple[int, int, bytes]:
    """(lines, dropped lines, kept text) of one text under its bitmap."""
    lines = body.split(b"\n")
    if keep is None:
        return len(lines), 0, body
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), dtype=np.uint8))[:len(lines)]
    gone = set(np.flatnonzero(bits == 0).tolist())
    left = [x for i, x in enumerate(lines) if i not in gone]
    return len(lines), len(lines) - len(left), b"\n".join(left)


def drop_lines(docs: DataFrame, bitmaps: DataFrame, digest: bool = False) -> DataFrame:
    """Apply bitmaps: every column of ``docs`` with the text rewritten, or with ``digest`` only
    (doc_id, n_lines, n_dropped, kept_sha256). Rows that lose nothing keep their text (null too)."""
    key = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_bytes()).alias("th"))
    if digest:
        left = rename_inputs(docs, "doc_id", "text").select(key.alias("__k"), text_bytes().alias("__body"))
    else:
        left = docs.select(key.alias("__k"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    right = bitmaps.select(F.struct("doc_id", "th").alias("__j"), F.col("keep").alias("__keep"))
    joined = left.join(right, same(left["__k.doc_id"], right["__j.doc_id"])
                       & (left["__k.th"] == right["__j.th"]), "left")
    if digest:
        schema = pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()),
                            ("kept_sha256", pa.string())])

        def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in slices(batches, "__body"):
                out = [kept_lines(x, k) for x, k in zip(b.column("__body").to_pylist(), b.column("__keep").to_pylist())]
                yield record_batch(schema, doc_id=b.column("doc_id"), n_lines=[x[0] for x in out],
                                   n_dropped=[x[1] for x in out],
                                   kept_sha256=[hashlib.sha256(x[2]).hexdigest() for x in out])

        return map_arrow(joined.select("__k.doc_id", "__body", "__keep"), digests,
                         "doc_id long, n_lines long, n_dropped long, kept_sha256 string")

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            text = b.column("text")
            if b.column("keep").null_count < b.num_rows:
                text = pa.array([t if k is None else kept_lines((t or "").encode(), k)[2].decode()
                                 for t, k in zip(text.to_pylist(), b.column("keep").to_pylist())], pa.string())
            yield pa.RecordBatch.from_arrays([text, b.column("row")], names=["text", "row"])

    src = joined.select(F.col("__row.text").alias("text"), F.col("__keep").alias("keep"), F.col("__row").alias("row"))
    out = map_arrow(src, rewrite, f"text string, row {src.schema['row'].dataType.simpleString()}")
    return out.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more lose all their copies; per document the line counts and
    the digest of what stays."""
    docs = table(spark, sf_dir, "documents")
    return drop_lines(docs, line_keep_bitmaps(docs), digest=True)


ORACLE_SQL = r"""
WITH lines AS (
  SELECT doc_id, line, pos,
         translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)),
frequent AS (
  SELECT line_key FROM lines WHERE length(line_key) >= 1
  GROUP BY line_key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(f.line_key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.line_key IS NULL), '')) AS kept_sha256
FROM lines l LEFT JOIN frequent f ON l.line_key = f.line_key
GROUP BY doc_id
"""
