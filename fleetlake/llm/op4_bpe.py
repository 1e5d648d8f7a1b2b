"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the bytes of a text cuts it into chunks at places that depend on nearby content
only, so a passage that many documents share gives the same chunks in all of them. Chunk hashes
(128 bits) find the chunks that occur more than once; each such chunk is encoded once, by the task
that holds the first text with it, and its ids travel to the other texts. Everything else is
encoded where the text is. Inside a chunk the ids are final only between two places where the
splitting rule must begin a new piece whatever surrounds it (visible ASCII followed by ASCII white
space); the text around every chunk join is therefore encoded again, from such a place before the join to
one behind it, and the window widens until its edges agree with ids on both sides. The result is
the library's own encoding of the whole text.

Equal texts are encoded once; text rows are partially aggregated before they are shuffled, so a
group of copies that is a third of all rows stays small. Null texts are empty texts (no ids). Rows
with null or repeated ids are kept. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm.common import cut_lineage, fresh, map_arrow, record_batch, rename_inputs, slices, table
from fleetlake.llm.tokens import Codec, codec, default_vocabulary

CUT_BITS = 10      # a chunk ends at one byte in 2**CUT_BITS on average
MIN_REUSE = 128    # bytes; shorter chunks are not worth sending

_WHITE = np.zeros(256, dtype=bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_VISIBLE = np.zeros(256, dtype=bool)
_VISIBLE[33:127] = True
_GEAR = np.random.default_rng(20240229).integers(0, 1 << 32, 256, dtype=np.uint32)


def cuts(body: bytes, bits: int = CUT_BITS) -> list[int]:
    """Chunk borders of a text, 0 and its length included; never inside a code point. The hash of a
    place covers the 32 bytes before it."""
    b = np.frombuffer(body, dtype=np.uint8)
    h = _GEAR[b]
    for shift in (1, 2, 4, 8, 16):
        if len(h) > shift:
            h[shift:] = h[shift:] + (h[:-shift] << np.uint32(shift))
    ends = np.flatnonzero(h >> np.uint32(32 - bits) == 0) + 1
    out = [0]
    for e in ends.tolist():
        while e < len(body) and body[e] & 0xC0 == 0x80:
            e += 1
        if out[-1] < e < len(body):
            out.append(e)
    if body:
        out.append(len(body))
    return out


def safe_places(body: bytes) -> np.ndarray:
    """Offsets where a new piece begins for certain."""
    b = np.frombuffer(body, dtype=np.uint8)
    return np.flatnonzero(_VISIBLE[b[:-1]] & _WHITE[b[1:]]) + 1 if len(b) > 1 else np.empty(0, dtype=np.int64)


def assemble(body: bytes, chunks: list[tuple[int, int, np.ndarray]], c: Codec) -> np.ndarray:
    """Ids of the whole text from ready-made ids of some of its chunks (offset, size, ids)."""
    if not chunks:
        return c.encode(body.decode("utf-8", "replace"))
    safe = safe_places(body)
    out, done = [], 0
    for start, size, ids in sorted(chunks, key=lambda x: x[0]):
        inner = safe[np.searchsorted(safe, start):np.searchsorted(safe, start + size, side="right")]
        ends = np.concatenate(([0], np.cumsum(c.lengths[ids]))) + start
        inner = inner[ends[np.searchsorted(ends, inner).clip(max=len(ends) - 1)] == inner]  # agreement with the chunk's ids
        if start == 0:
            inner = np.concatenate(([0], inner))
        if start + size == len(body):
            inner = np.concatenate((inner, [len(body)]))
        if len(inner) < 2 or inner[0] < done:
            continue
        a, b = int(inner[0]), int(inner[-1])
        out.append(c.encode(body[done:a].decode("utf-8", "replace")))
        out.append(ids[np.searchsorted(ends, a):np.searchsorted(ends, b)])
        done = b
    out.append(c.encode(body[done:].decode("utf-8", "replace")))
    return np.concatenate(out).astype(np.uint32)


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return rename_inputs(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
        F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"))


def _chunk_hashes(bits: int, min_reuse: int):
    schema = pa.schema([(n, pa.int64()) for n in ("k1", "k2", "pos", "size", "h1", "h2")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "body"):
            rows, pos, sizes, digests = [], [], [], []
            for row, body in enumerate(b.column("body").to_pylist()):
                at = cuts(body, bits)
                for s, e in zip(at, at[1:]):
                    if e - s >= min_reuse:
                        rows.append(row)
                        pos.append(s)
                        sizes.append(e - s)
                        digests.append(xxhash.xxh3_128_digest(body[s:e]))
            if rows:
                h = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
                take = pa.array(rows, pa.int32())
                yield record_batch(schema, k1=b.column("k1").take(take), k2=b.column("k2").take(take), pos=pos,
                                   size=sizes, h1=h[:, 0], h2=h[:, 1])
    return run


def encode_texts(docs: DataFrame, vocabulary: str | None = None, bits: int = CUT_BITS, min_reuse: int = MIN_REUSE,
                 digest: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, ids (array) and decoded (text), or with ``digest`` doc_id,
    n_tokens, ids_sha256 and decoded_sha256."""
    path = vocabulary or default_vocabulary()
    keyed = _keyed(docs)
    found = map_arrow(keyed.select("k1", "k2", F.col("text").cast("binary").alias("body")),
                      _chunk_hashes(bits, min_reuse), "k1 long, k2 long, pos long, size long, h1 long, h2 long")
    found = found.withColumn("place", F.xxhash64("k1", "k2", "pos"))
    shared = found.groupBy("h1", "h2").agg(F.min("place").alias("owner"), F.max("place").alias("other")).where("owner <> other")
    uses = found.withColumn("h", fresh("h1", "h2")).drop("h1", "h2").join(
        shared.select(fresh("h1", "h2").alias("h"), "owner"), "h").groupBy("k1", "k2", "pos").agg(
        F.max("size").alias("size"), F.max("h.h1").alias("h1"), F.max("h.h2").alias("h2"),
        F.max(F.col("owner") == F.col("place")).alias("owns"))
    uses = cut_lineage(uses)

    texts = keyed.groupBy("k1", "k2").agg(F.first("text").alias("text"))
    owned = uses.where("owns").groupBy("k1", "k2").agg(F.collect_list(F.struct("pos", "size", "h1", "h2")).alias("chunks"))

    def encode_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        width = "<u2" if len(c.lengths) <= 1 << 16 else "<u4"
        schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("ids", pa.binary())])
        for b in slices(batches, "body"):
            rows = [(x["h1"], x["h2"], c.encode(body[x["pos"]:x["pos"] + x["size"]].decode("utf-8", "replace")))
                    for body, chunks in zip(b.column("body").to_pylist(), b.column("chunks").to_pylist()) for x in chunks]
            yield record_batch(schema, h1=[r[0] for r in rows], h2=[r[1] for r in rows],
                               ids=[r[2].astype(width).tobytes() for r in rows])

    body = F.col("text").cast("binary").alias("body")
    ready = map_arrow(texts.join(owned, ["k1", "k2"]).select(body, "chunks"), encode_chunks, "h1 long, h2 long, ids binary")
    sent = uses.select("k1", "k2", "pos", "size", fresh("h1", "h2").alias("h")).join(
        ready.select(fresh("h1", "h2").alias("h"), "ids"), "h")
    per_text = sent.groupBy("k1", "k2").agg(F.collect_list(F.struct("pos", "size", "ids")).alias("chunks"))

    if digest:
        schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                            ("decoded_sha256", pa.string())])
        ddl = "k1 long, k2 long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    else:
        schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])
        ddl = "k1 long, k2 long, ids array<int>, decoded string"

    def whole_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        width = "<u2" if len(c.lengths) <= 1 << 16 else "<u4"
        for b in slices(batches, "body"):
            rows = []
            for text, chunks in zip(b.column("body").to_pylist(), b.column("chunks").to_pylist()):
                parts = [(x["pos"], x["size"], np.frombuffer(x["ids"], width)) for x in chunks or ()]
                ids = assemble(text, parts, c)
                # decode(): bytes that are no valid UTF-8 become replacement characters
                plain = c.decode_bytes(ids).decode("utf-8", "replace").encode()
                rows.append((len(ids), hashlib.sha256(b",".join(c.decimal[ids].tolist())).hexdigest(),
                             hashlib.sha256(plain).hexdigest()) if digest else (ids.astype(np.int32), plain.decode()))
            yield record_batch(schema, k1=b.column("k1"), k2=b.column("k2"),
                               **{n: [r[i] for r in rows] for i, n in enumerate(schema.names[2:])})

    done = map_arrow(texts.join(per_text, ["k1", "k2"], "left").select("k1", "k2", body, "chunks"), whole_texts, ddl)
    key = fresh("k1", "k2").alias("k")
    return keyed.select("doc_id", key).join(done.select(key, *schema.names[2:]), "k").drop("k")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode all documents; per document the number of ids and both digests."""
    return encode_texts(table(spark, sf_dir, "documents"), digest=True)
