"""WARC archives: written with Spark's text writer, read back with boundary-chain verification.

Writing: one ``response`` record per distinct payload, ``revisit`` records for its other holders
(``identical-payload-digest``), uncompressed, one file per task. Header and payload are one string
and the record separator is the writer's line separator, so any file system Spark knows will do
and the output committer takes care of lost tasks.

Reading: Spark's text reader cuts the files at every ``WARC/1.1`` magic, in splits of any size.
Each task emits, for every magic it sees, a candidate offset and the successor offset that its
Content-Length implies, and contracts the chains inside its split to one exit per candidate.
Pointer jumping over the splits (doubling) starts at offset 0 of each file; a candidate counts only
if that chain reaches it, so a magic inside a payload is rejected. A record whose payload holds the
magic is put together again from its segments in a second pass over just those files.

Nulls: a null html is an empty payload; a null url is written as ``urn:none``; a null page_id has no
``X-Page-ID`` header and never becomes the response while a row with an id has the same payload.
Of equal payloads (of ``min_bytes`` or more) all rows with the largest page_id are the response,
repeated rows included. An empty table gives no archive and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlake.llm.common import cut_lineage, map_arrow, record_batch, rename_inputs, same, table
from fleetlake.session import ensure_checkpoint_dir

MIN_REVISIT_BYTES = 0
MAX_BROADCAST_DIGESTS = 100_000  # about 8 MB; more repeated digests are joined by shuffle

# Fixed values of WARC 1.1 (ISO 28500)
MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1, from built-in functions: 20 bits at a time."""
    digest = F.sha1(payload)
    def chars(i):
        bits = F.conv(F.substring(digest, i * 5 + 1, 5), 16, 10).cast("int")
        return F.concat(*[F.substring(F.lit(BASE32), F.shiftright(bits, s).bitwiseAND(31) + 1, 1) for s in (15, 10, 5, 0)])
    return F.concat(*[chars(i) for i in range(8)])


def record_id(page_id: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("none")), digest).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in
                    ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def write_warc(pages: DataFrame, path: str, date: str = "2020-01-01T00:00:00Z",
               min_bytes: int = MIN_REVISIT_BYTES) -> None:
    """One record per row of (page_id, url, html)."""
    src = rename_inputs(pages, "page_id", "url", "html").select(
        F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace(F.coalesce("url", F.lit("urn:none")), r"[\r\n]", "%0A").alias("url"),
        F.coalesce("html", F.lit("")).alias("payload"))
    src = src.withColumn("digest", sha1_base32(F.col("payload").cast("binary"))).withColumn(
        "size", F.octet_length("payload").cast("long"))
    repeated = cut_lineage(src.where(F.col("size") >= min_bytes).groupBy("digest", "size").agg(
        F.max("page_id").alias("top"), F.count("*").alias("holders")).where("holders > 1").drop("holders"))
    few = repeated.limit(MAX_BROADCAST_DIGESTS + 1).count() <= MAX_BROADCAST_DIGESTS
    key = F.concat_ws(":", "digest", "size")  # a new key: both sides get an exchange that AQE can split
    repeated = repeated.select(key.alias("key"), "top")
    rows = src.withColumn("key", key).join(F.broadcast(repeated) if few else repeated, "key", "left")
    revisit = F.col("top").isNotNull() & ~same(F.col("page_id"), F.col("top"))

    crlf = "\r\n"
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{crlf}Content-Type: text/html; charset=utf-8{crlf}Content-Length: "),
                    F.col("size").cast("string"), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    record = F.concat(
        F.lit(f"{MAGIC}WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit(f"{crlf}WARC-Record-ID: "), record_id(F.col("page_id"), F.col("digest")),
        F.lit(f"{crlf}WARC-Date: {date}{crlf}WARC-Target-URI: "), F.col("url"),
        F.coalesce(F.concat(F.lit(f"{crlf}X-Page-ID: "), F.col("page_id").cast("string")), F.lit("")),
        F.lit(f"{crlf}WARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(revisit, F.concat(F.lit(f"{crlf}WARC-Refers-To: "), record_id(F.col("top"), F.col("digest")),
                                 F.lit(f"{crlf}WARC-Profile: {PROFILE}"))).otherwise(""),
        F.lit(f"{crlf}Content-Type: application/http; msgtype=response{crlf}Content-Length: "),
        F.octet_length(F.col("block")).cast("string"), F.lit(END), F.col("block"))
    rows.withColumn("block", block).select(record.alias("value")).write.option("lineSep", END).text(path)


_CANDIDATES = pa.schema([
    ("file", pa.string()), ("split", pa.int64()), ("rel", pa.int64()), ("succ", pa.int64()), ("exit", pa.int64()),
    ("whole", pa.bool_()), ("total", pa.int64()), ("type", pa.string()), ("id", pa.string()), ("refers", pa.string()),
    ("page_id", pa.int64()), ("declared", pa.string()), ("size", pa.int64()), ("digest", pa.string())])
_DDL = ("file string, split long, rel long, succ long, exit long, whole boolean, total long, type string, id string, "
        "refers string, page_id long, declared string, size long, digest string")
_SUMMARY = ("type", "id", "refers", "page_id", "declared", "size", "digest")
_MAGIC = MAGIC.encode()


def _headers(segment: bytes) -> tuple[dict[bytes, bytes], int] | None:
    """Header fields and the place where the block starts; None if it is no record head."""
    end = segment.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for line in segment[:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    return (fields, end + 4) if fields.get(b"content-length", b"").isdigit() else None


def summary(segment: bytes) -> tuple:
    """Type, ids and payload digest of one whole record (without its magic)."""
    fields, start = _headers(segment)
    text = lambda k: fields[k].decode("utf-8", "replace") if k in fields else None
    block = segment[start:start + int(fields[b"content-length"])]
    head, _, payload = block.partition(b"\r\n\r\n") if b"application/http" in fields.get(b"content-type", b"") else (b"", b"", block)
    page, kind = fields.get(b"x-page-id", b""), text(b"warc-type")
    whole = kind != "revisit"
    return (kind, text(b"warc-record-id"), text(b"warc-refers-to"),
            int(page) if page.lstrip(b"-").isdigit() else None, (text(b"warc-payload-digest") or "").removeprefix("sha1:") or None,
            len(payload) if whole else None, base64.b32encode(hashlib.sha1(payload).digest()).decode() if whole else None)


def _segments(batches: Iterator[pa.RecordBatch]):
    """(file, split, offset in the split, starts with a magic, bytes) of every piece between magics."""
    at = None
    for b in batches:
        for file, split, value in zip(b.column("file").to_pylist(), b.column("split").to_pylist(), b.column("value")):
            if at != (file, split):
                at, rel = (file, split), 0
                head = split == 0  # what stands before the first magic of the file
            else:
                head = False
            value = value.as_py()
            yield file, split, rel, not head, value
            rel += len(value) + (0 if head else len(_MAGIC))


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def close(file, split, found, total):
        exits: dict[int, int | None] = {}
        for c in reversed(found):
            succ = c["succ"]
            exits[c["rel"]] = c["exit"] = None if succ is None else exits.get(succ) if succ < total else succ
        rows = found + [{"rel": None, "total": total}]
        return record_batch(_CANDIDATES, file=[file] * len(rows), split=[split] * len(rows),
                            **{n: [r.get(n) for r in rows] for n in _CANDIDATES.names if n not in ("file", "split")})

    at, found, total = None, [], 0
    for file, split, rel, magic, value in _segments(batches):
        if at != (file, split):
            if at is not None:
                yield close(*at, found, total)
            at, found, total = (file, split), [], 0
        total = rel + len(value) + (len(_MAGIC) if magic else 0)
        if not magic:
            continue
        head = _headers(value)
        row = {"rel": rel, "succ": None, "whole": False}
        if head is not None:
            size = head[1] + int(head[0][b"content-length"])
            row["succ"] = rel + len(_MAGIC) + size + 4
            row["whole"] = len(value) == size + 4 and value.endswith(b"\r\n\r\n")
            if row["whole"]:
                row |= zip(_SUMMARY, summary(value))
        found.append(row)
    if at is not None:
        yield close(*at, found, total)


def _scan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.col("value").cast("binary").alias("value"))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives under ``path``: file, offset and the fields of
    ``summary``. Needs uncompressed files of records that start with ``WARC/1.1``."""
    found = cut_lineage(map_arrow(_scan(spark, path), _candidates, _DDL))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = found.where("rel IS NULL").select(
        "file", "split", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"),
        F.sum("total").over(Window.partitionBy("file")).alias("length"))
    nodes = cut_lineage(found.where("rel IS NOT NULL").join(splits, ["file", "split"]).select(
        "file", "split", "rel", (F.col("base") + F.col("rel")).alias("off"), (F.col("base") + F.col("succ")).alias("succ"),
        (F.col("base") + F.col("exit")).alias("exit"), "length", "whole", *_SUMMARY))

    # pointer jumping over the splits: how far 1, 2, 4, ... splits lead from each candidate
    reach = nodes.where("off = 0").select("file", "off")
    jump = nodes.where("exit < length").select("file", "off", "exit")
    while jump.limit(1).count():
        further = reach.join(jump, ["file", "off"]).select("file", F.col("exit").alias("off"))
        reach = cut_lineage(reach.unionByName(further).distinct())
        then = jump.select("file", F.col("off").alias("exit"), F.col("exit").alias("then"))
        jump = cut_lineage(jump.join(then, ["file", "exit"]).select("file", "off", F.col("then").alias("exit")))

    # inside each split: walk the chain from the place where the true chain enters it
    entered = nodes.join(reach.withColumn("entry", F.lit(True)), ["file", "off"], "left")

    def walk(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("off")
        succ = dict(zip(rows["off"], rows["succ"]))
        seen = set()
        for off in rows.loc[rows["entry"].notna(), "off"]:
            while off in succ and off not in seen:
                seen.add(off)
                off = succ[off]
        return rows.loc[rows["off"].isin(seen), ["file", "off"]]

    true = entered.select("file", "split", "off", "succ", "entry").groupBy("file", "split").applyInPandas(
        walk, "file string, off long")
    nodes = nodes.join(true.withColumn("reached", F.lit(True)), ["file", "off"], "left")
    nodes = cut_lineage(nodes)
    records = nodes.where("reached AND whole").select("file", "off", *_SUMMARY)
    broken = nodes.where("reached AND NOT whole")
    if not broken.limit(1).count():
        return records

    # records cut by a magic inside their payload: their segments, in order, from just those files
    files = broken.select("file").distinct()
    last = Window.partitionBy("file").orderBy("off").rowsBetween(Window.unboundedPreceding, 0)
    parts = nodes.join(files, "file", "left_semi").withColumn(
        "start", F.max(F.when(F.col("reached"), F.col("off"))).over(last))
    parts = parts.join(broken.select("file", F.col("off").alias("start")), ["file", "start"], "left_semi").select(
        "file", "split", "rel", "start", "off")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("file", pa.string()), ("split", pa.int64()), ("rel", pa.int64()), ("value", pa.binary())])
        for file, split, rel, magic, value in _segments(batches):
            if magic:
                yield record_batch(schema, file=[file], split=[split], rel=[rel], value=[value])

    text = map_arrow(_scan(spark, path).join(F.broadcast(files) if files.count() <= 10_000 else files, "file", "left_semi"),
                     pieces, "file string, split long, rel long, value binary")
    whole = text.join(parts, ["file", "split", "rel"]).groupBy("file", F.col("start").alias("off")).agg(
        F.sort_array(F.collect_list(F.struct("off", "value"))).alias("parts"))

    def mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("file", pa.string()), ("off", pa.int64()), *[(n, _CANDIDATES.field(n).type) for n in _SUMMARY]])
        for b in batches:
            rows = [summary(_MAGIC.join(p["value"] for p in r)) for r in b.column("parts").to_pylist()]
            yield record_batch(schema, file=b.column("file"), off=b.column("off"),
                               **{n: [r[i] for r in rows] for i, n in enumerate(_SUMMARY)})

    mended = map_arrow(whole, mend, "file string, off long, type string, id string, refers string, page_id long, "
                                    "declared string, size long, digest string")
    return records.unionByName(mended)


def page_records(records: DataFrame) -> DataFrame:
    """Per page: what its record says about the payload; revisits take size, digest and page of the
    response they refer to (and must declare that digest)."""
    mine = records.select("page_id", "type", "id", "refers", "declared", "size", "digest")
    full = mine.where("type = 'response'").select("page_id", F.col("size").alias("payload_bytes"),
                                                  F.col("digest").alias("payload_digest"),
                                                  F.col("type").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    target = mine.where("type = 'response'").groupBy(F.col("id").alias("refers"), F.col("digest").alias("declared")).agg(
        F.max("page_id").alias("refers_to"), F.max("size").alias("payload_bytes"))
    key = F.concat_ws("|", "refers", "declared")  # as above: the holders of one payload may be many
    target = target.select(key.alias("key"), "refers_to", "payload_bytes")
    revisits = mine.where("type = 'revisit'").withColumn("key", key).join(target, "key").select(
        "page_id", "payload_bytes", F.col("declared").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to")
    return full.unionByName(revisits)


def archive_folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every page to WARC archives in the shared folder, read them back, describe each record."""
    path = archive_folder(spark)
    write_warc(table(spark, sf_dir, "pages"), path)
    return page_records(read_warc(spark, path))


ORACLE_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS size,
         sha1(coalesce(html, '')) AS h FROM pages),
d AS (
  SELECT page_id, size, array_to_string(list_transform(range(0, 32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, 1 + 5 * (i // 4), 5))::BIGINT
                  >> (15 - 5 * (i % 4))) & 31), 1)), '') AS digest FROM p),
t AS (SELECT digest, max(page_id) AS top FROM d GROUP BY digest)
SELECT d.page_id, d.size AS payload_bytes, d.digest AS payload_digest,
       CASE WHEN t.top IS NOT NULL AND d.page_id IS DISTINCT FROM t.top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN d.page_id IS DISTINCT FROM t.top THEN t.top END AS refers_to
FROM d JOIN t USING (digest)
"""
