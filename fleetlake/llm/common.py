"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.session import ensure_checkpoint_dir

ROWS_PER_SLICE = 512
BYTES_PER_SLICE = 8 << 20
ROWS_PER_FILE = 20_000  # narrow rows that are worth a task and a file of their own


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor (once per session)."""
    sc = spark.sparkContext
    if getattr(sc, "_fleetlake_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="fleetlake-py-"), "fleetlake.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    sc._fleetlake_shipped = True


def in_files(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of about ``rows`` narrow rows, in as many partitions as they are worth: a few rows dealt over
    hundreds of partitions cost a task and a file each when they are written."""
    return df.coalesce(1 + rows // ROWS_PER_FILE)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the session's shared checkpoint folder and read it back. Loops use this
    rather than ``checkpoint()``: the table has its true size, while a checkpointed frame keeps the
    optimizer's estimate, which a self-join squares in every round."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` with the package present on the executors."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def slices(batches: Iterator[pa.RecordBatch], text: int | str | None = None,
           rows: int = ROWS_PER_SLICE) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the Python objects made from one piece stay small: at most
    ``rows`` rows and about BYTES_PER_SLICE bytes of the column ``text`` (one row at least)."""
    for b in batches:
        if text is None:
            for i in range(0, b.num_rows, rows):
                yield b.slice(i, rows)
            continue
        sizes = pc.binary_length(b.column(text)).to_pylist()
        start = size = 0
        for i, n in enumerate(sizes):
            n = n or 0
            if i > start and (i - start >= rows or size + n > BYTES_PER_SLICE):
                yield b.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < b.num_rows:
            yield b.slice(start)


def lower_in_place(text: str) -> str:
    """The text in lower case, every code point at its old place: those whose lower case has several code
    points stay as they are, so that offsets found in the result are offsets of the text."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


def record_batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo n; null ids count as remainder 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % n, F.lit(0))


def fresh(*names: str) -> Column:
    """A key that no earlier exchange is known to be partitioned by, so that a join gets exchanges of
    its own, which adaptive execution can split where a key is hot."""
    return F.struct(*[F.col(n) for n in names])


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def text_bytes(name: str = "text") -> Column:
    """The text as UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(name), F.lit("")).cast("binary")


def rename_inputs(docs: DataFrame, *names: str) -> DataFrame:
    """Only the columns an operator reads, so that extra columns cannot clash with its own."""
    return docs.select(*[F.col(f"`{n}`") for n in names])


def dump_bytes(**arrays) -> bytes:
    """Several numpy arrays as one byte string (closures carry models this way)."""
    import numpy as np

    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def load_bytes(blob: bytes) -> dict:
    import numpy as np

    with np.load(io.BytesIO(blob), allow_pickle=False) as z:
        return {k: z[k] for k in z.files}
