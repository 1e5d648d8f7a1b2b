"""Language identification by rank-order profiles of character n-grams.

A profile is the list of the most frequent n-grams (1 to 3 letters, words padded by one blank, lower
case) in rank order. Language profiles come from counts over all learning documents: tasks count
per language, Spark sums the counts and ranks them. A document is compared with each language by the
out-of-place distance: for each of its own most frequent n-grams the difference of ranks, or the
profile length if the language lacks it. The smallest distance wins (ties: smaller name).

Learning uses only text and non-null lang of the given rows. A null text, or one without a letter,
is ``und`` with score 0; so is every text if nothing could be learned. The score is 1 minus the
distance over the largest possible one. Whole texts are read; repeated rows count each time; every
row gets one result. An empty table gives an empty result.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlake.llm.common import crc_mod, map_arrow, record_batch, rename_inputs, slices, table

PROFILE = 400        # n-grams of a language profile
DOCUMENT = 300       # n-grams of a document
UNDETERMINED = "und"
MAX_LANGUAGES = 256  # languages that profiles are learned for at most
_BITS = 21           # a code point; three fit one 64-bit code
_FLUSH = 2_000_000   # distinct n-grams a task counts before it emits partial counts


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """1 for every code point that is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), dtype=bool, count=sys.maxunicode + 1)


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram codes of a text and their counts. A blank stands for any run of other
    characters and for both ends of the text; n-grams have no blank inside."""
    cp = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    letter = _letters()[cp]
    if not letter.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    cp = np.where(letter, cp, 0)
    cp = np.concatenate(([0], cp[letter | np.concatenate(([True], letter[:-1]))], [0]))
    blank = cp == 0
    pairs = (cp[:-1] << _BITS) | cp[1:]
    triples = (cp[:-2] << 2 * _BITS) | pairs[1:]
    codes = np.concatenate((cp[~blank], pairs[~(blank[:-1] & blank[1:])] | (1 << 62), triples[~blank[1:-1]] | np.int64(-1 << 63)))
    codes.sort()
    first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    return codes[first], np.diff(np.append(first, len(codes)))


def top(codes: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """The k most frequent codes in rank order (ties: smaller code)."""
    if len(codes) > k:
        least = np.partition(counts, len(counts) - k)[len(counts) - k]
        keep = counts >= least
        codes, counts = codes[keep], counts[keep]
    return codes[np.lexsort((codes, -counts))][:k]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("lang", pa.string()), ("code", pa.int64()), ("n", pa.int64())])
    held: dict[str, list] = {}
    size = 0

    def merged(parts):
        codes, counts = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        found, at = np.unique(codes, return_inverse=True)
        return found, np.bincount(at, weights=counts).astype(np.int64)

    def flush():
        for lang, parts in held.items():
            codes, counts = merged(parts)
            for i in range(0, len(codes), 100_000):
                part = codes[i:i + 100_000]
                yield record_batch(schema, lang=[lang] * len(part), code=part, n=counts[i:i + 100_000])
        held.clear()

    for b in slices(batches, "text"):
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
            parts = held.setdefault(lang, [])
            parts.append(grams(text))
            if len(parts) >= 256:
                parts[:] = [merged(parts)]
        size = sum(len(p[0]) for parts in held.values() for p in parts)
        if size > _FLUSH:
            yield from flush()
    yield from flush()


def learn(docs: DataFrame, profile: int = PROFILE, max_languages: int = MAX_LANGUAGES) -> dict[str, np.ndarray]:
    """Profiles by language from the rows of ``docs`` (text, lang). The result is bounded: the driver
    gets ``profile`` rows per language, and more than ``max_languages`` languages are an error, since the
    profiles of all go to every task."""
    src = rename_inputs(docs, "text", "lang").where("lang IS NOT NULL AND text IS NOT NULL")
    if src.select("lang").distinct().limit(max_languages + 1).count() > max_languages:
        raise ValueError(f"more than {max_languages} languages; raise max_languages or clean the column lang")
    total = map_arrow(src, _count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    out: dict[str, list[int]] = {}
    for r in total.withColumn("rank", rank).where(F.col("rank") <= profile).orderBy("lang", "rank").collect():
        out.setdefault(r["lang"], []).append(r["code"])
    return {k: np.array(v, dtype=np.int64) for k, v in out.items()}


def predict(docs: DataFrame, profiles: dict[str, np.ndarray], profile: int = PROFILE, document: int = DOCUMENT,
            carry: bool = False) -> DataFrame:
    """(doc_id, lang_pred, score) of every row; with ``carry`` also ``row``, a struct of all columns."""
    names = sorted(profiles)
    codes = np.unique(np.concatenate([*profiles.values(), np.empty(0, np.int64)])).astype(np.int64)
    ranks = np.full((len(codes) + 1, len(names)), -1, dtype=np.int16 if profile < 1 << 15 else np.int64)
    for k, name in enumerate(names):
        ranks[np.searchsorted(codes, profiles[name]), k] = np.arange(len(profiles[name]))

    def guess(text: str | None) -> tuple[str, float]:
        found, counts = grams(text)
        if not len(found) or not names:
            return UNDETERMINED, 0.0
        mine = top(found, counts, document)
        at = np.searchsorted(codes, mine)
        at[codes[at.clip(max=len(codes) - 1)] != mine] = len(codes)
        theirs = ranks[at]
        apart = np.where(theirs < 0, profile, np.abs(theirs - np.arange(len(mine))[:, None])).clip(max=profile).sum(axis=0)
        best = int(apart.argmin())
        return names[best], float(1 - apart[best] / (profile * len(mine)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            found = [guess(t) for t in b.column("text").to_pylist()]
            made = [b.column("doc_id"), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            rest = [b.column("row")] if carry else []
            yield pa.RecordBatch.from_arrays([*made, *rest], names=["doc_id", "lang_pred", "score"] + ["row"] * carry)

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"),
                      *[F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] * carry)
    ddl = "doc_id long, lang_pred string, score double"
    return map_arrow(src, run, ddl + (f", row {src.schema['row'].dataType.simpleString()}" if carry else ""))


def held_out(doc_id) -> Column:
    return crc_mod(doc_id, 4) == 2


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    profiles = learn(docs.where(~held_out(F.col("doc_id"))))
    return predict(docs, profiles).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
