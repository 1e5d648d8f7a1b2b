"""Toxicity: a linear-chain conditional random field tags toxic words.

Learning. Documents are labelled, words are not, so word labels are made first: in the learning rows
a word (or one of its prefixes) that is far more frequent among toxic documents than among clean
ones (log-likelihood ratio and rate ratio) is labelled toxic in toxic documents; every other word,
and every word of a clean document, is labelled clean. A two-state chain is then fitted to these
labels by gradient steps on the exact likelihood; its emission features are the word, its prefixes,
its suffix and its neighbours (hashed). Last, a logistic regression turns the forward-backward
marginals of a document (expected toxic words, largest marginal, density) into its score. At most
``max_rows`` labelled rows are used, chosen by a hash of the id.

Scoring. A chain is a sentence, however long. Each document gets its score and the
spans [start, end) in code points of the words whose marginal is at least 0.5. A null, empty or
wordless text has no words and gets the score of zero toxic words. Rows with null or repeated ids
each get a result; null labels are not used. Without labels of both kinds every score is 0. An empty
table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm.common import crc_mod, lower_in_place, map_arrow, rename_inputs, slices, table

MAX_ROWS = 3_000      # labelled rows used for learning, a third of them toxic at most
FEATURE_BITS = 18
MIN_G2 = 20.0         # log-likelihood ratio and
MIN_RATIO = 4.0       # rate ratio that make a word or prefix toxic
PREFIXES = range(3, 9)  # bytes
FLOOR = 0.25          # marginal from which a word counts towards the expected number
CACHE = 400_000       # word types a task keeps the scores of
WORDS = 1 << 18       # words that a step of the learning takes at once (one document at least)

_STOP = re.compile(r"[.!?\n]+")
_WORD = re.compile(r"[^\W_]+")
_SIZE = 1 << FEATURE_BITS


def word_features(words: list[str]) -> np.ndarray:
    """Hashed features, a row per word: the word, its suffix, its prefixes (_SIZE where it is too
    short), the word as neighbour before, as neighbour behind."""
    raw = [w.encode() for w in words]
    n = np.array([len(b) for b in raw], dtype=np.int64)
    b = np.array(raw, dtype=f"S{PREFIXES.stop}").view(np.uint8).reshape(len(raw), -1).astype(np.uint32) if raw else np.empty((0, 1), np.uint32)
    tail = np.array([x[-3:] for x in raw], dtype="S3").view(np.uint8).reshape(len(raw), -1).astype(np.uint32) if raw else np.empty((0, 3), np.uint32)
    whole = np.array([zlib.crc32(x) for x in raw], dtype=np.uint32)

    def spread(x, salt):
        x = (x ^ np.uint32(salt)) * np.uint32(0x9E3779B1)
        return ((x ^ (x >> np.uint32(15))) * np.uint32(0x85EBCA77) >> np.uint32(32 - FEATURE_BITS)).astype(np.int64)

    h = np.zeros(len(raw), dtype=np.uint32)
    out = [spread(whole, 1), spread(tail @ np.array([1, 257, 66049], dtype=np.uint32), 2)]
    for k in range(PREFIXES.stop - 1):
        h = (h ^ b[:, k]) * np.uint32(0x01000193) + np.uint32(k + 1)
        if k + 1 in PREFIXES:
            out.append(np.where(n > k, spread(h, 3), _SIZE))
    return np.stack((*out, spread(whole, 4), spread(whole, 5)), axis=1)


def chains(text: str) -> tuple[list[str], list[int]]:
    """Lower-case words of a text and the length of each chain."""
    words, lengths = [], []
    for sentence in _STOP.split(lower_in_place(text)):
        found = _WORD.findall(sentence)
        if found:
            words += found
            lengths.append(len(found))
    return words, lengths


def forward_backward(e: np.ndarray, lengths: np.ndarray, t: np.ndarray, start: float, pairs: bool = False):
    """Marginals of state 1 from log-odds emissions ``e`` of concatenated chains and the transition
    scores ``t[a, b]``. A message is the ratio of its two states, so each is one number. With
    ``pairs`` also the expected transition counts. The chains go side by side, longest first, so that
    step i takes those that have a word there."""
    odds, a = np.exp(e.clip(-30, 30)), np.exp(t)
    firsts = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    sizes, s = lengths[order], firsts[order]
    width = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(width + 1), side="left")  # chains with more than i words
    f, b = odds.copy(), np.ones_like(odds)
    f[firsts] *= np.exp(start)
    for i in range(1, width):
        at = s[:active[i]] + i
        before = f[at - 1]
        f[at] = odds[at] * (a[0, 1] + a[1, 1] * before) / (a[0, 0] + a[1, 0] * before)
    for i in range(width - 2, -1, -1):
        at = s[:active[i + 1]] + i
        back = odds[at + 1] * b[at + 1]
        b[at] = (a[1, 0] + a[1, 1] * back) / (a[0, 0] + a[0, 1] * back)
    q = f * b
    p = q / (1 + q)
    if not pairs:
        return p
    inner = np.ones(len(e), dtype=bool)
    inner[firsts + lengths - 1] = False
    at = np.flatnonzero(inner)
    g, h = f[at], odds[at + 1] * b[at + 1]
    joint = [np.full_like(g, a[0, 0]), a[0, 1] * h, a[1, 0] * g, a[1, 1] * g * h]
    return p, np.array([(j / sum(joint)).sum() for j in joint]).reshape(2, 2)


class Numbers(dict):
    """Numbers words as they come."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


class Part(NamedTuple):
    """Some whole documents: number of each word, length of each chain, words and label of each document."""
    ids: np.ndarray
    lengths: np.ndarray
    sizes: np.ndarray
    y: np.ndarray


def parts_of(rows: Iterable[tuple[str, int]], number: Numbers) -> list[Part]:
    """Documents with words among (text, label), in parts of about WORDS words; ``number`` gets the word types.
    Of each word only its number stays, not the word itself."""
    parts, ids, lengths, sizes, y = [], [], [], [], []

    def close():
        if sizes:
            parts.append(Part(np.concatenate(ids), np.array(lengths, dtype=np.int64), np.array(sizes), np.array(y)))
            for x in (ids, lengths, sizes, y):
                x.clear()

    for text, label in rows:
        words, n = chains(text)
        if not words:
            continue
        if sum(sizes) + len(words) > WORDS:
            close()
        ids.append(np.fromiter(map(number.__getitem__, words), dtype=np.int32, count=len(words)))
        lengths += n
        sizes.append(len(words))
        y.append(label)
    close()
    return parts


def emit(table, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores of the words of concatenated chains, and the places of words that have one before them. ``table``
    has for each word type its own score, its score for the word behind it and for the word before it."""
    e = table[0][ids]
    inner = np.ones(len(ids), dtype=bool)
    inner[np.cumsum(lengths) - lengths] = False
    k = np.flatnonzero(inner)
    e[k] += table[1][ids[k - 1]]
    e[k - 1] += table[2][ids[k]]
    return e, k


class Emissions:
    """Scores of word types, kept between the batches of a task."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = np.append(weights, 0), bias
        self.clear()

    def clear(self):
        self.number = Numbers()
        self.table = np.empty((3, 0))

    def scores(self, words: list[str], lengths: np.ndarray) -> np.ndarray:
        if len(self.number) > CACHE:
            self.clear()
        known = len(self.number)
        ids = np.fromiter(map(self.number.__getitem__, words), dtype=np.int64, count=len(words))
        if len(self.number) > known:
            w = self.weights[word_features(list(islice(self.number, known, None)))]
            self.table = np.concatenate((self.table, (w[:, :-2].sum(axis=1) + self.bias, w[:, -2], w[:, -1])), axis=1)
        return emit(self.table, ids, lengths)[0]


def toxic_types(words: list[str], parts: list[Part]) -> np.ndarray:
    """Which word types mark toxic documents, by themselves or by a prefix."""
    size = np.array([len(w) for w in words])
    nt = int(sum(p.y.sum() for p in parts))
    nc = sum(len(p.y) for p in parts) - nt
    toxic = np.zeros(len(words), dtype=bool)
    for n in (None, 4, 5, 6, 7):  # the whole word, then its prefixes
        at = np.arange(len(words)) if n is None else np.flatnonzero(size >= n)
        kind = np.full(len(words), -1)  # number of the word or prefix
        kind[at] = at if n is None else np.unique(np.array([words[i][:n] for i in at], dtype=f"U{n}"), return_inverse=True)[1]
        counts = np.zeros((2, len(words) + 1), dtype=np.int64)  # documents; the last place is that of -1
        for p in parts:
            for ids, y in zip(np.split(p.ids, np.cumsum(p.sizes)[:-1]), p.y):
                counts[y, np.unique(kind[ids])] += 1
        counts[:, -1] = 0
        b, a = counts
        marks = (a >= 2) & ((a + 0.5) / nt >= MIN_RATIO * (b + 0.5) / nc)
        a, b = a[marks], b[marks]
        ea, eb = (a + b) * nt / (nt + nc), (a + b) * nc / (nt + nc)
        marks[marks] = 2 * (a * np.log(a / ea) + b * np.log(np.where(b > 0, b / eb, 1))) >= MIN_G2
        toxic |= marks[kind]
    return toxic


def fit_chain(words: list[str], parts: list[Part], steps: int = 30) -> dict:
    """Weights of the chain. Gradients add up over the parts, so that only the numbers of all words are held."""
    toxic = toxic_types(words, parts)
    feats = word_features(words)
    own, before, behind = feats[:, :-2], feats[:, -2], feats[:, -1]
    seen, n = np.zeros((2, 2)), sum(len(p.ids) for p in parts)
    marked = [toxic[p.ids] & np.repeat(p.y == 1, p.sizes) for p in parts]
    for part, y in zip(parts, marked):
        inner = np.ones(len(y), dtype=bool)
        inner[np.cumsum(part.lengths) - part.lengths] = False
        k = np.flatnonzero(inner)
        seen += np.bincount(2 * y[k - 1].astype(np.int8) + y[k], minlength=4).reshape(2, 2)
    w, t, start, bias = np.zeros(_SIZE + 1), np.zeros((2, 2)), 0.0, -3.0
    gw, gt, gs, gb = np.full(_SIZE + 1, 1e-8), np.full((2, 2), 1e-8), 1e-8, 1e-8
    for step in range(steps):
        table = (w[own].sum(axis=1) + bias, w[before], w[behind])
        by_type, by_before, by_behind = np.zeros((3, len(words)))
        dt, ds, db = seen.copy(), 0.0, 0.0
        for part, y in zip(parts, marked):
            ids = part.ids
            e, k = emit(table, ids, part.lengths)
            p, expected = forward_backward(e, part.lengths, t, start, pairs=True)
            d = y - p
            by_type += np.bincount(ids, weights=d, minlength=len(words))
            by_before += np.bincount(ids[k - 1], weights=d[k], minlength=len(words))
            by_behind += np.bincount(ids[k], weights=d[k - 1], minlength=len(words))
            dt -= expected
            ds += d[np.cumsum(part.lengths) - part.lengths].sum()
            db += d.sum()
        g = np.bincount(own.ravel(), weights=np.repeat(by_type, own.shape[1]), minlength=_SIZE + 1)
        g += np.bincount(before, weights=by_before, minlength=_SIZE + 1)
        g += np.bincount(behind, weights=by_behind, minlength=_SIZE + 1)
        g = g / n - 1e-7 * w
        g[_SIZE] = 0
        dt, ds, db = dt / n, ds / n, db / n
        gw, gt, gs, gb = gw + g * g, gt + dt * dt, gs + ds * ds, gb + db * db
        rate = 0.7
        w += rate * g / np.sqrt(gw)
        t += rate * 0.3 * dt / np.sqrt(gt)
        start += rate * 0.3 * ds / np.sqrt(gs)
        bias += rate * 0.3 * db / np.sqrt(gb)
    return {"weights": w[:_SIZE], "bias": float(bias), "t": t, "start": float(start), "table": (w[own].sum(axis=1) + bias, w[before], w[behind])}


def document_features(p: np.ndarray, words_of: np.ndarray, n: int) -> np.ndarray:
    """Per document: log of 1 + expected toxic words, largest marginal, density. Marginals under FLOOR
    do not add up, so that a long clean text is not toxic by its length."""
    total = np.bincount(words_of, weights=np.where(p >= FLOOR, p, 0.0), minlength=n)
    size = np.bincount(words_of, minlength=n)
    most = np.zeros(n)
    np.maximum.at(most, words_of, p)
    return np.stack((np.log1p(total), most, np.minimum(1, 10 * total / np.maximum(size, 1)), np.ones(n)), axis=1)


def learn(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> dict | None:
    """The model from (doc_id, text) and (doc_id, toxic); None without labels of both kinds."""
    lab = rename_inputs(labels, "doc_id", "toxic").where("toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("y"))
    order = F.xxhash64("doc_id")
    chosen = lab.where("y = 1").orderBy(order).limit(max_rows // 3).unionByName(
        lab.where("y = 0").orderBy(order).limit(max_rows - max_rows // 3))
    # one row with words of each id, so that copies of a repeated id do not all go to the driver
    rows = rename_inputs(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id").where(
        F.col("text").rlike(r"[\p{L}\p{N}]")).groupBy("doc_id", "y").agg(F.min("text").alias("text")).toArrow().sort_by("doc_id")
    number = Numbers()
    parts = parts_of(((t, y) for b in slices(rows.to_batches(), "text")
                      for t, y in zip(b.column("text").to_pylist(), b.column("y").to_pylist())), number)
    del rows
    y = np.concatenate([p.y for p in parts]) if parts else np.empty(0)
    if len(set(y.tolist())) < 2:
        return None
    model = fit_chain(list(number), parts)
    table, features = model.pop("table"), []
    for part in parts:
        p = forward_backward(emit(table, part.ids, part.lengths)[0], part.lengths, model["t"], model["start"])
        features.append(document_features(p, np.repeat(np.arange(len(part.y)), part.sizes), len(part.y)))
    x = np.concatenate(features)
    a = np.zeros(x.shape[1])
    for _ in range(50):
        q = 1 / (1 + np.exp(-(x @ a).clip(-30, 30)))
        h = (x * (q * (1 - q))[:, None]).T @ x + 0.05 * np.eye(len(a))
        a -= np.linalg.solve(h, x.T @ (q - y) + 0.05 * a)
    return model | {"weights": model["weights"].astype(np.float32), "document": a}


def score(docs: DataFrame, model: dict | None, carry: bool = False) -> DataFrame:
    """(doc_id, score, predicted, spans) of every row; with ``carry`` also ``row``, a struct of all columns."""
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emissions = Emissions(model["weights"], model["bias"]) if model else None
        for b in slices(batches, "text"):
            texts = [t or "" for t in b.column("text").to_pylist()]
            values, spans = np.zeros(len(texts)), [[] for _ in texts]
            if model:
                words, lengths, sizes = [], [], []
                for t in texts:
                    w, n = chains(t)
                    words += w
                    lengths += n
                    sizes.append(len(w))
                n = np.array(lengths, dtype=np.int64)
                p = forward_backward(emissions.scores(words, n), n, model["t"], model["start"]) if words else np.empty(0)
                of = np.repeat(np.arange(len(texts)), sizes)
                values = 1 / (1 + np.exp(-(document_features(p, of, len(texts)) @ model["document"]).clip(-30, 30)))
                first = np.cumsum(sizes) - sizes
                hits = np.flatnonzero(p >= 0.5)
                for i in np.unique(of[hits]).tolist():
                    mine = set((hits[of[hits] == i] - first[i]).tolist())
                    found = enumerate(_WORD.finditer(lower_in_place(texts[i])))
                    spans[i] = [{"start": m.start(), "end": m.end()} for k, m in found if k in mine]
            made = [b.column("doc_id"), pa.array(values, pa.float64()), pa.array((values >= 0.5).astype(np.int32)),
                    pa.array(spans, span)]
            yield pa.RecordBatch.from_arrays([*made, *([b.column("row")] if carry else [])],
                                             names=["doc_id", "score", "predicted", "spans"] + ["row"] * carry)

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"),
                      *[F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] * carry)
    ddl = "doc_id long, score double, predicted int, spans array<struct<start:int,end:int>>"
    return map_arrow(src, run, ddl + (f", row {src.schema['row'].dataType.simpleString()}" if carry else ""))


def held_out(doc_id: Column) -> Column:
    return crc_mod(doc_id, 5) == 0


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score, prediction and offending spans of every document, learned from rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = learn(docs, table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"))))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "spans")
