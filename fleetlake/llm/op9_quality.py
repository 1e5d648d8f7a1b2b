"""Quality rules: fixed base rules and a hashed n-gram logistic regression.

The classifier is a logistic regression over hashed word 1-grams and character 3- and 4-grams
(per-text relative frequencies), trained on labelled rows and calibrated (Platt) on a held-out part
of them; a fixed threshold on the calibrated probability of good quality gives the verdict. Training
uses at most ``max_rows`` labelled rows, chosen by a hash of the id; everything else reads all rows.
Features are made in the tasks, the driver sees only their sparse counts.

Words are runs of other characters than ASCII white space. A null text has no words. Rows with null
or repeated ids each get a result; labels that are null are not used. Without labels of both kinds
the verdict is the base rules alone. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm.common import map_arrow, record_batch, rename_inputs, slices, table, text_bytes

FEATURE_BITS = 18
MAX_ROWS = 4_000          # labelled rows used for training, half of each label at most
CALIBRATION_SHARE = 5     # one row in five calibrates
MIN_WORDS = 50
MAX_REPEAT_SHARE = 50     # per cent of words in repeated 3-word windows
THRESHOLD = 0.5
SYMBOLS = b"#*$%&|<>"
_L2 = 1e-6


def base_counts(body: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    words = body.split()  # bytes: exactly the ASCII white space
    n = len(words)
    if not n:
        return 0, 0, sum(body.count(s) for s in SYMBOLS), 0, 0
    joined = b"".join(words)
    chars = len(joined) if joined.isascii() else int((np.frombuffer(joined, np.uint8) & 0xC0 != 0x80).sum())
    symbols = sum(joined.count(s) for s in SYMBOLS)
    seen, dup = set(), 0
    for line in body.split(b"\n"):
        if line in seen:
            dup += 1
        elif line and not line.isspace():
            seen.add(line)
    return n, chars, symbols, dup, repeat_words(words)


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more in the text."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), dtype=np.int64, count=n)
    pair = w[:-1] * len(ids) + w[1:]
    if len(ids) < 1 << 20:
        window = pair[:-1] * len(ids) + w[2:]
    else:  # too many words for one 64-bit code: number the pairs first
        window = np.unique(pair, return_inverse=True)[1][:-1] * len(ids) + w[2:]
    order = np.argsort(window, kind="stable")
    equal = window[order][1:] == window[order][:-1]
    twice = np.zeros(n - 2, dtype=bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    return int(np.count_nonzero(np.convolve(twice, [1, 1, 1])))


def _hash(x: np.ndarray, bits: int) -> np.ndarray:
    x = x * np.uint32(0x9E3779B1)
    return (x ^ (x >> np.uint32(15))) >> np.uint32(32 - bits) if bits < 32 else x


def feature_codes(bodies: list[bytes], bits: int = FEATURE_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all texts, one after the other, and the row of each. White space of any
    kind and length counts as one blank, ASCII letters are lower-cased."""
    clean = [b" " + b" ".join(x.lower().split()) + b" " for x in bodies]
    lengths = np.array([len(x) for x in clean])
    b = np.frombuffer(b"".join(clean), dtype=np.uint8).astype(np.uint32)
    row = np.repeat(np.arange(len(clean)), lengths)
    three = b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)
    four = three[:-1] | b[3:] << np.uint32(24)
    # words: a polynomial hash from running sums, read off at the blanks
    power = np.cumprod(np.concatenate(([1], np.full(max(int(lengths.max(initial=1)) - 1, 0), 0x01000193, dtype=np.uint32))), dtype=np.uint32)
    place = np.arange(len(b)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    total = np.cumsum(b * power[place], dtype=np.uint32)
    blanks = np.flatnonzero(b == 32)
    ends = blanks[1:]
    inside = (row[blanks[:-1]] == row[ends]) & (np.diff(blanks) > 1)
    start = blanks[:-1][inside]
    # the start place is divided out by multiplying up to a common power
    inverse = np.cumprod(np.concatenate(([1], np.full(len(power) - 1, pow(0x01000193, -1, 1 << 32), dtype=np.uint32))), dtype=np.uint32)
    word = (total[ends[inside] - 1] - total[start]) * inverse[place[start]]
    ok3, ok4 = row[:-2] == row[2:], row[:-3] == row[3:]
    codes = np.concatenate((_hash(three[ok3] ^ np.uint32(0x5bd1e995), bits), _hash(four[ok4], bits), _hash(word ^ np.uint32(0x1b873593), bits)))
    return codes, np.concatenate((row[:-2][ok3], row[:-3][ok4], row[start]))


def margins(bodies: list[bytes], weights: np.ndarray, bias: float) -> np.ndarray:
    codes, row = feature_codes(bodies)
    n = np.bincount(row, minlength=len(bodies))
    return np.bincount(row, weights=weights[codes], minlength=len(bodies)) / np.maximum(n, 1) + bias


def fit_logistic(rows: np.ndarray, codes: np.ndarray, values: np.ndarray, y: np.ndarray, size: int,
                 steps: int = 60) -> tuple[np.ndarray, float]:
    """Class-balanced logistic regression on sparse rows, by gradient steps with per-feature scaling."""
    w, b = np.zeros(size), 0.0
    g2, gb = np.full(size, 1e-12), 1e-12
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y <= 0).sum(), 1))
    for _ in range(steps):
        z = np.bincount(rows, weights=values * w[codes], minlength=len(y)) + b
        err = (1 / (1 + np.exp(-z.clip(-30, 30))) - (y > 0)) * share
        g = np.bincount(codes, weights=values * err[rows], minlength=size) + _L2 * w
        g2 += g * g
        w -= 4.0 * g / np.sqrt(g2)
        gb += err.sum() ** 2
        b -= 0.3 * err.sum() / np.sqrt(gb)
    return w, float(b)


def platt(z: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of the probability, by Newton steps with smoothed targets."""
    pos, neg = (y > 0).sum(), (y <= 0).sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.stack((z, np.ones_like(z)), axis=1)
    a = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(x @ a).clip(-30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(2)
        a -= np.linalg.solve(h, x.T @ (p - t) + 1e-4 * a)
    return float(a[0]), float(a[1])


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> dict | None:
    """Weights, bias and calibration from labelled rows (doc_id, quality); None without both labels."""
    lab = rename_inputs(labels, "doc_id", "quality").where("quality IN (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("y"))
    order = F.xxhash64("doc_id")
    chosen = lab.where("y = 0").orderBy(order).limit(max_rows // 2).unionByName(lab.where("y = 1").orderBy(order).limit(max_rows // 2))
    # one row of each id, an empty text only if it has no other, so that copies of a repeated id do not all go to the driver
    copies = rename_inputs(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "y", text_bytes().alias("body"))
    src = copies.groupBy("doc_id", "y").agg(F.min(F.struct(F.length("body") == 0, "body")).alias("least")).select(
        "doc_id", "y", F.col("least.body").alias("body"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("y", pa.int32()), ("codes", pa.binary()), ("counts", pa.binary())])
        for b in slices(batches, "body"):
            for doc_id, y, body in zip(b.column("doc_id").to_pylist(), b.column("y").to_pylist(), b.column("body").to_pylist()):
                codes, counts = np.unique(feature_codes([body])[0], return_counts=True)
                yield record_batch(schema, doc_id=[doc_id], y=[y], codes=[codes.astype("<u4").tobytes()],
                                   counts=[counts.astype("<u4").tobytes()])

    data = map_arrow(src, features, "doc_id long, y int, codes binary, counts binary").toArrow()
    if not data.num_rows:
        return None
    data = data.sort_by("doc_id")
    y = data.column("y").to_numpy()
    codes = [np.frombuffer(x, "<u4") for x in data.column("codes").to_pylist()]
    counts = [np.frombuffer(x, "<u4").astype(np.float32) for x in data.column("counts").to_pylist()]
    hold = np.arange(len(y)) % CALIBRATION_SHARE == 0
    if len(set(y[~hold])) < 2:
        return None
    values = [c / max(c.sum(), 1) for c in counts]
    use = np.flatnonzero(~hold)
    w, b = fit_logistic(np.repeat(np.arange(len(use), dtype=np.int32), [len(codes[i]) for i in use]), np.concatenate([codes[i] for i in use]),
                        np.concatenate([values[i] for i in use]), y[use], 1 << FEATURE_BITS)
    z = np.array([values[i] @ w[codes[i]] + b for i in range(len(y))])
    fit = hold if len(set(y[hold])) > 1 else ~hold
    slope, offset = platt(z[fit], y[fit])
    return {"weights": w.astype(np.float32), "bias": b, "slope": slope, "offset": offset}


def score(docs: DataFrame, model: dict | None, threshold: float = THRESHOLD, min_words: int = MIN_WORDS,
          max_repeat: int = MAX_REPEAT_SHARE) -> DataFrame:
    """Base counts, base_failed, the probability of good quality (null without a model) and kept."""
    schema = pa.schema([("doc_id", pa.int64()), *[(n, pa.int64()) for n in
                        ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                        ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("quality", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "body"):
            bodies = b.column("body").to_pylist()
            base = np.array([base_counts(x) for x in bodies], dtype=np.int64).reshape(-1, 5)
            failed = (base[:, 0] < min_words) | (100 * base[:, 4] > max_repeat * base[:, 0])
            p = None
            if model is not None:
                z = margins(bodies, model["weights"], model["bias"]) * model["slope"] + model["offset"]
                p = 1 / (1 + np.exp(-z.clip(-30, 30)))
            kept = ~failed if p is None else ~failed & (p >= threshold)
            yield record_batch(schema, doc_id=b.column("doc_id"), base_failed=failed, kept=kept,
                               quality=p if p is not None else [None] * len(bodies),
                               **{n: base[:, i] for i, n in enumerate(schema.names[1:6])})

    src = rename_inputs(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("body"))
    return map_arrow(src, run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                               "n_repeat_words long, base_failed boolean, kept boolean, quality double")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and classifier verdict of every document, trained on the labelled ones."""
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
