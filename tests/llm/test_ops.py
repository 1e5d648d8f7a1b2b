"""Each operator on small tables: results by brute force, and nulls, empties, ties, repeated rows,
long texts, empty tables and clashing columns."""

import base64
import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from fleetlake.llm import (op1_toxicity, op2_warc, op3_license, op4_bpe, op5_order_minhash, op6_packing, op7_language,
                           op8_line_dedup, op9_quality, op10_fingerprint)
from fleetlake.llm.tokens import codec, default_vocabulary

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# columns that operators use inside
CLASH = ["k", "k1", "h1", "row", "body", "n", "c", "__k", "range", "ghost", "key", "score", "bands", "th", "class_id", "start"]
RNG = random.Random(7)
VOCABULARY = ["".join(RNG.choice("abcdefghiklmnoprstu") for _ in range(RNG.randint(2, 9))) for _ in range(3000)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCABULARY) + ("." if r.random() < 0.1 else "") + ("\n" if r.random() < 0.03 else "") for _ in range(n))


def odd_rows():
    """Nulls, empties, ties, repeated rows, odd characters, one very long text."""
    base = prose(300, 1)
    rows = [(None, "no id here", "en"), (None, None, None), (1, "", "en"), (2, None, "fr"), (3, base, "en"), (3, base, "en"),
            (4, base, None), (5, "!!! ??? ...", "en"), (6, "一二三 <|endoftext|> a\x00b c \U0001f600", "zh"),
            (7, " \n\t\r\n", "en"), (8, prose(30_000, 2), "en"), (9, "x" * 50_000, "de"), (10, base.replace("a", "e", 3), "en"),
            (11, "word", "en"), (11, "other", "en")]
    return [(i, t, lang, "s", len(t) if t else None) for i, t, lang in rows]


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(odd_rows(), DOCS)
    return df.select("*", *[F.lit(0).alias(c) for c in CLASH])


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def by_id(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


# ---- 1 toxicity ------------------------------------------------------------------------------------------
def toxic_tables(spark, n=400):
    rows, labels = [], []
    for i in range(n):
        text, toxic = prose(60, 100 + i), i % 4 == 0
        if toxic:
            words = text.split(" ")
            for _ in range(4):
                words.insert(RNG.randrange(len(words)), RNG.choice(["moronic", "scumbag", "vermin"]))
            text = " ".join(words)
        rows.append((i, text, "en", "s", len(text)))
        labels.append((i, 1, int(toxic)))
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_learns_held_out_documents_and_marks_the_words(spark):
    docs, labels = toxic_tables(spark)
    model = op1_toxicity.learn(docs, labels.where(~op1_toxicity.held_out(F.col("doc_id"))))
    found = op1_toxicity.score(docs, model).join(docs.select("doc_id", "text"), "doc_id").collect()
    assert all((r.predicted == 1) == (r.doc_id % 4 == 0) == (r.score >= 0.5) for r in found)
    marked = {r.text[s.start:s.end].lower() for r in found for s in r.spans}
    assert marked == {"moronic", "scumbag", "vermin"}


def test_toxicity_odd_rows(spark, odd, none):
    docs, labels = toxic_tables(spark, 120)
    model = op1_toxicity.learn(docs, labels)
    rows = op1_toxicity.score(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    wordless = {r.score for r in rows if r.doc_id in (1, 2, 5, 7)}
    assert len(wordless) == 1 and max(wordless) < 0.5
    assert op1_toxicity.learn(docs, labels.where("toxic = 0")) is None
    assert op1_toxicity.learn(none, labels) is None
    assert {r.score for r in op1_toxicity.score(odd, None).collect()} == {0.0}
    assert op1_toxicity.score(none, model).count() == 0


@pytest.mark.parametrize("learn", [op1_toxicity.learn, op9_quality.train])
def test_training_takes_one_row_of_a_repeated_id(spark, monkeypatch, learn):
    docs, labels = toxic_tables(spark, 60)
    labels = labels.withColumn("quality", F.col("toxic"))
    copies = docs.where("doc_id < 2").crossJoin(spark.range(200).select(F.concat(F.lit("copy "), "id").alias("tail"))).select(
        "doc_id", F.concat("text", F.lit(" "), "tail").alias("text"), "lang", "source", "n_chars")
    taken, to_arrow = [], type(docs).toArrow

    def counted(df):
        out = to_arrow(df)
        taken.append(out.num_rows)
        return out

    monkeypatch.setattr(type(docs), "toArrow", counted)
    empty = docs.where("doc_id < 9").withColumn("text", F.lit(""))
    assert learn(docs.unionByName(copies).unionByName(empty).unionByName(docs), labels, 30) is not None
    assert len(taken) == 1 and taken[0] <= 30


def test_learning_keeps_numbers_of_words(spark, monkeypatch):
    """The driver's Python holds a few bytes a word, and the size of the parts does not change the model."""
    r = random.Random(31)
    texts = [". ".join(" ".join(r.choice(VOCABULARY) for _ in range(20)) for _ in range(50)) for _ in range(500)]
    texts = [t + (". moronic scumbag" if i % 4 == 0 else "") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(len(texts))], "doc_id long, toxic int")
    whole = op1_toxicity.learn(docs, labels)
    monkeypatch.setattr(op1_toxicity, "WORDS", 20_000, raising=False)
    tracemalloc.start()
    model = op1_toxicity.learn(docs, labels)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80 * 1000 * len(texts)
    assert np.allclose(model["weights"], whole["weights"], atol=1e-5) and np.allclose(model["document"], whole["document"])


def test_marginals_of_a_long_sentence_are_those_of_the_whole_chain():
    rng = np.random.default_rng(5)
    lengths = np.array([300, 7, 1, 300, 95])
    e, t, start = rng.normal(size=lengths.sum()), rng.normal(size=(2, 2)), -0.4
    p = op1_toxicity.forward_backward(e, lengths, t, start)
    at = 0
    for n in lengths:  # plain sums over the two states, word by word
        x = np.stack((np.zeros(n), e[at:at + n]), axis=1)
        f, b = np.zeros((n, 2)), np.zeros((n, 2))
        f[0] = np.array([0, start]) + x[0]
        for i in range(1, n):
            f[i] = x[i] + np.logaddexp(f[i - 1, 0] + t[0], f[i - 1, 1] + t[1])
        for i in range(n - 2, -1, -1):
            b[i] = np.logaddexp(t[:, 0] + x[i + 1, 0] + b[i + 1, 0], t[:, 1] + x[i + 1, 1] + b[i + 1, 1])
        q = f + b
        assert np.allclose(p[at:at + n], 1 / (1 + np.exp(q[:, 0] - q[:, 1])))
        at += n


def test_spans_are_places_of_the_text(spark):
    docs, labels = toxic_tables(spark, 200)
    model = op1_toxicity.learn(docs, labels)
    text = "\u0130\u0130\u0130 you moronic one, moronic SCUMBAG \u0130vermin vermin"
    row = op1_toxicity.score(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    marked = [text[s.start:s.end] for s in row.spans]
    assert marked and set(marked) <= {"moronic", "SCUMBAG", "vermin"}
    notice = "\u0130\u0130\u0130\u0130 Licensed under the Apache License, Version 2.0. \u0130"
    hit = op3_license.scan(spark.createDataFrame([(1, notice)], "doc_id long, text string")).first()
    assert notice[hit.start:hit.end] == "Licensed under the Apache License, Version 2.0"


def test_too_many_languages_are_an_error(spark):
    docs = spark.range(12).select(F.lit("some text").alias("text"), F.concat(F.lit("l"), "id").alias("lang"))
    assert len(op7_language.learn(docs, max_languages=12)) == 12
    with pytest.raises(ValueError, match="more than 11 languages"):
        op7_language.learn(docs, max_languages=11)


def test_language_prediction_by_brute_force(spark):
    """Ranks, out-of-place distance and prediction, computed with plain strings."""
    def plain(text):
        out = Counter()
        for word in re.findall(r"[^\W\d_]+", text.lower()):
            for n in (1, 2, 3):
                padded = word if n == 1 else f" {word} "
                out.update(padded[i:i + n] for i in range(len(padded) - n + 1))
        return out

    def code(g):  # the operator's order of equal counts
        cps = [0 if c == " " else ord(c) for c in g]
        value = 0
        for c in cps:
            value = (value << 21) | c
        return (0, value) if len(g) == 1 else (1, value) if len(g) == 2 else (-1, value)

    def ranked(counts, k):
        return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], code(x[0])))][:k]

    rows = [(i, prose(80, 700 + i).replace("e", "u" if i % 2 else "e"), "aa" if i % 2 else "bb") for i in range(24)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    profiles = {lang: ranked(sum((plain(t) for _, t, x in rows[:16] if x == lang), Counter()), 400) for lang in ("aa", "bb")}
    found = {r.doc_id: r for r in op7_language.predict(df, op7_language.learn(df.where("doc_id < 16"))).collect()}
    for i, text, _ in rows:
        mine = ranked(plain(text), 300)
        apart = {lang: sum(min(abs(p.index(g) - k), 400) if g in p else 400 for k, g in enumerate(mine)) for lang, p in profiles.items()}
        best = min(sorted(apart), key=apart.get)
        assert found[i].lang_pred == best and found[i].score == pytest.approx(1 - apart[best] / (400 * len(mine)))


def test_chain_marginals_by_enumeration():
    rng = np.random.default_rng(3)
    lengths = np.array([4, 1, 6, 4])
    e, t, start = rng.normal(size=15), rng.normal(size=(2, 2)), 0.3
    p, pairs = op1_toxicity.forward_backward(e, lengths, t, start, pairs=True)
    at, expected = 0, np.zeros((2, 2))
    for n in lengths:
        weights, ones, two = 0.0, np.zeros(n), np.zeros((2, 2))
        for bits in range(1 << n):
            y = [(bits >> k) & 1 for k in range(n)]
            w = math.exp(start * y[0] + sum(e[at + k] * y[k] for k in range(n)) + sum(t[y[k], y[k + 1]] for k in range(n - 1)))
            weights += w
            ones += w * np.array(y)
            for k in range(n - 1):
                two[y[k], y[k + 1]] += w
        assert np.allclose(p[at:at + n], ones / weights)
        expected += two / weights
        at += n
    assert np.allclose(pairs, expected)


# ---- 2 WARC ----------------------------------------------------------------------------------------------
PAGES = "page_id long, url string, html string"


def expected_pages(rows):
    top = {}
    for i, _, h in rows:
        h = h or ""
        top[h] = max((x for x in (top.get(h), i) if x is not None), default=None)
    out = []
    for i, _, h in rows:
        h = h or ""
        digest = base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()
        revisit = top[h] is not None and i != top[h]
        out.append((i, len(h.encode()), digest, "revisit" if revisit else "response", top[h] if revisit else None))
    return by_id(out)


def page_rows():
    fake = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    return [(1, "u", "<p>é</p>"), (2, None, None), (3, "u\r\nX: y", ""), (4, "u", "<p>é</p>"), (None, "u", "<p>é</p>"),
            (None, "u", "only"), (5, "u", f"head {fake} middle WARC/1.1\r\n {fake}{fake} tail"), (6, "u", "WARC/1.1\r\n" * 50),
            (7, "u", fake), (8, "u", "x" * 200_000 + fake), (9, "u", "\r\n\r\n"), (4, "u", "<p>é</p>")]


@pytest.mark.parametrize("split", ["128m", "2k"])
def test_warc_round_trip(spark, split):
    rows = page_rows() + [(100 + i, "u", prose(30, i)) for i in range(60)]
    path = op2_warc.archive_folder(spark)
    op2_warc.write_warc(spark.createDataFrame(rows, PAGES).withColumn("key", F.lit(1)).repartition(3), path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)  # many splits of one file: pointers jump across them
    try:
        found = op2_warc.page_records(op2_warc.read_warc(spark, path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert by_id(tuple(r) for r in found) == expected_pages(rows)


def test_warc_empty_table(spark):
    path = op2_warc.archive_folder(spark)
    op2_warc.write_warc(spark.createDataFrame([], PAGES), path)
    assert op2_warc.page_records(op2_warc.read_warc(spark, path)).count() == 0


# ---- 3 licenses ------------------------------------------------------------------------------------------
def test_license_hits(spark, odd, none):
    mit, line = op3_license.TEMPLATES["mit"], op3_license.TEMPLATES["gpl-3.0-line"]
    words = mit.split(" ")
    edited = " ".join(w for k, w in enumerate(words) if k % 10)          # nine words in ten are left
    half = " ".join(words[:len(words) // 2])
    noise = prose(400, 5)
    rows = [(1, f"{noise}\n{mit}\n{noise}"), (2, f"{noise} {edited} {noise}"), (3, f"{noise} {half} {noise}"), (4, noise),
            (5, f"{line}\n{line}"), (6, " ".join(reversed(words))), (7, mit.upper())]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    found = {}
    for r in op3_license.scan(df).collect():
        found.setdefault(r.doc_id, []).append(r)
    assert {i: sorted(x.license for x in v) for i, v in found.items()} == {
        1: ["mit"], 2: ["mit"], 5: ["gpl-3.0-line"] * 2, 7: ["mit"]}
    texts = dict(rows)
    assert found[1][0].coverage == 1.0 and texts[1][found[1][0].start:found[1][0].end] == mit.rstrip(".")
    assert 0.85 < found[2][0].coverage < 0.95
    assert op3_license.scan(odd).count() == 0 and op3_license.scan(none).count() == 0


def license_names(text):
    scanner = op3_license.Scanner(op3_license.TEMPLATES, op3_license.COVERAGE)
    return [name for name, *_ in scanner.hits(text)]


def test_license_neighbours_keep_their_names():
    for name, text in op3_license.TEMPLATES.items():
        assert license_names(text) == [name]
        assert license_names(f"{prose(50, 8)} {text} {prose(50, 9)}") == [name]
    assert license_names("Released under the BSD License.") == ["bsd-line"]
    assert license_names("Licensed under CC BY 4.0.") == ["cc-by-4.0-line"]
    assert license_names("Licensed under CC BY-SA 4.0.") == ["cc-by-sa-4.0-line"]
    assert license_names("This work is licensed under the GNU General Public License, version 2.") == ["gpl-2.0-line"]
    assert license_names("This work is licensed under the GNU Lesser General Public License, version 3.") == ["lgpl-3.0-line"]
    assert license_names("Licensed under the Apache License, Version 2") == ["apache-2.0-line"]
    for unknown in ("Released under the Zlib License.", "Licensed under CC BY-NC 3.0.", "Licensed under the Apache License, Version 1.1.",
                    "This work is licensed under the GNU General Public License.", "Licensed under the Foo License, Version 2.0."):
        assert license_names(unknown) == []


def test_license_notices_in_a_row():
    names = list(op3_license.TEMPLATES)
    r = random.Random(3)
    for _ in range(20):
        chosen = r.sample(names, 3)
        assert license_names("\n".join(prose(2, r.random()) + " " + op3_license.TEMPLATES[n] for n in chosen)) == chosen
    assert license_names("Released under the MIT License. Released under the BSD License.") == ["mit-line", "bsd-line"]


def spread_notice(name, length, every):
    """The words of a template without each ``every``-th that identifies nothing, spread evenly over ``length`` words."""
    t = op3_license.words(op3_license.TEMPLATES[name])
    keep = {w for p in op3_license.KEYS.get(name, ()) for w in op3_license.words(p)}
    left = [w for k, w in enumerate(t) if k % every != every // 2 or w in keep]
    out = ["zzz"] * length
    for k, w in enumerate(left):
        out[k * (length - 1) // (len(left) - 1)] = w
    return out, len(left) / len(t)


@pytest.mark.parametrize("name, spread, every", [("mit", 1.0, 6), ("mit", 1.7, 1000), ("mit", 2.0, 10), ("isc", 1.3, 9), ("isc", 2.0, 6),
                                                 ("apache-2.0", 1.1, 6), ("apache-2.0", 2.0, 1000)])
def test_edited_license_notice_at_every_offset(name, spread, every):
    n = len(op3_license.words(op3_license.TEMPLATES[name]))
    notice, coverage = spread_notice(name, int(spread * n), every)
    scanner = op3_license.Scanner(op3_license.TEMPLATES, op3_license.COVERAGE)
    found = set()
    for offset in range(n + 1):
        text = " ".join(["zzz"] * offset + notice + ["zzz"] * (2 * n))
        found |= {(h[0], h[1], h[2] - offset, h[3] - offset) for h in scanner.hits(text)} or {None}
    assert len(found) == 1 and found != {None}
    (license_, got, first, last), = found
    assert license_ == name and got == pytest.approx(coverage, abs=0.03) and 0 <= first <= last < len(notice)


def test_patience_alignment_is_a_common_subsequence():
    r = random.Random(1)
    for _ in range(200):
        a, b = ([r.randrange(12) for _ in range(r.randint(0, 25))] for _ in range(2))
        pairs = op3_license.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    assert op3_license.align(list("abcdef"), list("abXdef")) == [(0, 0), (1, 1), (3, 3), (4, 4), (5, 5)]


# ---- 4 BPE -----------------------------------------------------------------------------------------------
def library_digests(text):
    t = codec(default_vocabulary()).exact
    ids = t.encode(text or "", add_special_tokens=False).ids
    return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def test_bpe_equals_the_library(spark, odd, none):
    passage = prose(200, 9)
    rows = [(i, prose(20, i) + passage + prose(20, 50 + i), "en", "s", 0) for i in range(100, 120)]
    rows += [(200 + i, "x" * i + passage + "ß" * i, "en", "s", 0) for i in range(20)]
    df = odd.select("doc_id", "text", "lang", "source", "n_chars").unionByName(spark.createDataFrame(rows, DOCS))
    # short chunks: many shared ones and many joins
    found = op4_bpe.encode_texts(df, bits=6, min_reuse=8, digest=True).collect()
    assert by_id(tuple(r) for r in found) == by_id((i, *library_digests(t)) for i, t, *_ in odd_rows() + rows)
    whole = op4_bpe.encode_texts(odd).collect()
    assert by_id((r.doc_id, r.decoded) for r in whole) == by_id((i, t or "") for i, t, *_ in odd_rows())
    assert op4_bpe.encode_texts(none).count() == 0


def test_bpe_assembles_from_any_chunks():
    c, r = codec(default_vocabulary()), random.Random(4)
    letters = "ab cé \n\t'st 12,.  "
    for _ in range(300):
        body = "".join(r.choice(letters) for _ in range(r.randint(1, 200))).encode()
        at = op4_bpe.cuts(body, 4)
        assert at[0] == 0 and at[-1] == len(body)
        chunks = [(s, e - s, c.encode(body[s:e].decode())) for s, e in zip(at, at[1:]) if r.random() < 0.7]
        assert op4_bpe.assemble(body, chunks, c).tolist() == c.exact.encode(body.decode(), add_special_tokens=False).ids


def test_codec_agrees_with_the_library_on_odd_texts():
    c, r = codec(default_vocabulary()), random.Random(2)
    letters = "abé ß \n\t  '<>|19.,!…  漢🙂\x1c\x85́٠"
    for _ in range(500):
        text = "".join(r.choice(letters) for _ in range(r.randint(0, 60))) + r.choice(["", "<|endoftext|>"])
        assert c.encode(text).tolist() == c.exact.encode(text, add_special_tokens=False).ids


# ---- 5 near duplicates -----------------------------------------------------------------------------------
def near_rows():
    rows, r = [], random.Random(11)
    for g in range(6):
        base = prose(220, 1000 + g).split(" ")
        for k in range(30 if g == 0 else 3):           # one group fills large buckets
            copy = list(base)
            for _ in range(k % 4):
                copy[r.randrange(len(copy))] = r.choice(VOCABULARY)
            rows.append((len(rows), " ".join(copy)))
    passage = prose(120, 77)
    rows += [(len(rows) + k, passage + " " + prose(100, 2000 + k)) for k in range(40)]  # share half, no duplicates
    return [(i, t, "en", "s", len(t)) for i, t in rows]


def brute_classes(rows):
    sets = [op5_order_minhash.labels(t) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] or "") == (rows[j][1] or "") or op5_order_minhash.aligned(sets[j], sets[i]) >= 0.8:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i), []).append(r[0])
    return by_id((i, min((x for x in g if x is not None), default=None), len(g)) for g in groups.values() for i in g)


def test_near_duplicate_classes(spark, odd, none):
    rows = near_rows()
    found = op5_order_minhash.near_duplicates(spark.createDataFrame(rows, DOCS)).select("doc_id", "class_id", "class_size")
    assert by_id(tuple(r) for r in found.collect()) == brute_classes(rows)
    found = op5_order_minhash.near_duplicates(odd).select("doc_id", "class_id", "class_size").collect()
    assert by_id(tuple(r) for r in found) == brute_classes(odd_rows())
    assert op5_order_minhash.near_duplicates(none).count() == 0


def test_keep_one_of_each_class(spark, odd, none):
    rows = near_rows()
    kept = op5_order_minhash.keep_one(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(r.doc_id for r in kept) == sorted({c for _, c, _ in brute_classes(rows)})
    kept = op5_order_minhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([None, 1, 3, 5, 6, 7, 8, 9, 11, 11], key=str)
    assert op5_order_minhash.keep_one(none).count() == 0


def test_alignment_is_the_longest_common_run():
    r = random.Random(5)
    for _ in range(100):
        a = prose(120, r.random()).split(" ")
        b = list(a)
        for _ in range(r.randint(0, 4)):
            b[r.randrange(len(b)):][:1] = [r.choice(VOCABULARY)]
            b[r.randrange(len(b))] = r.choice(VOCABULARY)
        x, y = (op5_order_minhash.labels(" ".join(w)) for w in (a, b))
        row = np.zeros(len(y) + 1, dtype=int)
        for v in x:
            new = row.copy()
            for j, w in enumerate(y):
                new[j + 1] = row[j] + 1 if v == w else max(row[j + 1], new[j])
            row = new
        exact = row[-1] / (len(x) + len(y) - row[-1])
        got = op5_order_minhash.aligned(x, y)
        assert got == pytest.approx(exact) if exact >= 0.8 else got < 0.8


def longest_common(x, y):
    row = [0] * (len(y) + 1)
    for v in x:
        new = [0]
        for j, w in enumerate(y):
            new.append(row[j] + 1 if v == w else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_pairs_at_exactly_the_limit(spark):
    for k in range(1, 25):
        a = prose(5 * k + 4, 4000 + k).split(" ")          # 5 k labels, 4 k of them in the copy: 4/5
        for b in (a[k:], a[:-k], a[k // 2:len(a) - (k - k // 2)]):
            x, y = (op5_order_minhash.labels(" ".join(w)) for w in (a, b))
            assert 5 * longest_common(x.tolist(), y.tolist()) == 4 * len(x) == 20 * k
            assert op5_order_minhash.aligned(x, y) == op5_order_minhash.aligned(y, x) == 0.8
            fewer = op5_order_minhash.labels(" ".join(b[1:]))
            assert op5_order_minhash.aligned(x, fewer) < 0.8
    text = prose(54, 12).split(" ")
    rows = [(1, " ".join(text), "en", "s", 0), (2, " ".join(text[10:]), "en", "s", 0)]
    found = op5_order_minhash.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r.doc_id, r.class_id, r.class_size) for r in found) == [(1, 1, 2), (2, 1, 2)]


def plain_labels(text):
    """Occurrence-labelled five-word shingles as tuples."""
    words = re.findall(r"[^\W_]+", (text or "").lower())
    seen = Counter()
    out = []
    for k in range(max(1, len(words) - 4) if words else 0):
        s = tuple(words[k:k + 5])
        seen[s] += 1
        out.append((s, seen[s]))
    return out


def plainly_similar(x, y):
    """Similarity of 0.8 or more by a full alignment that shares no code with the operator."""
    if not x or not y:
        return False
    common = len(set(x) & set(y))
    if 10 * common < 8 * (len(x) + len(y) - common):
        return False
    at = {v: i for i, v in enumerate(y)}
    places, best = [at[v] for v in x if v in at], []
    for i, p in enumerate(places):  # longest increasing run by plain dynamic programming
        best.append(1 + max((best[j] for j in range(i) if places[j] < p), default=0))
    length = max(best)
    return 10 * length >= 8 * (len(x) + len(y) - length)


def plain_classes(texts):
    sets = [plain_labels(t) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if find(i) != find(j) and (texts[i] == texts[j] or plainly_similar(sets[i], sets[j])):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


def crowd(n=260, seed=9):
    """Copies of one text that is not among them, most with several words changed; many share one of a few
    changes, some differ from another copy by one word; and texts that share a long passage."""
    r = random.Random(seed)
    base = prose(100, seed).split(" ")
    common = [(r.randrange(100), r.choice(VOCABULARY)) for _ in range(6)]
    texts = []
    for i in range(n):
        w = list(texts[r.randrange(len(texts))].split(" ")) if texts and i % 6 == 0 else list(base)
        for _ in range(r.randint(1, 5)):
            w[r.randrange(100)] = r.choice(VOCABULARY)
        if i % 3 == 0:
            k, word = r.choice(common)
            w[k] = word
        texts.append(" ".join(w))
    passage = prose(60, seed + 1)
    return texts + [prose(25, 10_000 + i) + " " + passage + " " + prose(25, 20_000 + i) for i in range(40)]


@pytest.mark.parametrize("small, hubs, told", [(16, 256, 1_000_000), (3, 4, 1_000_000), (3, 64, 0)])
def test_crowded_buckets_lose_no_link(spark, monkeypatch, small, hubs, told):
    monkeypatch.setattr(op5_order_minhash, "SMALL", small)
    monkeypatch.setattr(op5_order_minhash, "HUBS", hubs)
    monkeypatch.setattr(op5_order_minhash, "TOLD", told)
    texts = crowd()
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    found = {r.doc_id: r.class_id for r in op5_order_minhash.near_duplicates(spark.createDataFrame(rows, DOCS).repartition(4)).collect()}
    want = plain_classes(texts)
    assert len(set(want)) > 20 and [found[i] for i in range(len(texts))] == want


def test_labels_of_crowded_buckets_become_rows_once(spark, monkeypatch):
    """All label rows that are made, over every plan that runs, are those of the listed labels, once."""
    frame = type(spark.range(0))
    made, listed = [], []
    to_arrow, store = frame.toArrow, op5_order_minhash.cut_lineage

    def count(df):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        made.append(plan.count("Generate explode(labels"))

    def stored(df):
        count(df)
        out = store(df)
        if {"labels", "near"} <= set(out.columns):
            listed.append(out.agg(F.sum(F.size("labels")), F.count("*")).first())
        return out

    monkeypatch.setattr(op5_order_minhash, "cut_lineage", stored)
    monkeypatch.setattr(frame, "toArrow", lambda df: (count(df), to_arrow(df))[1])
    texts = crowd()
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    assert op5_order_minhash.near_duplicates(spark.createDataFrame(rows, DOCS)).count() == len(texts)
    assert len(listed) == 2 and listed[0][0] > 0 and sum(n for _, n in listed) <= len(texts)
    assert sum(x or 0 for x, _ in listed) <= sum(len(op5_order_minhash.labels(t)) for t in texts)
    assert sum(made) == 2  # one for each of the two tables


def test_marks_bound_what_two_texts_share():
    r = random.Random(3)
    for _ in range(200):
        words = prose(r.randint(5, 400), r.random()).split(" ")
        x = op5_order_minhash.labels(" ".join(words))
        y = op5_order_minhash.labels(" ".join(words[r.randrange(40):] + prose(r.randint(1, 200), r.random()).split(" ")))
        differ = sum(int(i ^ j).bit_count() for i, j in zip(*(op5_order_minhash.marks(z).view(np.uint64).tolist() for z in (x, y))))
        apart = len(x) + len(y) - 2 * len(np.intersect1d(x, y))
        assert differ <= apart and (apart > 100 or differ >= apart / 2) and len(op5_order_minhash.marks(x)) == op5_order_minhash.MARKS


def test_rows_of_crowded_buckets_stay_narrow(spark, monkeypatch):
    """Rows that are dealt by bucket bring a few words for a node, not all its labels."""
    wide, store = [], op5_order_minhash.cut_lineage

    def stored(df):
        out = store(df)
        longs = [f.name for f in out.schema if f.dataType.simpleString() == "array<bigint>"]
        if longs and {"bucket", "n"} <= set(out.columns):
            wide.append(out.agg(*[F.max(F.size(x)).alias(x) for x in longs]).first())
        return out

    monkeypatch.setattr(op5_order_minhash, "cut_lineage", stored)
    monkeypatch.setattr(op5_order_minhash, "SMALL", 3)
    texts = crowd(60)
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    found = {r.doc_id: r.class_id for r in op5_order_minhash.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()}
    want = plain_classes(texts)
    assert [found[i] for i in range(len(texts))] == want
    assert wide and 0 < max(x or 0 for row in wide for x in row) <= op5_order_minhash.MARKS < max(len(plain_labels(t)) for t in texts)


def test_later_links_join_the_classes_there_are(spark):
    old, new = [(1, 2), (2, 3), (5, 6), (8, 9)], [(3, 6), (9, 11), (20, 21), (6, 1)]
    first = op5_order_minhash.components(spark.createDataFrame(old, "a long, b long"))
    both = op5_order_minhash._joined(first, spark.createDataFrame(new, "a long, b long"))
    want = op5_order_minhash.components(spark.createDataFrame(old + new, "a long, b long"))
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, want.collect()))
    assert sorted(map(tuple, both.collect())) == [(1, 1), (2, 1), (3, 1), (5, 1), (6, 1), (8, 8), (9, 8), (11, 8), (20, 20), (21, 20)]
    many = spark.range(0, 100, 1, 50)
    assert len(op5_order_minhash.cut_lineage(op5_order_minhash.in_files(many, 100)).inputFiles()) == 1


def test_told_labels_are_looked_up():
    told = np.sort(op5_order_minhash.labels(prose(300, 1)).view(np.int64))
    texts = [prose(300, 1), prose(200, 2), ""]
    batch = pa.RecordBatch.from_pylist([{"n": i, "packed": zstandard.compress(t.encode()), "places": [{"bucket": 1, "core": b""}]} for i, t in enumerate(texts)])
    for some in (told[::2], told[:1], told[:0]):
        every = next(op5_order_minhash._profiles(0.8, None)([batch])).column("labels").to_pylist()
        got = next(op5_order_minhash._profiles(0.8, some)([batch])).column("labels").to_pylist()
        assert got == [[x for x in row if x in set(some.tolist())] for row in every]


def test_recall_on_documents(spark):
    """Ids divisible by 10 against all rows, aligned plainly."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, plain_labels(r.text), r.text or "") for r in docs.select("doc_id", "text").collect()]
    classes = {r.doc_id: r.class_id for r in op5_order_minhash.near_duplicates(docs).collect()}
    links = [(a, b) for a, x, s in rows if a % 10 == 0 for b, y, t in rows if a != b and (s == t or plainly_similar(x, y))]
    assert len(links) >= 15 and sum(classes[a] == classes[b] for a, b in links) >= 0.9 * len(links)


def test_sketches_depend_on_order():
    a = op5_order_minhash.labels(prose(200, 3))
    flipped = a[::-1].copy()
    same = (op5_order_minhash.sketch(a) == op5_order_minhash.sketch(flipped)).sum()
    assert same == 0 and op5_order_minhash.aligned(a, flipped) < 0.8


# ---- 6 packing -------------------------------------------------------------------------------------------
def test_packing(spark, odd, none):
    rows = odd_rows() + [(1000 + i, prose(RNG.randint(1, 900), i), "en", "s", 0) for i in range(150)]
    df = odd.select("doc_id", "text").unionByName(spark.createDataFrame(rows[len(odd_rows()):], DOCS).select("doc_id", "text"))
    parts = op6_packing.pieces(df)
    for group in (50_000, 60):
        found = op6_packing.pack_pieces(parts, group=group).collect()
        c, expected = codec(default_vocabulary()), []
        for i, t, *_ in rows:
            ids = np.append(c.exact.encode(t or "", add_special_tokens=False).ids, 0).astype("<u4")
            head = len(ids) % 2048 if len(ids) > 2048 else 0
            ends = [0, *range(head, len(ids) + 1, 2048)] if len(ids) > 2048 else [0, len(ids)]
            ends = sorted(set(ends))
            expected += [(i, k, s, e - s, zlib.crc32(ids[s:e].tobytes())) for k, (s, e) in enumerate(zip(ends, ends[1:]))]
        assert by_id(tuple(r)[:5] for r in found) == by_id(expected)
        bins = {}
        for r in found:
            bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for b in bins.values():
            at = 0
            for offset, length in sorted(b):
                assert offset == at
                at += length
            assert at <= 2048
        if group == 50_000:
            assert len(bins) <= math.ceil(sum(r.length for r in found) / 2048) + 2
    assert op6_packing.pack_pieces(op6_packing.pieces(none)).count() == 0


def test_sum_of_squares_picks_the_smallest_sum():
    r = np.random.default_rng(1)
    for _ in range(20):
        sizes, capacity = r.integers(1, 30, 60), 30
        got = op6_packing.sum_of_squares(sizes, capacity)
        fill = {}
        for k, (s, b) in enumerate(zip(sizes.tolist(), got.tolist())):
            def total(bin_):
                gaps = Counter(capacity - v for x, v in {**fill, bin_: fill.get(bin_, 0) + s}.items() if 0 < v < capacity)
                return sum(n * n for n in gaps.values())
            options = [x for x, v in fill.items() if v + s <= capacity and v < capacity] + [-1]
            assert total(b) == min(total(x) for x in options), k
            fill[b] = fill.get(b, 0) + s


# ---- 7 language ------------------------------------------------------------------------------------------
def test_language(spark, odd, none):
    kinds = {"aa": "abcdefg", "bb": "fghijkl", "cc": "klmnopé"}
    rows = []
    for i in range(240):
        lang = list(kinds)[i % 3]
        r = random.Random(i)
        rows.append((i, " ".join("".join(r.choice(kinds[lang]) for _ in range(r.randint(2, 8))) for _ in range(40)), lang, "s", 0))
    docs = spark.createDataFrame(rows, DOCS)
    profiles = op7_language.learn(docs.where(~op7_language.held_out(F.col("doc_id"))))
    assert sorted(profiles) == list(kinds)
    found = {r.doc_id: r for r in op7_language.predict(docs, profiles).collect()}
    assert all(found[i].lang_pred == lang and 0 < found[i].score <= 1 for i, _, lang, *_ in rows)
    rows = op7_language.predict(odd, profiles).collect()
    assert len(rows) == odd.count()
    und = [r for r in rows if r.lang_pred == "und"]
    assert sorted((r.doc_id for r in und), key=str) == [1, 2, 5, 7, None] and {r.score for r in und} == {0.0}
    assert {r.lang_pred for r in op7_language.predict(odd, op7_language.learn(none)).collect()} == {"und"}
    assert op7_language.predict(none, profiles).count() == 0


def test_ngram_counts_by_brute_force():
    text = "Ab, éa ab!"
    codes, counts = op7_language.grams(text)
    words, expected = ["ab", "éa", "ab"], Counter()
    blank = "\x00"
    joined = blank + blank.join(words) + blank
    for n in (1, 2, 3):
        for k in range(len(joined) - n + 1):
            g = joined[k:k + n]
            if g.strip(blank) and blank not in g.strip(blank) and not (n == 3 and g[1] == blank):
                expected[g] += 1
    assert sorted(counts.tolist()) == sorted(expected.values()) and len(codes) == len(expected)


# ---- 8 line dedup ----------------------------------------------------------------------------------------
def brute_lines(rows, min_docs=10):
    key = lambda x: re.sub(r"^[\x20\x09-\x0d]+|[\x20\x09-\x0d]+$", "", x).translate({c: c + 32 for c in range(65, 91)})
    docs = {}
    for i, t, *_ in rows:
        for x in (t or "").split("\n"):
            if key(x):
                docs.setdefault(key(x), set()).add(i if i is not None else ("null", t))
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(docs.get(key(x), ())) < min_docs]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return by_id(out)


def test_line_dedup(spark, odd, none):
    rows = []
    for i in range(300):
        r = random.Random(i)
        lines = ["Everywhere line "] * r.randint(1, 3) + [f"shared {r.randrange(40)}" for _ in range(4)] + [f"own {i}", "", " \t"]
        r.shuffle(lines)
        rows.append((i, "\n".join(lines).replace("shared", "SHARED" if i % 2 else "shared"), "en", "s", 0))
    rows += rows[:5] + [(None, "everywhere line\nnull id", "en", "s", 0)] * 2
    df = odd.select("doc_id", "text").unionByName(spark.createDataFrame(rows, DOCS).select("doc_id", "text"))
    want = brute_lines(odd_rows() + rows)
    for parts in (1, 4, 23):  # runs that cross many tasks
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = op8_line_dedup.drop_lines(df, op8_line_dedup.line_keep_bitmaps(df), digest=True).collect()
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        assert by_id(tuple(r) for r in got) == want
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert op8_line_dedup.drop_lines(none, op8_line_dedup.line_keep_bitmaps(none), digest=True).count() == 0


def line_runs(rows, size, **more):
    """What one task emits for sorted (hash, doc_id, pos) rows in batches of ``size``."""
    schema = op8_line_dedup._LINES
    h, doc, pos = (list(c) for c in zip(*rows))
    whole = op8_line_dedup.record_batch(schema, h1=h, h2=h, doc_id=doc, th=[0] * len(h), pos=pos)
    run = op8_line_dedup._stream_runs(10, **more)
    return [b for b in run(whole.slice(i, size) for i in range(0, len(h), size)) if b.num_rows]


@pytest.mark.parametrize("first_doc", [11, 9_000])
@pytest.mark.parametrize("keep_first", [False, True])
def test_long_line_run_is_sent_once(first_doc, keep_first):
    run = [(5, 0, p) for p in range(first_doc)] + [(5, d, p) for d in range(1, 3001) for p in range(10)]
    few = [(7, d, p) for d in range(3) for p in range(9_000)]
    rows = [(4, 0, 0)] + run + few + [(9, 0, 0)]
    out = line_runs(rows, 2_000, keep_first=keep_first)
    sent = Counter((h, d, p) for b in out for h, d, p in zip(*(b.column(c).to_pylist() for c in ("h1", "doc_id", "pos"))))
    assert max(sent.values()) == 1
    dropped = {x for x in sent if x[0] == 5}
    assert dropped >= set(run[keep_first:])
    edges = {(h, d, p) for b in out for h, d, p, e in zip(*(b.column(c).to_pylist() for c in ("h1", "doc_id", "pos", "edge"))) if e}
    assert {x for x in sent if x[0] == 7} <= edges                      # undecided, never dropped here
    assert max(b.num_rows for b in out) <= 8_000


@pytest.mark.parametrize("keep_first", [False, True])
def test_long_runs_of_few_documents(spark, keep_first):
    rows = [(i, "\n".join(["}"] * (9_000 if i == 0 else 400)) + f"\nown {i}", "en", "s", 0) for i in range(40)]
    rows += [(100 + i, "\n".join(["few"] * 7_000), "en", "s", 0) for i in range(3)]
    df = spark.createDataFrame(rows, DOCS)
    out = op8_line_dedup.drop_lines(df, op8_line_dedup.line_keep_bitmaps(df, keep_first=keep_first))
    want = [(i, "}\nown 0" if keep_first and i == 0 else f"own {i}") for i in range(40)] + [(r[0], r[1]) for r in rows[40:]]
    assert sorted((r.doc_id, r.text) for r in out.collect()) == want


def test_line_dedup_keeps_first_and_columns(spark, odd):
    rows = [(i, f"a\nown {i}\nb", "en", "s", 0) for i in range(30)]
    df = spark.createDataFrame(rows, DOCS).withColumn("keep", F.lit("x"))
    out = op8_line_dedup.drop_lines(df, op8_line_dedup.line_keep_bitmaps(df, keep_first=True))
    assert out.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in out.collect()) == [(0, "a\nown 0\nb"), *[(i, f"own {i}") for i in range(1, 30)]]
    same = op8_line_dedup.drop_lines(odd, op8_line_dedup.line_keep_bitmaps(odd))
    assert same.columns == odd.columns and by_id((r.doc_id, r.text) for r in same.collect()) == by_id((r[0], r[1]) for r in odd_rows())


# ---- 9 quality -------------------------------------------------------------------------------------------
def brute_base(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if n[x] > 1:
            covered.update((i, i + 1, i + 2))
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def test_quality(spark, odd, none):
    rows = [(i, prose(80, i) if i % 3 else re.sub(" ", "*** ", prose(80, i)), "en", "s", 0) for i in range(300)]
    rows.append((1000, "a b c a b c\nx\nx\n é # | <>\n" * 3, "en", "s", 0))
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(200)] + [(250, None, None)], "doc_id long, quality int, toxic int")
    model = op9_quality.train(docs, labels)
    got = {r.doc_id: r for r in op9_quality.score(docs, model).collect()}
    for i, t, *_ in rows:
        r, base = got[i], brute_base(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base
        assert r.base_failed == (base[0] < 50 or 100 * base[4] > 50 * base[0])
        if i < 300:
            assert r.base_failed or r.kept == (i % 3 > 0)
    for m in (model, None):
        rows = op9_quality.score(odd, m).collect()
        assert by_id((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows) == by_id(
            (i, *brute_base(t)) for i, t, *_ in odd_rows())
        assert not any(r.kept for r in rows if r.base_failed)
    assert op9_quality.train(none, labels) is None and op9_quality.train(docs, labels.where("quality = 1")) is None
    assert op9_quality.score(none, model).count() == 0


# ---- 10 fingerprints -------------------------------------------------------------------------------------
def test_fingerprints(spark, odd, none):
    rows = [r for r in odd_rows() if r[0] is not None] + [(100 + i, prose(50, i), "en", "s", 0) for i in range(40)]
    rows.sort(key=lambda r: (r[0], (r[1] or "").encode()))
    bare = [r for r in odd_rows() if r[0] is None]
    df = spark.createDataFrame(rows + bare, DOCS).repartition(5)
    expected = []
    for k, (i, t, *_) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1] or ""
        expected.append((i, len(t or ""), hashlib.sha256(op10_fingerprint.edited(t or "", nxt).encode()).hexdigest()))
    expected += [(None, len(t or ""), hashlib.sha256(op10_fingerprint.edited(t or "", t or "").encode()).hexdigest()) for _, t, *_ in bare]
    for size in (5_000, 7):
        got = op10_fingerprint.fingerprint_pairs(df, size).collect()
        assert by_id((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == by_id(expected)
        prints = {}
        for r in got:
            prints.setdefault(r.fingerprint, set()).add(r.n_chars)
            assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
            assert (r.near_edited == 1) == (r.fingerprint == r.edited_fingerprint)
        assert len(prints) == len({t or "" for _, t, *_ in rows + bare})
    assert op10_fingerprint.fingerprint_pairs(odd).count() == len(odd_rows())
    assert op10_fingerprint.fingerprint_pairs(none).count() == 0


def test_tree_locates_the_edit():
    lines = [prose(12, 3000 + i).replace("\n", "") for i in range(60)]
    a = op10_fingerprint.Tree("\n".join(lines).encode())
    lines[31] += " changed"
    b = op10_fingerprint.Tree("\n".join(lines).encode())
    assert op10_fingerprint.differences(a, b) == [(31, 32, 31, 32)] and op10_fingerprint.differences(a, a) == []
    assert 0.9 < op10_fingerprint.likeness(a.fingerprint(), b.fingerprint()) < 1
    assert op10_fingerprint.likeness(a.fingerprint(), op10_fingerprint.Tree(b"").fingerprint()) == 0


def test_edits_rebuild_the_other_text():
    """Paragraphs added, dropped, doubled, moved and changed: the edits turn one text into the other."""
    r = random.Random(4)
    for k in range(300):
        lines = [prose(4, r.randrange(40)).replace("\n", " ") for _ in range(r.randint(0, 40))]
        other = list(lines)
        for _ in range(r.randint(0, 4)):
            at = r.randint(0, len(other))
            kind = r.randrange(4)
            if kind == 0:
                other.insert(at, prose(3, 900 + k))
            elif other and kind == 1:
                del other[r.randrange(len(other))]
            elif other and kind == 2:
                other.insert(at, r.choice(other))
            elif other:
                other.insert(r.randrange(len(other)), other.pop())
        x, y = "\n".join(lines), "\n".join(other)
        found = op10_fingerprint.differences(op10_fingerprint.Tree(x.encode()), op10_fingerprint.Tree(y.encode()))
        mine, theirs = (t.split("\n") if t else [] for t in (x, y))
        assert (found == []) == (x == y)
        for i, j, m, n in reversed(found):
            mine[i:j] = theirs[m:n]
        assert mine == theirs


def test_likeness_counts_shared_leaves():
    r = random.Random(8)
    for _ in range(60):
        x, y = (". ".join(prose(3, r.randrange(6)).replace("\n", " ") for _ in range(r.randint(0, 12))) for _ in range(2))
        leaves = [Counter(m.group() for line in t.split("\n") if t for m in re.finditer(op10_fingerprint._PIECE.pattern.decode(), line)) for t in (x, y)]
        total = sum(leaves[0].values()) + sum(leaves[1].values())
        want = 1.0 if x == y else 2 * sum((leaves[0] & leaves[1]).values()) / total if min(map(len, leaves)) else 0.0
        a, b = (op10_fingerprint.Tree(t.encode()).fingerprint() for t in (x, y))
        assert op10_fingerprint.likeness(a, b) == pytest.approx(min(want, 0.999999) if x != y else 1.0)


def test_query_gives_the_edits(spark):
    rows = [(1, "one line.\ntwo lines.\nthree lines.\nfour lines.", "en", "s", 0), (2, "other.\ntext here.", "en", "s", 0), (3, None, "en", "s", 0)]
    found = {r.doc_id: [tuple(e) for e in r.edits] for r in op10_fingerprint.fingerprint_pairs(spark.createDataFrame(rows, DOCS)).collect()}
    assert found[1][0][1] == 4 and found[3] == []
