"""The pipeline against a brute-force version, and its queries against their oracles."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from compare import digest
from fleetlake.llm import op1_toxicity, registry
from tests.llm.test_ops import DOCS, brute_classes, brute_lines, odd_rows, prose

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_oracle(spark, con, name):
    df = registry.queries()[name](spark, SF)
    cur = con.execute(registry.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert digest([tuple(r) for r in df.collect()], df.columns) == digest(cur.fetchall(), cols)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - {"op11_divergence"}))  # that one has no ids
def test_query_covers_its_table(spark, name):
    df = registry.queries()[name](spark, SF)
    ids, table = {"op2_warc": ("page_id", "pages"), "op13_centroids": ("vec_id", "embeddings")}.get(name, ("doc_id", "documents"))
    want = {r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(ids).collect()}
    got = {r[0] for r in df.select(ids).collect()}
    assert got <= want if name.startswith("op3") else got == want


def test_pipeline_by_stages(spark, tmp_path):
    rows = [r for r in odd_rows() if r[0] is not None]
    for i in range(200):
        t = prose(70, i) + "\n" + f"footer {i % 12}"
        if i % 8 == 0:
            t = "scumbag vermin " + t.replace(" ", " moronic ", 3)
        rows.append((500 + i, t, "en", "s", len(t)))
    rows += [(900 + i, rows[-1 - i][1] + " tail", "en", "s", 0) for i in range(20)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("extra", F.lit(1))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, int("moronic" in (t or ""))) for i, t, *_ in rows if i >= 500]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    now = docs
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, str(tmp_path))
        now.write.parquet(f"{tmp_path}/out/{name}")
        now = spark.read.parquet(f"{tmp_path}/out/{name}")
        seen[name] = now.collect()
        if name != "packing":
            assert now.columns == docs.columns
    left = [r for r in rows if "moronic" not in (r[1] or "")]
    key = lambda r: (r[0], r[1] or "")
    assert sorted(map(key, seen["toxicity"])) == sorted(map(key, left))
    left = [r for r in left if any(c.isalpha() for c in r[1] or "")]
    assert sorted(map(key, seen["language"])) == sorted(map(key, left))
    want = brute_lines(left)
    assert sum(x[2] for x in want) > 0
    import hashlib
    assert sorted(hashlib.sha256(r.text.encode()).hexdigest() for r in seen["line_dedup"]) == sorted(x[3] for x in want)
    assert all(r.n_chars in (len(r.text), 0) for r in seen["line_dedup"])
    classes = brute_classes([tuple(r) for r in seen["line_dedup"]])
    assert sorted(r.doc_id for r in seen["near_dedup"]) == sorted([*{c for _, c, _ in classes}, 11])  # two texts have id 11
    assert {r.doc_id for r in seen["packing"]} == {r.doc_id for r in seen["near_dedup"]}


def test_run_on_the_smallest_tables(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and {"doc_id", "sequence_id", "offset"} <= set(rows[0].asDict())


def test_pipeline_takes_empty_tables(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert op1_toxicity.learn(spark.createDataFrame([], DOCS), spark.read.parquet(f"{tmp_path}/labels.parquet")) is None


def test_pipeline_keeps_rows_without_id(spark, tmp_path):
    rows = [(None, prose(60, 50 + i), "en", "s", 0) for i in range(6)] + [(None, None, "en", "s", None), (None, prose(60, 50), "en", "s", 0)]
    rows += [(i, prose(60, 80 + i) + " scumbag vermin moronic" * (i % 4 == 0), "en", "s", 0) for i in range(80)]
    docs = spark.createDataFrame(rows, DOCS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(80)] + [(None, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, now, str(tmp_path)).write.parquet(f"{tmp_path}/out/{name}")
        now = spark.read.parquet(f"{tmp_path}/out/{name}")
        bare = now.where("doc_id IS NULL").count()
        # the row without a text goes as und; of the two equal texts one stays
        assert bare == {"toxicity": 8, "language": 7, "line_dedup": 7, "near_dedup": 6, "packing": 6}[name]


def test_language_stage_keeps_the_wanted_languages(spark, tmp_path):
    rows = [(i, prose(60, i).replace("e", "u" if i % 2 else "e"), "aa" if i % 2 else "bb", "s", 0) for i in range(60)]
    docs = spark.createDataFrame(rows, DOCS)
    every = {r.doc_id for r in corpus_pipeline.language(spark, docs, "").collect()}
    only = [{r.doc_id for r in corpus_pipeline.language(spark, docs, "", wanted=[x]).collect()} for x in ("aa", "bb")]
    assert every == set(range(60)) and only[0] | only[1] == every and not only[0] & only[1] and set(range(1, 60, 2)) <= only[0]
    assert corpus_pipeline.language(spark, docs, "", least=1.0).count() == 0
