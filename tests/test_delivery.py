"""Dossier documents and batch files."""

import json
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

import star_queries as SQ
from fleetlake.operators.batches import (bundle, deliveries, read_delivery, row_index, serialise, to_batches, with_envelope,
                                         write_delivery)
from fleetlake.plans import delivery as DL
from fleetlake.plans import dossier as DO
from fleetlake.plans import orders as OR
from fleetlake.sources.star import star_tables

SF = "/root/testdata/sf0.001"


def test_documents_pages_bounded_and_ordered(spark):
    t = star_tables(spark, SF, SQ.DO_VIEWS)
    assets = spark.createDataFrame([("000000000000000001",), (" 2 ",), ("7",)], "a string")
    sec = DO.asset_dossier(t, SQ.STAR, assets)
    counts = {r["ativo"]: r for r in DO.section_counts(sec).collect()}
    docs = DO.documents(sec, max_items=3)
    for name in ("ordens", "pedidos", "reservas"):
        pages = sorted(docs[name].collect(), key=lambda r: (r["ativo"], r["pagina"]))
        by_asset = {}
        for pg in pages:
            assert 0 < len(pg["itens"]) <= 3
            by_asset.setdefault(pg["ativo"], []).append(pg)
        for a, pgs in by_asset.items():
            assert [p["pagina"] for p in pgs] == list(range(pgs[0]["paginas"]))
            items = [i for p in pgs for i in p["itens"]]
            assert len(items) == counts[a][name]
            key = DO.SECTION_ORDER[name]
            seq = [tuple("" if i[k] is None else str(i[k]) for k in key) for i in items]
            assert seq == sorted(seq)


def test_write_and_read_delivery(spark, tmp_path):
    df = spark.range(0, 12).select(F.col("id").alias("x"), F.lit(1.5).cast("decimal(5,2)").alias("v"))
    path = str(tmp_path / "out")
    b = to_batches(serialise(df, "iso_float"), 5, ["x"])
    assert write_delivery(with_envelope(b), path, "2024-01-01T00:00:00+00:00") == 12
    docs = sorted(read_delivery(spark, path).collect(), key=lambda d: d["batch_index"])
    assert [(d["batch_index"], len(d["rows"]), d["is_last"]) for d in docs] == [(0, 5, False), (1, 5, False), (2, 2, True)]
    assert docs[0]["rows"][0].asDict() == {"x": 0, "v": 1.5} and docs[0]["started_at"].startswith("2024")
    # a second run is read instead of the first; a folder that no manifest row names is never read
    with open(path + "/run=broken", "w") as f:
        f.write("{}")
    none = to_batches(serialise(df.where("id < 0"), "iso_float"), 5, ["x"])
    assert write_delivery(with_envelope(none), path, "2024-01-02T00:00:00+00:00") == 0
    last = read_delivery(spark, path)
    assert [(d["batch_index"], d["rows"], d["is_last"]) for d in last.collect()] == [(0, [], True)]
    assert [f.name for f in last.schema["rows"].dataType.elementType.fields] == ["x", "v"]
    assert sorted(r["rows"] for r in deliveries(spark, path).collect()) == [0, 12]
    with pytest.raises(ValueError, match="no committed delivery"):
        read_delivery(spark, path, "broken")


def test_empty_list_keeps_its_columns(spark, tmp_path):
    df = spark.createDataFrame([], "a string, b double")
    assert write_delivery(df, str(tmp_path / "l"), "2024-01-01T00:00:00+00:00") == 0
    assert read_delivery(spark, str(tmp_path / "l")).columns == ["a", "b"]


def test_order_of_mixed_directions(spark):
    rows = [("a", 1), ("a", None), ("b", 5), (None, 2), ("b", 9), ("a", 7), (None, None)]
    df = spark.createDataFrame(rows, "k string, n int").repartition(4)
    order = [F.col("k").asc_nulls_last(), F.col("n").desc_nulls_first()]
    want = [("a", None), ("a", 7), ("a", 1), ("b", 9), ("b", 5), (None, None), (None, 2)]
    for parts in (1, 3, 9):
        got = row_index(df, order, parts).orderBy("row_idx").collect()
        assert [(r["k"], r["n"]) for r in got] == want and [r["row_idx"] for r in got] == list(range(7))
    batches = to_batches(df, 3, order, payload=[F.col("n").cast("string").alias("n")], counters={"tens": F.col("n") > 4})
    got = sorted(batches.collect(), key=lambda b: b["batch_index"])
    assert [r["n"] for b in got for r in b["rows"]] == [None if n is None else str(n) for _, n in want]
    assert {(b["total"], b["tens"]) for b in got} == {(7, 3)}


@pytest.mark.parametrize("n", [0, 1, 6, 7])
def test_closing_batches_carry_the_totals(spark, n):
    df = spark.range(n)
    for tail in ("none", "final", "trailer"):
        env = with_envelope(to_batches(df, 3, ["id"], tail=tail, counters={"odd": F.col("id") % 2 == 1}), tail).collect()
        last = [b for b in env if b["is_last"]]
        assert len(last) == 1 and sum(len(b["rows"]) for b in env) == n
        if tail == "final":
            assert (last[0]["total"], last[0]["odd"], len(last[0]["rows"])) == (n, n // 2, n % 3)
            assert all(b["total"] is None and b["aviso"] is None for b in env if not b["is_last"])


def test_bundle_pages_two_lists(spark):
    a = spark.range(5).select(F.concat(F.lit("a"), "id").alias("x"))
    b = spark.range(4).select(F.concat(F.lit("b"), "id").alias("y"), "id")
    lists = {"rows": (a, ["x"], [F.col("x")]), "eventos": (b, [F.col("id").desc()], [F.col("y")])}
    pages = sorted(bundle(lists, 3).collect(), key=lambda p: p["pagina"])
    assert [([r["x"] for r in p["rows"]], [r["y"] for r in p["eventos"]]) for p in pages] == [
        (["a0", "a1", "a2"], []), (["a3", "a4"], ["b3"]), ([], ["b2", "b1", "b0"])]
    assert {p["paginas"] for p in pages} == {3}
    none = bundle({n: (df.limit(0), o, c) for n, (df, o, c) in lists.items()}, 3).collect()
    assert [(p["pagina"], p["paginas"], p["rows"], p["eventos"]) for p in none] == [(0, 1, [], [])]


def test_lists_are_written_in_their_order(spark, tmp_path):
    t = star_tables(spark, SF, SQ._MAN_VIEWS)
    for job in ("work_orders", "yard_events"):
        path = str(tmp_path / job)
        write_delivery(DL.job_list(job, t, SQ.STAR), path, "2024-01-01T00:00:00+00:00")
        run = next(f for f in os.listdir(path) if f.startswith("run="))
        lines = [json.loads(x) for f in sorted(os.listdir(f"{path}/{run}")) if f.endswith(".json") for x in open(f"{path}/{run}/{f}")]
        keys = ("ativo", "tipo_manutencao") if job == "work_orders" else ("asset_no", "ts")
        found = [tuple((r[k] is None, r[k] or "") for k in keys) for r in lines]
        assert len(found) > 50 and found == sorted(found)


class Counting(dict):
    """Tables that count how often each is asked for."""

    def __init__(self, t):
        super().__init__(t)
        self.seen = Counter()

    def __getitem__(self, name):
        self.seen[name] += 1
        return super().__getitem__(name)


def test_manifest_runs_the_details_once(spark):
    t = Counting(star_tables(spark, SF, SQ._MAN_VIEWS))
    assert {r["status"] for r in DL.hourly_manifest(spark, t, SQ.STAR).collect()} == {"ok"}
    assert t.seen["afvc"] == t.seen["afvv"] == t.seen["jest"] == 1


def test_block_without_details(spark):
    t = star_tables(spark, SF, SQ._MAN_VIEWS)
    whole, lacking = OR.WorkOrderBlock(t, SQ.STAR), OR.WorkOrderBlock({k: v for k, v in t.items() if k != "afvc"}, SQ.STAR)
    for found, want in ((lacking.rows(), whole.rows()), (lacking.operations(), whole.operations())):
        assert found.schema.simpleString() == want.schema.simpleString()
    assert "missing sources: afvc" in lacking.error and whole.error is None
    assert lacking.operations().count() == 0 and lacking.rows().count() == whole.rows().count()
    manifest = {r["job"]: (r["status"], r["rows"]) for r in DL.hourly_manifest(spark, {k: v for k, v in t.items() if k != "afvc"}, SQ.STAR).collect()}
    assert manifest["work_orders"] == ("ok", whole.rows().count()) and manifest["work_order_operations"] == ("ok", 0)


def test_orders_without_plan_are_spread(spark):
    """Nine orders in ten have no plan: the join to the operations gathers them in no partition."""
    from fleetlake.operators.lookups import spread_nulls, with_salt
    rows = spark.range(20_000).select(F.col("id").cast("string").alias("aufnr"), F.when(F.col("id") % 10 == 0, F.col("id").cast("string")).alias("aufpl"))
    spread = with_salt(rows, ["aufnr"]).select(spread_nulls("aufpl").alias("k")).repartition(16, "k").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in spread) < 3 * 20_000 / 16
