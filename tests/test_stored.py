"""Intermediate results: shuffles end with the statement that needed them, large jobs run in slices."""

import os
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import star_queries as SQ
from compare import digest
from fleetlake.operators import stored
from fleetlake.operators.batches import read_delivery, to_batches, with_envelope, write_delivery
from fleetlake.plans import delivery as DL
from fleetlake.plans import orders as OR
from fleetlake.plans import purchasing as PU
from fleetlake.sources.star import BASE_TABLES, star_tables

SF = "/root/testdata/sf0.001"


@pytest.fixture
def sliced(monkeypatch, caplog):
    """Every file is large: jobs run in steps and slices. Gives how often something was written, by name."""
    monkeypatch.setattr(stored, "SLICE_BYTES", 1)
    monkeypatch.setattr(stored, "MAX_SLICES", 3)
    caplog.set_level("DEBUG", stored.__name__)
    return lambda: Counter(r.args[0] for r in caplog.records if r.name == stored.__name__)


def shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}


def oracle(name):
    c = duckdb.connect()
    for t in BASE_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cur = c.execute(SQ.oracle_sql()[name])
    return digest(cur.fetchall(), [d[0] for d in cur.description])


def found(spark, name):
    df = SQ.queries()[name](spark, SF)
    return digest([tuple(r) for r in df.collect()], df.columns)


def test_shuffles_end_with_the_write(spark):
    before, conf = shuffle_files(spark), spark.conf.get(stored._CLEANUP)
    rows = spark.range(20_000).groupBy((F.col("id") % 500).alias("k")).count()
    kept = stored.store(rows, "counts")
    assert not shuffle_files(spark) - before and spark.conf.get(stored._CLEANUP) == conf
    assert kept.count() == 500 and kept.schema.names == ["k", "count"]


def test_every_row_is_in_one_slice(spark):
    rows = spark.range(300).select(F.when(F.col("id") % 7 > 0, F.col("id") % 40).alias("k"), "id")
    parts = [rows.where(stored.in_slice(4, k, "k")) for k in range(4)]
    assert sorted(r["id"] for p in parts for r in p.collect()) == list(range(300))
    keys = [{r["k"] for r in p.collect()} for p in parts]
    assert sum(map(len, keys)) == len(set().union(*keys)) == 41 and all(keys)


def test_only_large_files_are_cut(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert stored.slices_for(df.join(df, "id")) == 1 and stored.steps_for(df) is stored.whole
    # rows of the driver don't tell their size
    assert stored.slices_for(spark.createDataFrame([(1,)], "a int")) == 1


@pytest.mark.parametrize("name,parts", [
    ("requisition_flow", {"requisition-accounts": 1, "po-lookups": 1, "requisition-orders": 1, "requisitions": 3}),
    ("requisition_envelopes", {"requisition-orders": 1, "requisitions": 3, "requisition_flow": 1}),
    ("picking_reservations", {"reservation-headers": 1, "approvals": 1, "picking-lines": 1, "picking": 3}),
    ("delivery_batches", {"history": 1, "history-lookups": 1, "purchase_history": 1}),
    ("delivery_envelopes", {"po_payment": 1, "parts-sums": 1, "parts_history": 1}),
    ("asset_dossier_pages", {"pedidos": 2}),
    # three attempts of the run, one of the retry, whose sides are written anew
    ("requisition_backfill_rows", {"requisition-orders": 2, "windows": 8}),
    ("run_manifest", {"newest-orders": 1, "purchases": 1, "reservations": 1, "reserved": 1, "operations": 1, "details": 1}),
])
def test_slices_give_the_same_rows(spark, sliced, name, parts):
    assert found(spark, name) == oracle(name)
    assert {k: sliced()[k] for k in parts} == parts


def test_failed_window_in_slices(spark, sliced):
    assert found(spark, "requisition_backfill_ledger") == oracle("requisition_backfill_ledger")


def test_spellings_of_a_key_share_a_slice(spark, sliced):
    """Requisition numbers and reservation numbers that the result no longer tells apart."""
    rows = spark.createDataFrame([("0012",), (" 12",), ("12 ",), ("000",), ("",), (None,), ("7",)], "banfn string")
    parts = stored.store_by_slice(rows, 3, PU._rc_text("banfn"), "spellings")
    kept = [sorted(str(r["banfn"]) for r in x.collect()) for x in parts]
    assert sorted(sum(kept, [])) == sorted(["0012", " 12", "12 ", "000", "", "None", "7"])
    assert any({"0012", " 12", "12 "} <= set(x) for x in kept) and any({"000", "", "None"} <= set(x) for x in kept)
    own = [PU.RequisitionParts(rows, rows, 3, k).own(rows, PU._rc_text("banfn")) for k in range(3)]
    assert [sorted(str(r["banfn"]) for r in x.collect()) for x in own] == kept


def test_reason_is_the_last_cause():
    class Java:
        def __init__(self, text, cause=None):
            self.getMessage, self.getCause = lambda: text, lambda: cause
    e = RuntimeError("An error occurred while calling o1.parquet.")
    assert stored.reason(e) == str(e)
    e.java_exception = Java("task failed", Java("table not readable\nat x"))
    assert stored.reason(e) == "table not readable"
    assert stored.reason(KeyError("missing sources: afvc")) == "missing sources: afvc"


def test_lists_share_the_details(spark):
    asked = Counter()

    class Counting(dict):
        def __getitem__(self, name):
            asked[name] += 1
            return super().__getitem__(name)
    t = Counting(star_tables(spark, SF, SQ._REG["written_order"][0]))
    SQ._written_order(t, SQ.STAR)
    assert asked["afvc"] == asked["afvv"] == asked["jest"] == 1
    assert stored.slices_for(OR.work_order_details(t, SQ.STAR)) == 1


def test_envelopes_are_packed(spark, tmp_path):
    rows = spark.range(12).select(F.col("id").alias("x"))
    write_delivery(with_envelope(to_batches(rows, 5, ["x"])), str(tmp_path / "e"), "2024-01-01T00:00:00+00:00")
    write_delivery(rows, str(tmp_path / "l"), "2024-01-01T00:00:00+00:00")
    ends = {n: {f.split(".", 1)[1] for d in os.listdir(tmp_path / n) if d.startswith("run=") for f in os.listdir(tmp_path / n / d)
                if f.startswith("part-")} for n in ("e", "l")}
    assert ends == {"e": {"json.gz"}, "l": {"json"}}
    assert sorted(r["x"] for d in read_delivery(spark, str(tmp_path / "e")).collect() for r in d["rows"]) == list(range(12))
