"""Work that is kept whole, and work that does not travel."""

import datetime as dt

from pyspark.sql import functions as F

import star_queries as SQ
from fleetlake.functions import predicates as PR
from fleetlake.operators.batches import in_order, row_index, to_batches
from fleetlake.plans import dossier as DO
from fleetlake.plans import orders as OR
from fleetlake.plans import parts as PA
from fleetlake.plans import reservations as RS
from fleetlake.sources.star import star_tables

SF = "/root/testdata/sf0.001"


def test_chosen_dossier_covers_every_asset(spark):
    found = {r["ativo"]: r["ordens"] for r in SQ.queries()["asset_dossier_chosen"](spark, SF).collect()}
    every = {r["ativo"]: r["ordens"] for r in SQ.queries()["asset_dossier"](spark, SF).collect()}
    assert every and all(found[a] == n for a, n in every.items())
    assert any(a.startswith("NOV") and n == 0 for a, n in found.items())


def test_stored_sections_hold_only_the_columns_read(spark):
    t = star_tables(spark, SF, SQ.DO_VIEWS)
    d = DO.stored_dossier(t, SQ.STAR, columns=SQ._COUNTED)
    assert d["pedidos"].columns == ["ativo", "cod_sap"] and d["ordens"].columns == ["ativo", "ordem", "aufnr_raw"]
    whole = DO.section_counts(DO.asset_dossier(t, SQ.STAR))
    assert sorted(map(tuple, DO.section_counts(d).collect())) == sorted(map(tuple, whole.collect()))


def test_index_keeps_the_asked_columns_in_order(spark):
    rows = spark.createDataFrame([(3, "c", "x"), (1, "a", "y"), (2, "b", None)], "o int, k string, wide string")
    out = row_index(rows, [F.col("o").desc_nulls_first()], index_col="pos", keep=["k"])
    assert "wide" not in out.columns and "o" not in out.columns
    assert sorted((r["pos"], r["k"]) for r in out.collect()) == [(0, "c"), (1, "b"), (2, "a")]


def test_date_range_reads_the_text_once(spark):
    inside = PR.between_days(F.col("d"), 30, 10, dt.date(2024, 3, 1))
    assert str(inside).count("try_to_date") == 1
    days = [(s,) for s in ("20240131", "2024-01-31", "20240130", "20240220", "20240221", "00000000", "nan", "", None, "2024-02-20T23:59:59")]
    got = [r["d"] for r in spark.createDataFrame(days, "d string").where(inside).collect()]
    assert got == ["20240131", "2024-01-31", "20240220", "2024-02-20T23:59:59"]


def test_line_values_come_once(spark):
    lines = spark.createDataFrame([("1", "1"), ("1", "2"), ("2", "1")], "rsnum string, rspos string")
    right = spark.createDataFrame([("1", "1", "v"), ("1", "1", "v"), ("1", "1", None), ("1", "2", None)], "rsnum string, rspos string, creadat string")
    out = RS._line_values(lines, right, "creadat")
    assert sorted(map(tuple, out.collect()), key=str) == sorted([("1", "1", "v"), ("1", "1", None), ("1", "2", None), ("2", "1", None)], key=str)


def test_variants_write_no_forms_out(spark):
    ords = spark.createDataFrame([("A", "000000000012", "12"), ("A", "12", "12"), ("B", "0012", "12")], "ativo string, aufnr_raw string, ordem string")
    rows = spark.createDataFrame([("12",), ("000000000012",), ("0012",), ("012",), ("",), (None,)], "aufnr string")
    met = DO.of_orders(rows, ords, variants=True)
    assert sorted((r["ativo"], r["aufnr"]) for r in met.collect()) == [("A", "000000000012"), ("A", "12"), ("B", "000000000012"), ("B", "0012"), ("B", "12")]
    # each order travels under the key of its forms, not under every form
    assert "lpad" not in met._jdf.queryExecution().analyzed().toString()


def test_rows_of_a_group_in_the_order_of_their_index(spark):
    rows = spark.createDataFrame([(1, 2, "c", None), (1, 0, "a", 1), (1, 1, None, 2), (2, 0, "z", 3)], "g int, i int, k string, v int")
    found = rows.groupBy("g").agg(in_order("i", ["k", "v"]).alias("r"))
    assert {r["g"]: [tuple(x) for x in r["r"]] for r in found.collect()} == {1: [("a", 1), (None, 2), ("c", None)], 2: [("z", 3)]}
    # no lambda that is evaluated for each comparison or row
    batches = to_batches(rows.select("i", "k", "g"), 2, ["g", "i"])
    pages = DO.documents({"ordens": rows.select(F.col("g").alias("ativo"), F.col("i").alias("criada_em"), F.col("k").alias("ordem"))})["ordens"]
    assert not any("lambda" in df._jdf.queryExecution().analyzed().toString() for df in (batches, pages))


def test_suppliers_join_before_the_items(spark):
    t = star_tables(spark, SF, SQ.DO_VIEWS)
    plan = DO.purchase_items(t, SQ.STAR, DO.orders(t, SQ.STAR))._jdf.queryExecution().analyzed().toString()
    # the join with lfa1 lies below the one with the orders' heads
    assert plan.index("= k_ebeln") < plan.index("= v_lifnr")


def test_lines_are_grouped_where_the_join_left_them(spark):
    t = star_tables(spark, SF, SQ.PH_VIEWS)
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    was = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rows = PA._aggregate(PA._consumption(t, SQ.STAR), ["periodo", "ativo", "cod_sap"])
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    above = plan[:plan.index("SortMergeJoin")]
    assert above.count("Exchange hashpartitioning") == 1


def test_blank_orders_of_one_part_are_counted_once(spark):
    heads = [("", "1"), ("0", "1"), ("7", "1")]
    t = {"afih": spark.createDataFrame(heads, "aufnr string, equnr string"),
         "resb": spark.createDataFrame([(" ", "9", 1), ("00", "9", 2), ("", "8", 4), ("7", "9", 8), (None, "9", 16)], "aufnr string, matnr string, bdmng int"),
         "aufk": spark.createDataFrame([("0", "20000101"), ("07", "20000201")], "aufnr string, erdat string")}
    rows = PA._aggregate(PA._consumption(t, SQ.STAR), ["periodo", "ativo", "cod_sap"])
    assert sorted((r["cod_sap"], r["qtd_ocorrencias"], r["qtd_total"]) for r in rows.collect()) == [("8", 2, 8), ("9", 3, 14)]


def test_texts_sort_without_a_lambda(spark):
    rows = spark.createDataFrame([("b",), ("a",), (None,), ("B",), ("a",)], "x string").agg(OR.join_sorted(F.col("x"), " ").alias("t"))
    assert rows.first()["t"] == "B a a b"
    assert "lambda" not in rows._jdf.queryExecution().analyzed().toString()
