"""More golden rows: parts history periods and fan-out, stock labels,
approval order, backfill writes, key guard."""

import datetime as dt
from decimal import Decimal

from fleetlake.functions.keys import require_keys
from fleetlake.operators.batches import clean_fields
from fleetlake.params import Params
from fleetlake.plans import parts as PA
from fleetlake.plans import reservations as RS

P = Params(as_of=dt.date(2024, 12, 1), parts_first_year=2024)


def parts_tables(spark):
    return {
        "afih": spark.createDataFrame([("000000000101", "000000000000000007"), ("000000000102", "7"),
                                       ("000000000103", "")], "aufnr string, equnr string"),
        "resb": spark.createDataFrame([("101", "00000055", Decimal("2.000")), ("0102", "55", Decimal("3.000")),
                                       ("103", "55", Decimal("9.000")), ("101", "", Decimal("1.000"))],
                                      "aufnr string, matnr string, bdmng decimal(13,3)"),
        "aufk": spark.createDataFrame([("000000000101", "20240115"), ("000000000102", "2024-08-02"),
                                       ("000000000103", "20240301")], "aufnr string, erdat string"),
        # texts in both P and PT: collapse must not double the sum (S-11)
        "eqkt": spark.createDataFrame([("7", "P", "Asset"), ("0007", "PT", "Ativo")],
                                      "equnr string, spras string, eqktx string"),
        "makt": spark.createDataFrame([("55", "P", "Part"), ("055", "PT", "Peca")],
                                      "matnr string, spras string, maktx string"),
        "mara": spark.createDataFrame([("55", "G1")], "matnr string, matkl string"),
    }


def test_parts_history_periods_and_collapse(spark):
    t = parts_tables(spark)
    got = sorted((r["periodo"], r["ativo"], r["cod_sap"], float(r["qtd_total"]), r["qtd_ocorrencias"],
                  r["descricao_ativo"]) for r in PA.parts_history(t, P).collect())
    # order 103 has a blank asset and the blank material row is dropped
    assert got == [("2024H1", "7", "55", 2.0, 1, "Ativo"), ("2024H2", "7", "55", 3.0, 1, "Ativo")]
    merged = PA.parts_history_merged(t, P).collect()
    assert len(merged) == 1 and float(merged[0]["qtd_total"]) == 5.0 and merged[0]["qtd_ocorrencias"] == 2
    assert merged[0]["ultima_ordem_por_data"] == "102"


def test_parts_history_text_mode_loses_dashed_dates(spark):
    t = parts_tables(spark)
    p = Params(as_of=dt.date(2024, 12, 1), parts_first_year=2024, date_mode="text")
    # '2024-08-02' < '20240101' as text (S-9): order 102 falls out
    got = [(r["periodo"], float(r["qtd_total"])) for r in PA.parts_history(t, p).collect()]
    assert got == [("2024H1", 2.0)]


def test_stock_labels(spark):
    t = {
        "aqua": spark.createDataFrame(
            [("G1", " ", "B2", Decimal(1), "WH1"), ("G1", None, "B1", Decimal(2), "WH1"),
             ("G1", "L1", "B1", Decimal(3), "WH1"), ("G1", "L1", "B1", Decimal(4), "WH1"),
             ("G1", "L1", "B3", Decimal(0), "WH1"), ("G1", "L2", "B9", Decimal(5), "WH2")],
            "matid string, charg string, lgpla string, quan decimal(31,14), lgnum string"),
        "mara": spark.createDataFrame([("000000000000000055", "G1")], "matnr string, scm_matid_guid16 string"),
    }
    r = RS.stock_by_material(t, Params(stock_warehouse="WH1")).collect()
    assert len(r) == 1 and r[0]["material"] == "55" and float(r[0]["saldo_estoque"]) == 10.0
    assert r[0]["lotes_com_posicoes"] == "B1 | B2 / L1 - B1"


def test_latest_approval_date_then_hour_nulls_last(spark):
    t = {"ztwf_log_wf": spark.createDataFrame(
        [(" K1", "A", "20240101", "10:00:00"), ("K1", "B", "20240102", None), ("K1", "C", "20240102", "09:00:00"),
         ("K2", "D", None, "23:00:00"), ("K2", "E", "20230101", "01:00:00"), ("K3", "F", "20240101", "01:00:00")],
        "chave string, acao string, data string, hora string")}
    base = spark.createDataFrame([("K1",), ("K2",)], "chave_reserva string")
    got = {r["chave"]: r["status"] for r in RS.latest_approval(t, Params(), base).collect()}
    assert got == {"K1": "C", "K2": "E"}


def test_require_keys_and_clean_fields(spark):
    df = spark.createDataFrame([("1", "x", "20240131"), (" \t", "x", "0"), ("2", None, "bad")],
                               "a string, b string, d string")
    assert [r["a"] for r in require_keys(df, ["a", "b"]).collect()] == ["1"]
    assert [r["d"] for r in clean_fields(df, ["d"]).collect()] == [dt.date(2024, 1, 31), None, None]


def test_optional_sources_degrade(spark):
    import star_queries as SQ
    from fleetlake.plans import orders as OR
    from fleetlake.plans import yard as YA
    from fleetlake.sources.star import star_tables
    sf = "/root/testdata/sf0.001"
    t = star_tables(spark, sf, ["hourmeter"])
    only_valid = YA.hourmeter_merged(t, SQ.STAR)
    assert only_valid.columns == YA.VALID_COLS + YA.REJECTED_COLS
    assert only_valid.count() == YA.hourmeter_latest(t, SQ.STAR).count()
    full = YA.hourmeter_merged(star_tables(spark, sf, ["hourmeter", "hourmeter_invalid"]), SQ.STAR)
    assert full.schema == only_valid.schema
    t = star_tables(spark, sf, ["pm_order_view"])
    rows = OR.work_order_enriched(t, SQ.STAR)
    full = OR.work_order_enriched(star_tables(spark, sf, ["pm_order_view"] + list(OR.DETAIL_SOURCES)), SQ.STAR)
    assert rows.schema == full.schema and rows.count() == full.count()


def test_parts_history_part_without_texts(spark):
    t = parts_tables(spark)
    t["resb"] = t["resb"].unionByName(spark.createDataFrame(
        [("101", "66", Decimal("1.000"))], "aufnr string, matnr string, bdmng decimal(13,3)"))
    got = {r["cod_sap"]: (r["descricao_componente"], r["grupo_mercadoria"])
           for r in PA.parts_history(t, P).filter("periodo = '2024H1'").collect()}
    assert got == {"55": ("Peca", "G1"), "66": (None, None)}
