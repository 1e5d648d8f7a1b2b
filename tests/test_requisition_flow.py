"""Golden rows for the requisition flow."""

import datetime as dt
from decimal import Decimal as Dm

from fleetlake.params import Params
from fleetlake.plans import purchasing as PU

AS_OF = dt.date(2024, 3, 1)
P = Params(as_of=AS_OF, buyer_groups=("201",), buyer_users=("BUYER",), rc_total_days=30, rc_step_days=14)


def tables(spark):
    eban = spark.createDataFrame([
        # banfn, bnfpo, matnr, txz01, menge, preis, ekgrp, ernam, badat, knttp, loekz
        ("0010000001", "00010", "000000000000000055", "req a", Dm("2.000"), Dm("10.00"), "201", "U", "20240210", "K", ""),
        ("0010000002", "00010", "000000000000000056", "req b", Dm("1.000"), Dm("5.00"), "201", "U", "2024-02-14", None, "X"),
        ("0010000003", "00010", "000000000000000057", "req c", Dm("4.000"), Dm("1.00"), "999", "U", "20240220", "A", ""),
        ("0010000004", "00010", "000000000000000058", "req d", Dm("1.000"), Dm("1.00"), "999", "U", "20240220", "", ""),
        ("0010000005", "00010", "000000000000000000", "no mat", Dm("1.000"), Dm("1.00"), "201", "U", "20240220", "", ""),
        ("0010000006", "00010", "000000000000000059", "old", Dm("1.000"), Dm("1.00"), "201", "U", "20230101", "", ""),
    ], "banfn string, bnfpo string, matnr string, txz01 string, menge decimal(13,3), preis decimal(11,2), "
       "ekgrp string, ernam string, badat string, knttp string, loekz string")
    ekpo = spark.createDataFrame([
        # ebeln, ebelp, banfn, bnfpo, matnr, txz01, menge, meins, netpr, netwr, knttp, loekz
        ("0045000002", "00020", "0010000001", "00010", "55", "po", Dm("2.000"), "UN", Dm("10.00"), Dm("20.00"), "", ""),
        ("0045000001", "00010", "0010000001", "00010", "55", "po", Dm("2.000"), "UN", Dm("10.00"), Dm("20.00"), "", ""),
        ("0045000003", "00010", "0010000003", "00010", "57", "po", Dm("4.000"), "UN", Dm("1.00"), Dm("4.00"), "F", ""),
    ], "ebeln string, ebelp string, banfn string, bnfpo string, matnr string, txz01 string, menge decimal(13,3), "
       "meins string, netpr decimal(11,2), netwr decimal(13,2), knttp string, loekz string")
    ekko = spark.createDataFrame([
        ("0045000001", "0000000009", "20240215", "BUYER", "999", ""),
        ("0045000002", "0000000009", "20240215", "BUYER", "999", ""),
        ("0045000003", "0000000009", "20240221", "BUYER", "999", "X"),
    ], "ebeln string, lifnr string, bedat string, ernam string, ekgrp string, frgrl string")
    ebkn = spark.createDataFrame([("0010000003", "00010", "000000000777", "0000001234")],
                                 "banfn string, bnfpo string, aufnr string, kostl string")
    ekkn = spark.createDataFrame([("0045000003", "00010", "000000000777", "0000005678")],
                                 "ebeln string, ebelp string, aufnr string, kostl string")
    afih = spark.createDataFrame([("000000000777", "000000000000000042")], "aufnr string, equnr string")
    lfa1 = spark.createDataFrame([("0000000009", "Vendor")], "lifnr string, name1 string")
    ekbe = spark.createDataFrame([("0045000001", "00010", "1", Dm("2.000")), ("0045000003", "00010", "1", Dm("1.000")),
                                  ("0045000003", "00010", "2", Dm("9.000"))],
                                 "ebeln string, ebelp string, vgabe string, menge decimal(13,3)")
    eket = spark.createDataFrame([("0045000001", "00010", "20240301"), ("0045000001", "00010", "20240225")],
                                 "ebeln string, ebelp string, eindt string")
    makt = spark.createDataFrame([("000000000000000055", "P", "Parafuso"), ("000000000000000055", "PT", "Parafuso PT"),
                                  ("000000000000000056", "E", "Bolt")], "matnr string, spras string, maktx string")
    return dict(eban=eban, ekpo=ekpo, ekko=ekko, ebkn=ebkn, ekkn=ekkn, afih=afih, lfa1=lfa1, ekbe=ekbe, eket=eket,
                makt=makt)


def test_requisition_flow_golden(spark):
    rows = {r["num_rc"]: r for r in PU.requisition_flow(tables(spark), P).collect()}
    # 5: blank material; 6: older than the range; 4: not owned
    assert sorted(rows) == ["10000001", "10000002", "10000003"]
    a = rows["10000001"]
    # two PO items for one requisition item: the lower PO number wins (S-3)
    assert (a["pedido"], a["num_operacao"]) == ("45000001", "00010")
    assert a["status_processo"] == "recebido" and a["ativo"] == "ESTOQUE" and a["ordem"] == "PC-45000001"
    # blank category on the PO beats 'K' on the requisition (S-7)
    assert (a["knttp"], a["destinacao"], a["tipo_consumo"]) == (None, "estoque", "Estoque")
    assert a["descricao"] == "Parafuso PT" and a["fornecedor_nome"] == "Vendor"
    assert a["data_remessa_pc"] == "20240225" and a["comprador"] == "BUYER"
    b = rows["10000002"]
    # requisition without PO: deleted requisition, text only in another language
    assert (b["status_processo"], b["ordem"], b["descricao"], b["pedido"]) == ("rc_excluida", "RC-10000002", "req b",
                                                                             None)
    assert b["vlr_total"] == Dm("5.00000") and b["data_requisicao"] == "2024-02-14"
    c = rows["10000003"]
    # owned through the PO creator; asset from the order's equipment; partial receipt
    assert (c["ativo"], c["ordem"], c["centro_custo"]) == ("42", "777", "5678")
    assert (c["status_processo"], c["knttp"], c["tipo_consumo"]) == ("entrega_parcial", "F",
                                                                    "Ordem (Manutencao/Interna)")


def test_requisition_windows_first_seen(spark):
    t = tables(spark)
    rows = {r["num_rc"]: r["janela"] for r in PU.requisition_flow_with_window(t, P).collect()}
    # 2024-02-14 is the day windows 0 and 1 share: it belongs to window 0
    assert rows["10000002"] == 0 and rows["10000001"] == 0 and rows["10000003"] == 1
