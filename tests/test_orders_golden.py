"""Golden rows for order supplies (J13) and external work orders."""

import datetime as dt
from decimal import Decimal as Dm

from fleetlake.params import Params
from fleetlake.plans import orders as OR

P = Params(as_of=dt.date(2024, 6, 1), orders_since=dt.date(2024, 1, 1), responsibles=("22",),
           branch_codes=("WCA", "WCB"))


def test_order_supplies_priority_and_texts(spark):
    pm = spark.createDataFrame([
        # newest PRP order of asset A1 is 0002; 0001 is older; OTH work centre is out
        ("A1", "000000000001", "PRP", "x", "WCA1", "2024-01-05"),
        ("A1", "000000000002", None, "preparo", "WCA1", "2024-02-05"),
        ("A1", "000000000003", "OFI", "x", "OTH1", "2024-03-05"),
    ], "n_equipamento string, n_ordem string, cod_tipo_atividade string, tipo_atividade string, "
       "cod_centro_trabalho string, data_criacao string")
    ebkn = spark.createDataFrame([("000000000002", "R1", "00010")], "aufnr string, banfn string, bnfpo string")
    eban = spark.createDataFrame([("R1", "00010", "0000055", "direct buy", Dm("1.000"), "K"),
                                  ("R2", "00010", "0000066", "for reservation", Dm("1.000"), "")],
                                 "banfn string, bnfpo string, matnr string, txz01 string, menge decimal(13,3), "
                                 "knttp string")
    ekpo = spark.createDataFrame([("R2", "00010", "0045")], "banfn string, bnfpo string, ebeln string")
    resb = spark.createDataFrame([
        # the same part as the purchase: the purchase wins (WN-4)
        ("000000000002", "0099", "0001", "0000055", Dm("5.000"), None, None, None, None),
        # reservation with PO through its requisition
        ("000000000002", "0099", "0002", "0000066", Dm("2.000"), "", "L", "R2", "00010"),
        # bought item ('N'): origin purchase, no reservation number
        ("000000000002", "0099", "0003", "0000077", Dm("3.000"), "", "N", None, None),
        # deleted reservation is dropped (NULL-safe test, S-6)
        ("000000000002", "0099", "0004", "0000088", Dm("3.000"), "X", "L", None, None),
    ], "aufnr string, rsnum string, rspos string, matnr string, bdmng decimal(13,3), xloek string, postp string, "
       "banfn string, bnfpo string")
    makt = spark.createDataFrame([("55", "P", "Text 55"), ("0066", "PT", "Text 66")],
                                 "matnr string, spras string, maktx string")
    t = dict(pm_order_view=pm, ebkn=ebkn, eban=eban, ekpo=ekpo, resb=resb, makt=makt)
    got = {r["cod_sap"]: (r["ordem"], r["origem"], r["pedido"], r["num_reserva"], r["descricao"], r["destinacao"])
           for r in OR.order_supplies(t, P).collect()}
    assert got == {"55": ("2", "compra", None, None, "Text 55", "centro_custo"),
                   "66": ("2", "reserva", "45", "99", "Text 66", "estoque"),
                   "77": ("2", "compra", None, None, "Sem Descrição", "estoque")}


def test_external_work_orders_nesting(spark):
    aufk = spark.createDataFrame([("000000000100", "OR100", "Pump", "20240201", "U1", None, None, None, "", "X", "X",
                                   "", "")],
                                 "aufnr string, objnr string, ktext string, erdat string, ernam string, "
                                 "idat1 string, idat2 string, idat3 string, loekz string, phas0 string, "
                                 "phas1 string, phas2 string, phas3 string")
    afih = spark.createDataFrame([("000000000100", "EQ1", "W1", "OFI1", "01", "00000022")],
                                 "aufnr string, equnr string, gewrk string, ilart string, priok string, "
                                 "maintordpersonresponsible string")
    crhd = spark.createDataFrame([("W1", "WCA1"), ("W2", "WCB2")], "objid string, arbpl string")
    pa = spark.createDataFrame([("00000022", "Ana"), ("00000022", "Bia")], "pernr string, ename string")
    afko = spark.createDataFrame([("000000000100", "20240202", "20240210", None, None, "P1")],
                                 "aufnr string, gstrp string, gltrp string, gstri string, getri string, aufpl string")
    afvc = spark.createDataFrame([("P1", "1", "0020", "second", "W2"), ("P1", "2", "0010", "first", "W1"),
                                  ("P1", "3", "0010", "dup", "W1"), ("P1", "4", None, "no number", "W1")],
                                 "aufpl string, aplzl string, vornr string, ltxa1 string, arbid string")
    afvv = spark.createDataFrame([("P1", "1", Dm("2.0")), ("P1", "2", Dm("1.0"))],
                                 "aufpl string, aplzl string, arbei decimal(7,1)")
    jest = spark.createDataFrame([("OR100", "E1", ""), ("OR100", "E1", None), ("OR100", "I1", "X")],
                                 "objnr string, stat string, inact string")
    tj02t = spark.createDataFrame([("I1", "P", "LIB")], "istat string, spras string, txt04 string")
    jsto = spark.createDataFrame([("OR100", "Z1")], "objnr string, stsma string")
    tj30t = spark.createDataFrame([("E1", "Z1", "P", "AGMT", "Aguardando")],
                                  "estat string, stsma string, spras string, txt04 string, txt30 string")
    t = dict(aufk=aufk, afih=afih, crhd=crhd, pa0001=pa, afko=afko, afvc=afvc, afvv=afvv, jest=jest, tj02t=tj02t,
             jsto=jsto, tj30t=tj30t)
    rows = OR.external_work_orders(t, P).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r["ordem"], r["ativo"], r["responsavel"], r["cod_responsavel"]) == ("100", "EQ1", "Bia", "22")
    # '01' has no SQL label but the Python form strips the zero (CL-12)
    assert (r["priok"], r["criticidade"], r["situacao_os"]) == ("01", "Urgente", "Liberada")
    # inactive system status dropped; user status once though listed twice
    assert (r["status_usuario"], r["status_usuario_desc"], r["status_sistema"]) == ("AGMT", "Aguardando", None)
    ops = [(o["num_operacao"], o["descricao_operacao"], o["centro_trabalho_operacao"]) for o in r["operacoes"]]
    # unique by number, sorted; on equal order keys the description breaks the tie ('dup' < 'first');
    # the operation without a number is not nested
    assert ops == [("0010", "dup", "WCA1"), ("0020", "second", "WCB2")]
