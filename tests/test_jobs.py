"""Job golden tests on hand-written source rows (FIXTURES.md section 2)."""

import datetime as dt
from decimal import Decimal

import pytest

from fleetlake.functions.predicates import between_days
from fleetlake.params import Params
from fleetlake.plans import purchasing as PU
from fleetlake.plans import yard as YA

P = Params(as_of=dt.date(2024, 3, 1), buyer_groups=("201",), buyer_users=("U1",),
           yard_branches=("N1", "North Hub"))


def frame(spark, schema, rows):
    return spark.createDataFrame(rows, schema)


def test_po_payment_padded_and_paid_wins(spark):
    t = {
        "ekko": frame(spark, "ebeln string, ekgrp string, ernam string",
                      [("0000000012", "201", "X"), ("12", "999", "U1"), ("0000000013", "201", "Y"),
                       ("0000000014", "999", "Z")]),
        "ekpo": frame(spark, "ebeln string, ebelp string",
                      [("0000000012", "00010"), ("12", "00010"), ("0000000013", "00010"), ("0000000014", "00010")]),
        "ekbe": frame(spark, "ebeln string, ebelp string, vgabe string, menge decimal(13,3)",
                      [("12", "00010", "2", Decimal(1)), ("0000000013", "00010", "1", Decimal(1))]),
    }
    got = {r[0]: r[1] for r in PU.po_payment(t, P).collect()}
    assert got == {"12": "Pago / Fatura Lançada (MIRO)", "13": "Não Lançado"}


def test_po_approval_null_hour_first(spark):
    t = {"approvals": frame(
        spark, "numeropedido string, nomeaprovador string, datainicio string, horarioinicioaprovacao string, "
               "horariofinalaprovacao string, statusfluxoaprovacao string, datafinal string",
        [("0045", "A", "2024-01-01", "10:00:00", None, "STARTED", None),
         ("45", "B", "2024-01-02", None, None, "READY", None),
         ("0046", "C", "2024-01-01", "09:00:00", "10:00:00", "COMPLETED", "2024-01-01"),
         ("0046", "D", "2024-01-05", "09:00:00", "10:00:00", "CANCELLED", "2024-01-05")])}
    got = {r["pedido"]: (r["aprovador"], r["status_aprovacao"]) for r in PU.po_approval(t, P).collect()}
    # PostgreSQL DESC puts the NULL start hour first (S-1); same hours -> newer date (S-2)
    assert got == {"45": ("B", "2. Pronto para Aprovacao"), "46": ("D", "0. Cancelado/Reprovado")}


def test_goods_receipt_done_before_pending(spark):
    t = {"receipts": frame(spark, "requisicao_de_compra_os string, requisicao_de_compra_id long, pedido string, "
                                  "data_recebimento timestamp_ntz",
                           [("", 1, "P1", None), ("0099", 1, " P1", dt.datetime(2024, 1, 1)),
                            (None, 2, "P2", None)]),
         "requisitions": frame(spark, "id long, numero_pedido_gerado string", [(1, "0077"), (2, None)])}
    got = {r["pedido_key"]: (r["pedido"], r["requisicao"], r["status_migo"])
           for r in PU.goods_receipt_status(t, P).collect()}
    assert got == {"P1": (" P1", "99", "MIGO FEITA"), "P2": ("P2", "", "MIGO PENDENTE")}


def test_yard_entries_latest_then_filter(spark):
    d1, d2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    cols = ("asset_no string, tipo_equipamento string, marca string, modelo string, cliente string, "
            "situacao string, created_at_form timestamp_ntz, horimetro decimal(12,2), filial string, "
            "tipo_relatorio string")
    rows = [("a1", "t", "m", "x", "c", "s", d1, 1, "N1", "Entrada"),
            ("a1", "t", "m", "x", "c", "s", d2, 2, "N1", "Saída"),       # newest is an exit: out
            ("a2", "t", "m", "x", "c", "s", d2, 3, "SP", "Entrada"),     # newest at another branch: out
            ("a3", "t", "m", "x", "c", "s", d2, 4, "N1", "Entrada"),
            ("a3", "t", "m", "x", "c", "s", d2, 5, "North Hub", "Entrada"),  # tie kept
            (" A3", "t", "m", "x", "c", "s", d1, 6, "N1", "Entrada")]    # other raw code (S-14)
    rows = [r[:7] + (Decimal(r[7]),) + r[8:] for r in rows]
    got = sorted((r["asset_no"], int(r["horimetro"])) for r in YA.yard_entries({"uca_yard": frame(spark, cols, rows)},
                                                                              P).collect())
    assert got == [("A3", 4), ("A3", 5), ("A3", 6)]


@pytest.mark.parametrize("mode,expected", [("date", 2), ("text", 1)])
def test_date_range_modes(spark, mode, expected):
    # S-9: as text, the dashed row sorts below the compact bound and is lost
    df = frame(spark, "d string", [("20240215",), ("2024-02-20",)])
    assert df.filter(between_days("d", 30, 0, dt.date(2024, 3, 1), mode)).count() == expected
