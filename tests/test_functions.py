"""Column functions on small literal frames."""

import datetime as dt

from pyspark.sql import functions as F

from fleetlake.functions import dates as D
from fleetlake.functions import keys as K
from fleetlake.functions import status as S


def one_col(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


KEYS = ["0000012345", " 0012 ", "0000", "", None, "A00100"]


def test_strip_key_family(spark):
    assert one_col(spark, KEYS, K.strip_key) == ["12345", "12", "", "", None, "A00100"]
    assert one_col(spark, KEYS, K.strip_key_or_null) == ["12345", "12", None, None, None, "A00100"]
    # SC-3 does not trim first: a leading blank stops the strip (S-5)
    assert one_col(spark, KEYS, K.strip_zeros) == ["12345", " 0012 ", "", "", None, "A00100"]


def test_strip_key_idempotent(spark):
    once = one_col(spark, KEYS, K.strip_key)
    assert one_col(spark, once, K.strip_key) == once


def test_pad_key_sql_truncates_python_keeps(spark):
    assert one_col(spark, ["123", "1234567890123"], lambda c: K.pad_key(c, 12)) == ["000000000123", "123456789012"]
    assert one_col(spark, ["123", "1234567890123"], lambda c: K.py_pad_key(c, 12)) == ["000000000123",
                                                                                    "1234567890123"]


def test_py_strip_takes_all_whitespace(spark):
    assert one_col(spark, ["\t 12\n", "  ", None], K.py_strip) == ["12", "", None]


def test_int_text_and_as_long(spark):
    assert one_col(spark, ["0000123", " 12 ", "abc", None], K.int_text) == ["123", "12", "0", "0"]
    assert one_col(spark, ["0000123", "abc", "99999999999999999999"], K.as_long) == [123, None, None]


def test_concat_key_null_part(spark):
    df = spark.createDataFrame([("12", "3"), (None, "1")], "a string, b string")
    assert [r[0] for r in df.select(K.concat_key("a", 10, "b", 4)).collect()] == ["00000000120003", None]


def test_doc_id(spark):
    df = spark.createDataFrame([("000000123", "45", "9"), (None, "0045", "9"), (None, None, "0009"),
                                ("0000", "0000", "7")], "o string, p string, r string")
    got = [r[0] for r in df.select(K.doc_id("o", "p", "r")).collect()]
    assert got == ["123", "PC-45", "RC-9", "RC-7"]


def test_key_variants(spark):
    got = one_col(spark, ["00123", " 123 ", "0000", None], K.key_variants)
    assert got[0] == ["00123", "123", "000000000123", "000000000000000123"]
    assert got[1] == ["123", "000000000123", "000000000000000123"]
    assert got[2] == ["0000"]
    assert got[3] == []


def test_material_variants_pads_to_40(spark):
    got = one_col(spark, ["12"], K.material_variants)[0]
    assert got[0] == "12" and got[1] == "12".ljust(40) and len(got) == 6


DATES = ["20240131", "2024-01-31", "00000000", "0000-00-00", "20240230", "-0002-01-01", "infinity", "nan",
         "2024-01-31T10:00:00+02:00", "x2024-01-31", "2024-1-31", "", None, "NULL"]


def test_sap_date_table(spark):
    got = one_col(spark, DATES, D.sap_date)
    assert got == [dt.date(2024, 1, 31), dt.date(2024, 1, 31), None, None, None, dt.date(2, 1, 1), None, None,
                   dt.date(2024, 1, 31), dt.date(2024, 1, 31), None, None, None, None]


def test_stamp_dmy_and_null_date(spark):
    assert one_col(spark, ["20240131103000.0000000", "0.0000000", None], D.stamp_dmy) == ["31-01-2024", "", None]
    assert one_col(spark, ["0000-00-00", "2024-01-02", None], D.null_date) == [None, "2024-01-02", None]


def test_day_windows_share_edges():
    w = D.day_windows(30, 14, dt.date(2024, 3, 1))
    assert [(a, b) for _, a, b in w] == [
        (dt.date(2024, 1, 31), dt.date(2024, 2, 14)), (dt.date(2024, 2, 14), dt.date(2024, 2, 28)),
        (dt.date(2024, 2, 28), dt.date(2024, 3, 1))]


def test_first_window_index_matches_window_list(spark):
    as_of, total, step = dt.date(2024, 3, 1), 30, 14
    wins = D.day_windows(total, step, as_of)
    days = [as_of - dt.timedelta(days=i) for i in range(-2, total + 3)]
    got = one_col(spark, days, lambda c: D.first_window_index(c, total, step, as_of), "date")
    want = [next((i for i, a, b in wins if a <= d <= b), None) for d in days]
    assert got == want


def test_iso_offset(spark):
    got = one_col(spark, [dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2, 3, 4, 5, 120)],
                  lambda c: D.iso_offset(c, "-03:00"), "timestamp_ntz")
    assert got == ["2024-01-02T03:04:05-03:00", "2024-01-02T03:04:05.000120-03:00"]


def test_approval_label_passthrough(spark):
    assert one_col(spark, ["STARTED", "COMPLETED", "OTHER", None], S.approval_label) == [
        "1. Iniciado/Aguardando", "3. Aprovado", "OTHER", None]


def test_category_blank_po_wins(spark):
    # S-7: '' on the PO beats 'K' on the requisition, NULL does not
    df = spark.createDataFrame([("", "K"), (None, "K"), ("A", None), ("Z", None), (None, None), ("F", "K"),
                                (None, "P"), ("Q ", None), (" N", None)], "po string, rc string")
    c = S.category(F.col("po"), F.col("rc"))
    got = [(r[0], r[1]) for r in df.select(S.destination(c), S.consumption_type(c)).collect()]
    assert got == [("estoque", "Estoque"), ("centro_custo", "Centro de Custo"),
                   ("consumo", "Ativo Fixo (Imobilizado)"), ("consumo", "Outro"), ("estoque", "Estoque"),
                   ("consumo", "Ordem (Manutencao/Interna)"), ("consumo", "Projeto (PEP)"),
                   ("consumo", "Projeto (PEP)"), ("consumo", "Rede")]


def test_process_status_all_rules(spark):
    rows = [  # received, po_qty, release, po, po_del, rc_del, rc
        (10, 10, "", "P1", "", "", "R"),       # recebido
        (5, 10, "", "P1", "", "", "R"),        # entrega_parcial
        (0, 10, "X", "P1", "", "", "R"),       # aguardando_aprovacao
        (None, 10, "", "P1", None, "", "R"),   # pedido_emitido
        (None, 10, "", "P1", "L", "", "R"),    # pedido_cancelado
        (None, None, None, None, None, "X", "R"),  # rc_excluida
        (None, None, None, None, None, "", "R"),   # aguardando_pedido
        (None, None, None, None, None, "", None),  # verificar
        (5, 10, "", "P1", "L", "", "R"),       # cancelled but received: partial wins
    ]
    df = spark.createDataFrame(rows, "rec int, q int, rel string, po string, pd string, rd string, rc string")
    got = [r[0] for r in df.select(S.process_status("rec", "q", "rel", "po", "pd", "rd", "rc")).collect()]
    assert got == ["recebido", "entrega_parcial", "aguardando_aprovacao", "pedido_emitido", "pedido_cancelado",
                   "rc_excluida", "aguardando_pedido", "verificar", "entrega_parcial"]


def test_criticality(spark):
    df = spark.createDataFrame([("01", None), ("2", " "), (None, "Alta"), ("9", None), (" ", None)],
                               "code string, txt string")
    got = [r[0] for r in df.select(S.criticality("code", "txt")).collect()]
    assert got == ["Urgente", "Alta", "Alta", None, None]
    assert one_col(spark, ["01", "1", " 2 ", None], S.priority_label) == [None, "Urgente", "Alta", None]


def test_kinds_and_phases(spark):
    df = spark.createDataFrame([("PRP", None), (None, "xOFIcina"), ("X", "preparo"), (None, None)],
                               "c string, t string")
    assert [r[0] for r in df.select(S.maintenance_kind("c", "t")).collect()] == [
        "Preparação", "Oficina", "Preparação", "Outro"]
    assert one_col(spark, ["PRP1", "OFI1", "OUT", None], S.maintenance_kind_code) == [
        "Preparação", "Oficina", "Outro", "Outro"]
    assert one_col(spark, ["WCA1", "xWCBy", "OTH"], lambda c: S.branch(c, ["WCA", "WCB"])) == ["WCA", "WCB", "OTH"]


def test_desc_text_key_reverses_order(spark):
    vals = ["123", "12", "000123", " 123", "9", "10", "abc", "ab", "é", None, ""]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    got = [r[0] for r in df.orderBy(K.desc_text_key(F.col("x"))).collect()]
    want = [r[0] for r in df.orderBy(F.col("x").desc_nulls_first()).collect()]
    assert got == want


ODD_KEYS = ["12", "012", "0012", "000000000012", "000000000000000012", "0000000000000000012", " 12", "0 12", " 012 ", "0", "00", "000000000000", "", " ",
            "\t12", "12\t", "A1", "0A1", "1234567890123", "01234567890123", "000001234567890123", "x" * 39, "x" * 40, "0" + "x" * 40, "y" * 41, "12 3", "0 0", None]


def test_form_key_is_variants_backwards(spark):
    """A text is a variant of another exactly if its form key is one of the other's, each variant under one key."""
    texts = ODD_KEYS + [k.ljust(n) for k in ODD_KEYS if k for n in (20, 40, 41)]
    rows = spark.createDataFrame([(k,) for k in texts], "k string")
    for variants, key in ((K.key_variants, K.form_key), (K.material_variants, K.material_form_key)):
        wanted = {(r["k"], v) for r in rows.select("k", F.explode(variants(F.col("k"))).alias("v")).collect() for v in [r["v"]] if v in texts}
        own = {r["k"]: r["f"] for r in rows.select("k", K.form_keys(F.col("k")).alias("f")).collect()}
        of = {r["k"]: r["f"] for r in rows.select("k", key(F.col("k")).alias("f")).collect()}
        assert all(len(set(f)) == len(f) for f in own.values() if f)
        assert {(a, b) for a in texts for b in texts if of[b] is not None and of[b] in (own[a] or [])} == wanted
