"""Purchasing jobs: PO payment, PO approval, goods receipts, purchase history,
requisition flow (SURVEY 2.13, J1, J2, J3, J5, J7).

Every job takes ``tables: dict[str, DataFrame]`` with the source tables
(lower-case names as in FIXTURES.md) and a ``Params``; it returns a lazy
DataFrame. Nothing is collected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.functions import dates as D
from fleetlake.functions import keys as K
from fleetlake.functions import predicates as PR
from fleetlake.functions import status as S
from fleetlake.operators.dedup import any_match, first_per_key
from fleetlake.operators.batches import run_summary
from fleetlake.operators.lookups import SALT, agg_lookup, spread_nulls, text_lookup, with_salt
from fleetlake.operators.stored import Step, in_slice, slices_for, steps_for, store, store_by_slice, store_parts, whole
from fleetlake.params import Params


def owned_by(groups_cols: list[Column], users_col: Column | None, p: Params) -> Column:
    """PF-5 with the job's buyer groups and users."""
    p.need_owner()
    return PR.owned_by(groups_cols, users_col, p.buyer_groups, p.buyer_users)


def py_key(c) -> Column:
    """The Python re-strip after SQL: ``str(x or '').strip().lstrip('0')``."""
    return F.ltrim(K.py_strip(F.coalesce(K.strip_key(c), F.lit(""))), F.lit("0"))


# --------------------------------------------------------------------- J7
def po_payment_rows(t: dict[str, DataFrame], p: Params) -> DataFrame:
    """Payment status per purchase order (one row per stripped PO), with the raw PO it sorts by.

    PO items of owned headers, looked up against type-2 (invoice receipt)
    history rows; a PO is paid when any of its items has one (AG-5, CL-5).
    The reference groups on the raw PO and then keeps a paid row over an
    unpaid one per stripped PO (AG-11); grouping once on the stripped PO
    gives the same rows (S-22).
    """
    ekko = t["ekko"].filter(owned_by([F.col("ekgrp")], F.col("ernam"), p)).select("ebeln")
    items = ekko.join(t["ekpo"].select("ebeln", "ebelp"), "ebeln")
    inv = t["ekbe"]
    items = agg_lookup(items, inv, [F.col("ebeln"), F.col("ebelp")], [inv.ebeln, inv.ebelp],
                       [F.lit(True).alias("has_invoice")], where=inv.vgabe == "2", name="inv")
    out = (items.withColumn("pedido", py_key("ebeln"))
           .filter(F.col("pedido") != "")
           .groupBy("pedido").agg(any_match(F.col("has_invoice")).alias("paid"),  # AG-6: group on the derived key
                                  F.min("ebeln").alias("_ebeln")))
    return out.select("pedido", S.payment_status(F.col("paid")).alias("status_pagamento"), "_ebeln")


def po_payment(t: dict[str, DataFrame], p: Params) -> DataFrame:
    """J7 as delivered, one row per stripped PO."""
    return po_payment_rows(t, p).drop("_ebeln")


# --------------------------------------------------------------------- J1
def po_approval(t: dict[str, DataFrame], p: Params) -> DataFrame:
    """Latest approval step per purchase order.

    The status label (CL-4), then the first row per stripped PO ordered by start hour, end hour, start
    date, all descending with NULLs first as in PostgreSQL (S-1, S-2). The
    remaining columns break ties (S-3), so the order is total and equal rows need no
    DISTINCT (AG-7) before it.
    """
    a = t["approvals"]
    rows = a.select(
        F.col("numeropedido").alias("pedido_raw"),
        F.col("nomeaprovador").alias("aprovador"),
        F.col("datainicio").alias("data_inicio"),
        F.col("horarioinicioaprovacao").alias("hora_inicio"),
        F.col("horariofinalaprovacao").alias("hora_fim"),
        S.approval_label(F.col("statusfluxoaprovacao")).alias("status_aprovacao"),
        F.col("statusfluxoaprovacao").alias("status_raw"),
        F.col("datafinal").alias("data_final"),
    )
    rows = rows.withColumn("pedido", F.ltrim(K.py_strip(F.coalesce("pedido_raw", F.lit(""))), F.lit("0")))
    rows = rows.filter(F.col("pedido") != "")
    hours, day = ["hora_inicio", "hora_fim"], ["data_inicio"]
    order = [F.col(c).desc_nulls_first() for c in (day + hours if p.approvals_date_first else hours + day)]
    tie = [F.col(c).asc_nulls_last() for c in ("pedido_raw", "aprovador", "status_raw", "data_final")]
    best = first_per_key(rows, "pedido", order, tie)
    return best.select("pedido", "aprovador", "data_inicio", "hora_inicio", "hora_fim",
                       "status_aprovacao", "status_raw", "data_final")


# --------------------------------------------------------------------- J5
def goods_receipt_status(t: dict[str, DataFrame], p: Params) -> DataFrame:
    """Goods receipt status per PO, 'done' before 'pending'.

    Receipts left-joined to requisitions; the requisition reference is the
    receipt's own, else the generated PO number, zeros stripped (SC-23).
    One row per trimmed PO: status ascending (MIGO FEITA first), then the
    newest receipt date, NULLs last as in MySQL (S-1). The raw PO text is
    kept as ``pedido`` and the trimmed one as ``pedido_key`` (S-21).
    """
    er, rc = t["receipts"].alias("er"), t["requisitions"].alias("rc")
    m = er.join(rc, F.col("er.requisicao_de_compra_id") == F.col("rc.id"), "left").select(
        F.col("er.pedido").alias("pedido"),
        K.requisition_ref(F.col("er.requisicao_de_compra_os"), F.col("rc.numero_pedido_gerado")).alias("requisicao"),
        F.col("er.data_recebimento").alias("data_do_recebimento_fisico"),
    ).withColumn("status_migo", S.receipt_status(F.col("data_do_recebimento_fisico")))
    m = m.withColumn("pedido_key", K.py_strip(F.coalesce("pedido", F.lit("")))).filter(F.col("pedido_key") != "")
    # SO-3/SO-4: the order by the derived status decides which row is kept
    order = [F.col("status_migo").asc_nulls_first(), F.col("data_do_recebimento_fisico").desc_nulls_last()]
    tie = [F.col("requisicao").asc_nulls_last(), F.col("pedido").asc_nulls_last()]
    return first_per_key(m, "pedido_key", order, tie).select(
        "pedido", "pedido_key", "requisicao", "data_do_recebimento_fisico", "status_migo")


# --------------------------------------------------------------------- J2
def history_items(t: dict[str, DataFrame], p: Params, mode: str | None = None) -> DataFrame:
    """J2 before the dedup: kept PO items of the range with window and keys, without the looked-up columns."""
    mode = mode or p.date_mode
    ekpo, ekko = t["ekpo"].alias("p"), t["ekko"].alias("k")
    base = ekpo.join(ekko, F.col("p.ebeln") == F.col("k.ebeln"), "inner").filter(
        PR.between_days(F.col("k.bedat"), p.hist_total_days, 0, p.as_of, mode)
        & PR.not_flag(F.col("p.loekz"), "L")
        & (K.strip_key(F.coalesce(F.col("p.matnr"), F.lit(""))) != "")
        & (F.coalesce(F.col("p.netpr"), F.lit(0)) > 0))  # PF-14
    rows = base.select(
        K.strip_key(F.col("p.ebeln")).alias("pedido"), K.as_text(F.col("p.ebelp")).alias("item_pc"),
        K.strip_key(F.col("p.matnr")).alias("cod_sap"), F.col("p.txz01").alias("txz01"), F.col("k.lifnr").alias("lifnr"),
        F.col("k.bedat").alias("data_emissao_pc"), F.col("p.menge").alias("qtd"), F.col("p.netpr").alias("vlr_unit"),
        F.col("p.netwr").alias("vlr_total"),
        D.first_window_index(D.sap_date(F.col("k.bedat")), p.hist_total_days, p.hist_step_days, p.as_of).alias("janela"),
        F.col("p.ebeln").alias("_ebeln"), F.col("p.ebelp").alias("_ebelp"), F.col("p.matnr").alias("_matnr"))
    return K.require_keys(rows, ["pedido", "item_pc", "cod_sap"])


# Seen-set order of J2 within a window: the raw PO, then its item (S-3).
def HISTORY_ORDER() -> list[Column]:
    return [F.col("_ebeln").asc_nulls_last(), F.col("_ebelp").asc_nulls_last(), F.col("cod_sap").asc_nulls_last()]


def history_texts(items: DataFrame, t: dict[str, DataFrame], p: Params, step: Step = whole) -> DataFrame:
    """J2 columns that are looked up: vendor, earliest schedule line (JN-10), material text (JN-19)."""
    vend = t["lfa1"].select(F.col("lifnr").alias("v_lifnr"), F.col("name1"))
    base = items.join(vend, items.lifnr == vend.v_lifnr, "left").drop("v_lifnr")
    eket, makt = t["eket"], t["makt"]
    base = agg_lookup(base, eket, [F.col("_ebeln"), F.col("_ebelp")], [eket.ebeln, eket.ebelp],
                      [F.min("eindt").alias("data_remessa_pc")], name="sch")
    base = step(base, "history-lookups")
    base = text_lookup(base, makt, F.col("_matnr"), makt.matnr, "maktx", "maktx", langs=p.text_langs, name="mk")
    return base.select(
        "pedido", "item_pc", "cod_sap", F.coalesce(F.col("maktx"), F.col("txz01")).alias("descricao"),
        K.strip_key_or_null(F.coalesce(F.col("lifnr"), F.lit(""))).alias("fornecedor_cod"),
        F.col("name1").alias("fornecedor_nome"), "data_emissao_pc", "data_remessa_pc", "qtd", "vlr_unit", "vlr_total", "janela",
        "_ebeln", "_ebelp")


def purchase_history_rows(t: dict[str, DataFrame], p: Params, mode: str | None = None, step: Step = whole) -> DataFrame:
    """PO items of the last ``hist_total_days`` days, first window wins; with the raw keys it sorts by.

    The reference runs one query per 30-day window, oldest first, and keeps
    the first row per (PO, item). Here the whole range is read once, each
    row gets the oldest window holding its PO date (BF-1), and one
    ``first_per_key`` over (PO, item) does the seen-set dedup (AG-10, S-17).
    Its order needs no looked-up column, so vendor, schedule and text are
    looked up for the kept rows only. ``step``: what is done with the kept rows and between the lookups
    (see ``stored``).
    """
    best = first_per_key(history_items(t, p, mode), ["pedido", "item_pc"], [F.col("janela").asc_nulls_last()], HISTORY_ORDER())
    return history_texts(step(best, "history"), t, p, step)


def purchase_history_stepped(t: dict[str, DataFrame], p: Params) -> DataFrame:
    """``purchase_history_rows``, over large files in steps."""
    return purchase_history_rows(t, p, step=steps_for(purchase_history_rows(t, p)))


def purchase_history(t: dict[str, DataFrame], p: Params, mode: str | None = None) -> DataFrame:
    """J2 as delivered."""
    return purchase_history_rows(t, p, mode).drop("_ebeln", "_ebelp")


# --------------------------------------------------------------------- J3
RC_COLUMNS = ["ativo", "ordem", "cod_sap", "descricao", "qtd_req", "pedido", "num_operacao", "num_rc",
              "item_rc", "comprador", "criado_por_sap", "data_requisicao", "fornecedor_cod", "fornecedor_nome",
              "data_emissao_pc", "data_remessa_pc", "vlr_unit", "vlr_total", "knttp", "destinacao",
              "tipo_consumo", "centro_custo", "status_processo"]


def _requisition_accounts(t: dict[str, DataFrame]) -> DataFrame:
    """Account assignment of a requisition item, with the order's asset."""
    acc = t["ebkn"].groupBy(F.col("banfn").alias("u_banfn"), F.col("bnfpo").alias("u_bnfpo")).agg(
        F.max("aufnr").alias("acc_aufnr"), F.max("kostl").alias("acc_kostl"))
    afih = t["afih"].select(F.col("aufnr").alias("a_aufnr"), F.col("equnr").alias("a_equnr"))
    # the asset joins the few columns of the assignment, not the whole items
    acc = with_salt(acc, ["u_banfn", "u_bnfpo"])
    return acc.join(afih, spread_nulls("acc_aufnr") == F.col("a_aufnr"), "left").drop("a_aufnr", SALT)


def _requisition_items(t: dict[str, DataFrame], p: Params, accounts: DataFrame) -> DataFrame:
    """Requisition items of the range with material text, account assignment and the order's asset."""
    e = t["eban"].filter(PR.between_days(F.col("badat"), p.rc_total_days, 0, p.as_of)
                         & (K.strip_key(F.col("matnr")) != ""))
    makt = t["makt"]
    e = text_lookup(e, makt, F.col("matnr"), makt.matnr, "maktx", "m_maktx", langs=p.text_langs, name="m")
    return e.join(accounts, (F.col("banfn") == F.col("u_banfn")) & (F.col("bnfpo") == F.col("u_bnfpo")), "left").drop("u_banfn", "u_bnfpo")


def _requisition_orders(t: dict[str, DataFrame], p: Params, step: Step = whole) -> DataFrame:
    """PO items of a requisition item with header, vendor and the lookups on the PO item."""
    po = t["ekpo"].filter(F.col("banfn").isNotNull() & F.col("bnfpo").isNotNull()).select(
        *[F.col(c).alias(f"p_{c}") for c in ("ebeln", "ebelp", "banfn", "bnfpo", "menge", "netpr", "netwr", "knttp", "loekz")])
    ekkn, ekbe, eket = t["ekkn"], t["ekbe"], t["eket"]
    po = with_salt(po, ["p_banfn", "p_bnfpo"])  # items without a PO number are spread (see spread_nulls)
    po_key = [spread_nulls("p_ebeln"), F.col("p_ebelp")]
    po = agg_lookup(po, ekkn, po_key, [ekkn.ebeln, ekkn.ebelp], [F.max("kostl").alias("pk_kostl")], name="pk")
    # AG-3 / S-16: received quantity sums every type-1 history row, no sign is read
    po = agg_lookup(po, ekbe, po_key, [ekbe.ebeln, ekbe.ebelp], [F.sum("menge").alias("qtd_recebida")],
                    where=ekbe.vgabe == "1", name="h")
    po = agg_lookup(po, eket, po_key, [eket.ebeln, eket.ebelp], [F.min("eindt").alias("data_remessa")],
                    name="sch")
    po = step(po, "po-lookups")
    # the vendor joins the headers, which are fewer and narrower than the items
    hd = with_salt(t["ekko"].select(*[F.col(c).alias(f"k_{c}") for c in ("ebeln", "lifnr", "bedat", "ernam", "ekgrp", "frgrl")]), ["k_ebeln"])
    vend = t["lfa1"].select(F.col("lifnr").alias("v_lifnr"), F.col("name1").alias("v_name1"))
    hd = hd.join(vend, spread_nulls("k_lifnr") == F.col("v_lifnr"), "left").drop("v_lifnr", SALT)
    return po.join(hd, spread_nulls("p_ebeln") == F.col("k_ebeln"), "left").drop(SALT, "k_ebeln")


@dataclass(frozen=True)
class RequisitionParts:
    """The sides that J3 joins to its requisition items, which do not depend on the range of days. Of a
    written form each slice of requisitions has a part of its own."""

    orders: DataFrame
    accounts: DataFrame
    n: int = 1
    k: int = 0

    def own(self, rows: DataFrame, key: Column) -> DataFrame:
        return rows if self.n == 1 else rows.where(in_slice(self.n, self.k, key))


def _rc_text(banfn: str) -> Column:
    """The first column of ``RC_KEY`` from the raw requisition number."""
    return K.py_strip(K.strip_key_or_null(F.col(banfn)))


def requisition_parts(t: dict[str, DataFrame], p: Params) -> RequisitionParts:
    return RequisitionParts(_requisition_orders(t, p), _requisition_accounts(t))


def requisition_parts_stored(t: dict[str, DataFrame], p: Params, n: int) -> list[RequisitionParts]:
    """The parts, written once, for ``n`` slices of requisitions."""
    accounts = store_by_slice(_requisition_accounts(t), n, _rc_text("u_banfn"), "requisition-accounts")
    orders = store_by_slice(_requisition_orders(t, p, store), n, _rc_text("p_banfn"), "requisition-orders")
    return [RequisitionParts(o, a, n, k) for k, (o, a) in enumerate(zip(orders, accounts))]


def _requisitions_joined(t: dict[str, DataFrame], p: Params, parts: RequisitionParts | None = None) -> DataFrame:
    """J3 as joined, with the dedup columns but without the derived ones; with written ``parts`` the rows of
    their slice.

    Every lookup is joined to the narrowest rows that have its key (assignment, PO header, PO item), and the
    two sides meet once on the requisition item, so that whole rows are shuffled once per side.
    """
    parts = requisition_parts(t, p) if parts is None else parts
    items = _requisition_items({**t, "eban": parts.own(t["eban"], _rc_text("banfn"))}, p, parts.accounts)
    x = items.join(parts.orders, (F.col("banfn") == F.col("p_banfn")) & (F.col("bnfpo") == F.col("p_bnfpo")), "left")
    x = x.filter(owned_by([F.col("ekgrp"), F.col("k_ekgrp")], F.col("k_ernam"), p))
    return x.drop("p_banfn", "p_bnfpo").withColumns({
        "cod_sap": K.strip_key(F.col("matnr")), "num_rc": K.strip_key_or_null(F.col("banfn")), "item_rc": F.col("bnfpo").cast("string"),
        "janela": D.first_window_index(D.sap_date(F.col("badat")), p.rc_total_days, p.rc_step_days, p.as_of),
        "_banfn": F.col("banfn"), "_ebeln": F.col("p_ebeln"), "_ebelp": F.col("p_ebelp")})


def _requisition_columns(x: DataFrame) -> DataFrame:
    """The columns of J3, with window and sort keys, from its joined rows."""
    cat = S.category(F.col("p_knttp"), F.col("knttp"))
    return x.select(
        S.stock_asset(F.col("a_equnr")).alias("ativo"),
        K.doc_id(F.col("acc_aufnr"), F.col("p_ebeln"), F.col("banfn")).alias("ordem"),
        "cod_sap",
        F.coalesce(F.col("m_maktx"), F.col("txz01")).alias("descricao"),
        F.coalesce(F.col("p_menge"), F.col("menge")).alias("qtd_req"),
        K.strip_key_or_null(F.coalesce(F.col("p_ebeln"), F.lit(""))).alias("pedido"),
        F.trim(F.coalesce(F.col("p_ebelp").cast("string"), F.col("bnfpo").cast("string"))).alias("num_operacao"),
        "num_rc", "item_rc",
        F.coalesce(F.col("k_ernam"), F.col("ekgrp")).alias("comprador"),
        F.col("ernam").alias("criado_por_sap"),
        F.col("badat").alias("data_requisicao"),
        K.strip_key_or_null(F.coalesce(F.col("k_lifnr"), F.lit(""))).alias("fornecedor_cod"),
        F.col("v_name1").alias("fornecedor_nome"),
        F.col("k_bedat").alias("data_emissao_pc"),
        F.col("data_remessa").alias("data_remessa_pc"),
        F.coalesce(F.col("p_netpr"), F.col("preis")).alias("vlr_unit"),
        F.coalesce(F.col("p_netwr"), F.col("menge") * F.col("preis")).alias("vlr_total"),  # SC-26
        F.nullif(F.trim(F.coalesce(F.col("p_knttp"), F.col("knttp"), F.lit(""))), F.lit("")).alias("knttp"),
        S.destination(cat).alias("destinacao"),
        S.consumption_type(cat).alias("tipo_consumo"),
        K.strip_key_or_null(F.coalesce(F.col("pk_kostl"), F.col("acc_kostl"), F.lit(""))).alias("centro_custo"),
        S.process_status(F.col("qtd_recebida"), F.col("p_menge"), F.col("k_frgrl"), F.col("p_ebeln"),
                         F.col("p_loekz"), F.col("loekz"), F.col("banfn")).alias("status_processo"),
        "janela", "_banfn", "_ebeln", "_ebelp")


def requisition_rows(t: dict[str, DataFrame], p: Params, parts: RequisitionParts | None = None) -> DataFrame:
    """J3 before the dedup: requisition items with their PO, lookups and status."""
    return _requisition_columns(_requisitions_joined(t, p, parts))


def RC_KEY() -> list[Column]:
    """Seen-set key of J3: RC number and item as Python ``str.strip()`` leaves them."""
    return [K.py_strip(F.col("num_rc")), K.py_strip(F.col("item_rc"))]


def RC_ORDER() -> list[Column]:
    """Seen-set order of J3: oldest window, RC number, then PO and PO item (S-3)."""
    return [F.col("janela").asc_nulls_last(), F.col("_banfn").asc_nulls_last(),
            F.col("_ebeln").asc_nulls_last(), F.col("_ebelp").asc_nulls_last()]


def requisition_flow_with_window(t: dict[str, DataFrame], p: Params, parts: RequisitionParts | None = None) -> DataFrame:
    """J3 rows after guard and dedup, with the window each was first kept in; with written ``parts`` those of
    their slice."""
    rows = K.require_keys(_requisitions_joined(t, p, parts), ["num_rc", "item_rc", "cod_sap"])
    # the seen-set key is the Python-stripped (RC, item) pair; the rows travel as joined and get their
    # derived columns afterwards
    return _requisition_columns(first_per_key(rows, RC_KEY(), RC_ORDER()))


def requisition_flow_stepped(t: dict[str, DataFrame], p: Params) -> DataFrame:
    """``requisition_flow_with_window``; over large files written in slices of requisitions."""
    rows = requisition_flow_with_window(t, p)
    n = slices_for(rows)
    if n == 1:
        return rows
    parts = requisition_parts_stored(t, p, n)
    return store_parts(lambda k: requisition_flow_with_window(t, p, parts[k]), n, "requisitions")


def requisition_flow(t: dict[str, DataFrame], p: Params) -> DataFrame:
    """Requisition-to-order flow, one row per requisition item (the flagship).

    Requisition items of the last ``rc_total_days`` days (dates read as
    dates, PF-17) with their PO item and header, five aggregated lookups
    (account assignment of RC and PO, received quantity, first delivery
    date, material text; JN-10), vendor and asset, the derived document id
    (SC-10), category labels (CL-2, CL-3) and process status (CL-1). The
    per-window seen-set of the reference is one dedup on (RC, item): oldest
    window, then RC number, then PO and PO item as tie-breakers (S-3).
    """
    return requisition_flow_stepped(t, p).select(*RC_COLUMNS)


def requisition_status_counts(t: dict[str, DataFrame], p: Params) -> DataFrame:
    """Run counters of J3 per process status: items and items with a PO (AG-18)."""
    rf = requisition_flow_with_window(t, p)
    return rf.groupBy("status_processo").agg(
        F.count(F.lit(1)).alias("itens"),
        F.count_if(F.coalesce(F.trim(F.col("pedido")), F.lit("")) != "").alias("com_pedido"))


def requisition_run_summary(t: dict[str, DataFrame], p: Params) -> DataFrame:
    """DL-3 / AG-18: the counters of J3's final envelope: items sent and items with a PO."""
    rf = requisition_flow_with_window(t, p)
    return run_summary(rf, {"total": F.count(F.lit(1)),
                            "com_pedido": F.count_if(F.coalesce(F.trim(F.col("pedido")), F.lit("")) != "")})
