"""Picking reservations with warehouse stock."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.functions import dates as D
from fleetlake.functions import keys as K
from fleetlake.functions import predicates as PR
from fleetlake.functions import status as S
from fleetlake.operators.dedup import first_per_key
from fleetlake.operators.lookups import salted_join, semi, spread_nulls, with_salt
from fleetlake.operators.stored import slices_for, store, store_by_slice, store_parts
from fleetlake.params import Params

# Fixed value: reservation text of items that are not stocked.
NOT_STOCKED = "Item não estocável"

PM_COLS = ["n_equipamento", "cod_tipo_ordem", ("tipo_ordem", "pm_tipo_ordem"), ("texto_breve", "pm_texto_breve"),
           "cod_prioridade", "cod_centro_trabalho", "prioridade", "cod_status_usuario", "status_usuario",
           "local_instalacao", "cod_grupo_plan", "grupo_plan", "cod_tipo_atividade", "tipo_atividade", "n_nota",
           "cod_responsavel", "responsavel", "cod_ultimo_modificador", "email_ultimo_modificador",
           ("data_ultima_modificacao", None), "hora_ultima_modificacao", ("datetime_ultima_modificacao", None),
           "n_plano_manutencao", "n_solicitacao_manutencao", "n_item_manutencao", "n_ultima_ordem", "aberta",
           ("data_criacao", None), "liberada", ("data_liberada", None), "encerrada_tecnicamente",
           ("data_encerrada_tecnicamente", None), "encerrada_comercialmente",
           ("data_encerrada_comercialmente", None), "marcado_eliminacao", "check_pipefy", ("dt_inicio_base", None),
           ("dt_fim_base", None), ("dt_venc_final", None)]


def base_reservations(t: dict[str, DataFrame], p: Params) -> DataFrame:
    """Open picking lines: storage location and movement type in the
    parameters, stocked items, category 'L' or blank, not deleted.

    ``sgtxt <> ...`` and ``xloek <> 'X'`` drop NULLs on purpose (PF-9, S-6).
    """
    p.need("storage_locations", "movement_types")
    r = t["resb"]
    r = r.filter(PR.in_any(F.col("lgort"), p.storage_locations) & (F.col("sgtxt") != NOT_STOCKED)
                 & PR.blank_or(F.col("postp"), "L")
                 & (F.col("xloek") != "X") & PR.in_any(F.col("bwart"), p.movement_types))
    return r.withColumn("chave_reserva", K.concat_key(F.col("rsnum"), 10, F.col("rspos"), 4))


def stock_by_material(t: dict[str, DataFrame], p: Params, materials: DataFrame | None = None) -> DataFrame:
    """AG-15: warehouse stock per material with lots and bin positions.

    Stock rows of the warehouse with positive quantity, material number from
    the material master; summed per (material, lot) with the distinct bins
    joined by ' | ', then per material with 'lot - bins' labels joined by
    ' / ' (sorted, S-10). ``materials`` restricts to the given stripped
    material numbers (a semi join, O-4). Both groupings are partial + final
    hash aggregations; the label lists are bounded by the lots and bins of a
    material.
    """
    p.need("stock_warehouse")
    aqua, mara = t["aqua"], t["mara"]
    m = mara.select(F.col("scm_matid_guid16").alias("matid"), K.strip_key(F.col("matnr")).alias("material"))
    if materials is not None:
        # the master is cut to the wanted materials first; stock without a master row is of none of them,
        # so it need not travel under one NULL material
        m = semi(m, materials, [F.col("material")], [F.col(materials.columns[0])])
    e = aqua.filter((F.col("lgnum") == p.stock_warehouse) & (F.col("quan") > 0)).join(
        m, "matid", "left" if materials is None else "inner")
    e = e.select("material",
                 F.coalesce(F.trim(F.col("charg")), F.lit("")).alias("lote"),
                 F.coalesce(F.col("lgpla"), F.lit("")).alias("posicao"),
                 F.coalesce(F.col("quan"), F.lit(0)).alias("quantidade"))
    # AG-14: STRING_AGG(DISTINCT ...) without order -> distinct bins, sorted (S-10)
    per_lot = e.groupBy("material", "lote").agg(
        F.sum("quantidade").alias("qtd_lote"),
        F.array_join(F.array_sort(F.collect_set("posicao")), " | ").alias("posicoes"))
    label = K.label(F.col("lote"), F.col("posicoes"))
    return per_lot.groupBy("material").agg(
        F.sum("qtd_lote").alias("saldo_estoque"),
        F.when(F.count(label) > 0, F.array_join(F.array_sort(F.collect_list(label)), " / ")).alias(
            "lotes_com_posicoes"))


def latest_approval(t: dict[str, DataFrame], p: Params, base: DataFrame) -> DataFrame:
    """AG-8: newest workflow entry per reservation key (date, then hour,
    descending, NULLs last), restricted to keys of open lines (JN-16)."""
    z = t["ztwf_log_wf"].withColumn("chave", F.trim(F.col("chave").cast("string")))
    z = semi(z, base, [F.col("chave")], [F.col("chave_reserva")])
    z = z.select("chave", F.nullif(F.trim(F.col("acao").cast("string")), F.lit("")).alias("status"),
                 F.nullif(F.trim(F.col("data").cast("string")), F.lit("")).alias("data_ap"),
                 F.nullif(F.trim(F.col("hora").cast("string")), F.lit("")).alias("hora_ap"),
                 F.col("data").alias("_d"), F.col("hora").alias("_h"))
    best = first_per_key(z, "chave", [F.col("_d").desc_nulls_last(), F.col("_h").desc_nulls_last()],
                         [F.col(c).asc_nulls_last() for c in ("status", "data_ap", "hora_ap")])
    return best.select("chave", "status", "data_ap", "hora_ap")


def users(t: dict[str, DataFrame]) -> DataFrame:
    u, a = t["usr21"], t["adrp"]
    x = u.join(a.select(F.trim(F.col("persnumber")).alias("pn"), "name_text"),
               F.trim(u.persnumber) == F.col("pn"), "left")
    return x.select(F.trim(F.col("bname")).alias("bname_chave"), F.col("name_text").alias("nome_usuario")).distinct()


def order_headers(t: dict[str, DataFrame], p: Params, lines: DataFrame) -> DataFrame:
    """Reservation header -> order -> order type, cost centre, profit-centre
    and asset texts, order-view columns and user names, at reservation grain.

    These joins depend only on the reservation number, so they run on the
    headers of the given open ``lines`` and join the lines once on ``rsnum``.
    Headers without an order (manual reservations, possibly most of them)
    carry NULL keys through the chain: each join spreads them.
    """
    rkpf = t["rkpf"].select("rsnum", F.col("aufnr").alias("r_aufnr"), "rsdat", "usnam", "lastchangedbyuser",
                            "lastchangedatetime")
    rkpf = with_salt(semi(rkpf, lines, [F.col("rsnum")], [lines.rsnum]), ["rsnum"])
    aufk = t["aufk"].select(F.col("aufnr").alias("k_aufnr"), F.col("auart"), F.col("kostl").alias("k_kostl"),
                            F.col("ernam").alias("criador_ordem"), F.col("aenam").alias("ult_mod_ordem"))
    h = rkpf.join(aufk, spread_nulls("r_aufnr") == F.col("k_aufnr"), "left")
    tipos = t["t003p"].filter(F.col("spras") == "P").select(F.col("auart").alias("t_auart"), F.col("txt").alias("t_txt"))
    h = h.join(tipos, spread_nulls("auart") == F.col("t_auart"), "left")
    csks = t["csks"].select(F.col("kostl").alias("c_kostl"), F.col("prctr").alias("c_prctr"))
    h = h.join(csks, spread_nulls("k_kostl") == F.col("c_kostl"), "left")
    cepct = t["cepct"].select(F.col("prctr").alias("e_prctr"), F.col("ltext"))
    h = h.join(cepct, spread_nulls("c_prctr") == F.col("e_prctr"), "left")
    anlh = t["anlh"].select(F.trim(F.col("anln1")).alias("anln1"), "anlhtxt")
    h = h.join(anlh, spread_nulls("k_kostl") == F.col("anln1"), "left")
    pm = t["pm_order_view"]
    pm_sel = [F.col("n_ordem").alias("pm_n_ordem")]
    for c in PM_COLS:
        if isinstance(c, tuple):
            src, dst = c
            pm_sel.append(D.null_date(F.col(src)).alias(src) if dst is None else F.col(src).alias(dst))
        else:
            pm_sel.append(F.col(c))
    pmx = pm.select(*pm_sel)
    h = h.join(pmx, spread_nulls(K.as_long(F.col("k_aufnr")).cast("string")) == K.as_long(F.col("pm_n_ordem")).cast("string"), "left")
    u = users(t)
    u1 = u.select(F.col("bname_chave").alias("u1_b"), F.col("nome_usuario").alias("nome_criador_reserva"))
    u2 = u.select(F.col("bname_chave").alias("u2_b"), F.col("nome_usuario").alias("nome_ult_mod_reserva"))
    h = h.join(u1, spread_nulls(F.trim(F.col("usnam"))) == F.col("u1_b"), "left")
    h = h.join(u2, spread_nulls(F.trim(F.col("lastchangedbyuser"))) == F.col("u2_b"), "left")
    return h


def _line_values(x: DataFrame, right: DataFrame, value: str) -> DataFrame:
    """Left join of a table on the reservation line for its different values of one column. Equal values of
    a line would only give rows that the final DISTINCT removes (AG-7)."""
    keys = [F.col("rsnum").alias("v_rsnum"), F.col("rspos").alias("v_rspos")]
    found = right.groupBy(*keys).agg(F.collect_set(F.struct(value)).alias("__values"))
    out = x.join(found, (F.col("rsnum") == F.col("v_rsnum")) & (F.col("rspos") == F.col("v_rspos")), "left")
    return out.drop("v_rsnum", "v_rspos").select("*", F.explode_outer("__values").alias("__v")).withColumn(
        value, F.col(f"__v.{value}")).drop("__values", "__v")


def picking_reservations(t: dict[str, DataFrame], p: Params) -> DataFrame:
    """Open picking lines with header, approval, stock and order data.

    Seven CTEs and fourteen left joins of the reference become: open lines
    (base), header joins at reservation grain (``order_headers``), line
    joins (approval by key, creation date and delivery by line, material
    text, stock by material), then the final DISTINCT (AG-7). Text keys are
    cast with ``try_cast`` (S-4), the sentinel date becomes NULL (SC-24),
    the change stamp becomes DD-MM-YYYY (SC-25).

    Over large files headers, approvals and lines are written first, and they meet in slices of reservations.
    """
    base = base_reservations(t, p)
    rows = _picking_rows(_picking_lines(t, p, base), order_headers(t, p, base), latest_approval(t, p, base))
    n = slices_for(rows)
    if n == 1:
        return rows
    key = K.int_text(F.col("rsnum"))  # a column of the result: equal rows are in one slice
    h = store_by_slice(order_headers(t, p, base), n, key, "reservation-headers")
    ar = store(latest_approval(t, p, base), "approvals")
    x = store_by_slice(_picking_lines(t, p, base), n, key, "picking-lines")
    return store_parts(lambda k: _picking_rows(x[k], h[k], ar), n, "picking")


def _picking_lines(t: dict[str, DataFrame], p: Params, base: DataFrame) -> DataFrame:
    """The open lines with the lookups of a line and of its material."""
    mats = base.select(K.strip_key(F.col("matnr")).alias("material_limpo")).distinct()
    stock = stock_by_material(t, p, mats)
    makt = t["makt"].filter(F.col("spras") == "P").select(K.strip_key(F.col("matnr")).alias("m_key"), "maktx").distinct()
    x = base.withColumn("mkey", K.strip_key(F.col("matnr")))
    x = _line_values(x, t["rsadd"], "creadat")
    x = _line_values(x, t["lips"], "vbeln")
    # lines without a material all carry the blank key: salt it so that one
    # key does not land in one task (the texts and stock for '' are few rows)
    x = salted_join(x, makt, F.col("mkey"), F.col("m_key"), [""], name="mk")
    return salted_join(x, stock, F.col("mkey"), F.col("material"), [""], name="st")


def _picking_rows(x: DataFrame, h: DataFrame, ar: DataFrame) -> DataFrame:
    """J14 from lines, headers and approvals."""
    # the header is the widest side: its columns travel once, with the approval's key, which is a column
    # of the result, so that the DISTINCT finds equal rows in one place
    x = x.join(h, "rsnum", "left")
    x = x.join(ar, F.col("chave_reserva") == F.col("chave"), "left")
    pm_out = [F.col(c[1] if isinstance(c, tuple) and c[1] else (c[0] if isinstance(c, tuple) else c))
              for c in PM_COLS]
    out = x.select(
        K.int_text(F.col("rsnum")).alias("numero_reserva"),
        K.strip_key(F.col("matnr")).alias("codigo"),
        F.col("maktx").alias("descr_material"),
        F.col("bdmng").alias("qtd_reserva"),
        F.coalesce(F.col("enmng"), F.lit(0)).alias("qtd_retirada"),
        F.col("kzear").alias("item_baixado"),
        K.int_text(F.col("rspos")).alias("numero_item"),
        F.col("chave_reserva").alias("chave"),
        K.int_text(F.col("k_aufnr")).alias("numero_ordem"),
        # SC-27: creation date from the item addition, else the header
        F.when(F.col("creadat").isNotNull(), F.col("creadat")).otherwise(F.col("rsdat")).alias("data"),
        F.col("werks").alias("centro"),
        F.col("lgort").alias("deposito"),
        S.movement_label(F.col("bwart")).alias("descricao_movimentacao"),
        F.coalesce(F.col("t_txt"), F.lit("")).alias("tipo_ordem"),
        F.coalesce(F.col("c_kostl"), F.lit("")).alias("centro_custo"),
        S.asset_text(F.col("k_kostl"), F.col("ltext"), F.col("anlhtxt")).alias("descricao_ativo"),
        F.col("usnam").alias("criador_reserva"),
        "nome_criador_reserva",
        F.col("lastchangedbyuser").alias("ult_mod_reserva"),
        "nome_ult_mod_reserva",
        D.stamp_dmy(F.col("lastchangedatetime")).alias("data_ult_mod_reserva"),
        "criador_ordem", "ult_mod_ordem",
        F.col("status").alias("aprovacao_reserva"),
        F.col("data_ap").alias("data_aprovacao"),
        F.col("hora_ap").alias("hora_aprovacao"),
        F.col("sgtxt").alias("texto"),
        F.col("wempf").alias("recebedor"),
        F.col("ablad").alias("ponto_descarga"),
        F.col("xwaok").alias("status_aprovacao_sap"),
        F.col("vbeln").alias("remessa"),
        F.col("objnr").alias("chavejest"),
        F.col("xloek").alias("cancelado"),
        F.col("kzear").alias("finalizado"),
        "lotes_com_posicoes",
        F.coalesce(F.col("saldo_estoque"), F.lit(0)).alias("saldo_estoque"),
        *pm_out,
    )
    return out.distinct()
