"""Maintenance order jobs."""

from __future__ import annotations

import logging
import threading

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.functions import dates as D
from fleetlake.functions import keys as K
from fleetlake.functions import status as S
from fleetlake.operators.dedup import best_per_key, first_per_key
from fleetlake.operators.batches import clean_fields, run_summary
from fleetlake.operators.stored import Step, by_size, reason, store, whole
from fleetlake.operators.lookups import enrich_header, semi, spread_nulls, text_lookup, with_salt
from fleetlake.params import Params
from fleetlake.functions.predicates import in_any, like_any, since

log = logging.getLogger(__name__)


def join_sorted(values: Column, sep: str, distinct: bool = False) -> Column:
    """AG-12/AG-13 as an aggregate: the values sorted, joined by ``sep``.

    NULLs are skipped and no value gives NULL (``STRING_AGG`` semantics).
    With ``distinct`` it is ``collect_set``, which also de-duplicates
    map-side; the list length is bounded by the distinct status texts.
    """
    arr = F.collect_set(values) if distinct else F.collect_list(values)
    return F.when(F.size(arr) > 0, F.array_join(F.sort_array(arr), sep))


# --------------------------------------------------------------------- J11
def _pm_branch_orders(t: dict[str, DataFrame], p: Params) -> DataFrame:
    p.need("branch_codes")
    pm = t["pm_order_view"]
    return pm.filter(like_any("cod_centro_trabalho", p.branch_codes)
                     & since(F.col("data_criacao"), p.orders_since))


def work_orders_latest(t: dict[str, DataFrame], p: Params) -> DataFrame:
    """J11 rows: newest shop / preparation order per asset and kind.

    Kind from activity code or description (CL-7); newest by creation date,
    the order number breaking ties (WN-1, S-3); phase (CL-10) and branch
    (CL-11) derived. The creation date is read with SC-17.
    """
    # PF-2: all columns plus a computed one
    c = _pm_branch_orders(t, p).withColumn(
        "tipo_manutencao", S.maintenance_kind(F.col("cod_tipo_atividade"), F.col("tipo_atividade")))
    c = c.filter(F.col("tipo_manutencao").isin(S.KIND_SHOP, S.KIND_PREP))
    c = c.withColumn("_d", D.sap_date(F.col("data_criacao")))
    best = first_per_key(c, ["n_equipamento", "tipo_manutencao"], [F.col("_d").desc_nulls_first()],
                         [F.col("n_ordem").desc_nulls_first()])
    return best.select(
        F.col("n_equipamento").alias("ativo"),
        S.branch(F.col("cod_centro_trabalho"), p.branch_codes).alias("filial"),
        K.strip_zeros(F.col("n_ordem")).alias("ordem"),
        "tipo_manutencao", "tipo_atividade",
        F.col("prioridade").alias("criticidade"),
        S.order_phase(F.col("encerrada_comercialmente"), F.col("encerrada_tecnicamente"),
                      F.col("liberada")).alias("fase_os"),
        F.col("status_usuario"),
        F.col("_d").alias("data_criacao"))


def work_order_details(t: dict[str, DataFrame], p: Params, step: Step = whole) -> DataFrame:
    """J11 details: header and operations of the newest order per asset and kind. ``step``: what is done with
    the operations before their values are looked up (see ``stored``).

    Orders from the base tables of branch work centres (JN-21 chain
    order -> plan -> operation -> work/work centre), newest per (asset,
    kind) by creation date then order number (WN-2). Operation status is the
    sorted, space-joined list of active system status texts (AG-13, S-10).
    """
    p.need("branch_codes")
    aufk, afih = t["aufk"].select("aufnr", "ktext", "erdat", "ernam", "idat1"), t["afih"]
    crhd = t["crhd"].select(F.col("objid"), F.col("arbpl"))
    base = aufk.join(afih.select("aufnr", "equnr", "gewrk", "ilart"), "aufnr")
    base = base.join(crhd.withColumnRenamed("objid", "gewrk").withColumnRenamed("arbpl", "centro_trabalho_cabecalho"),
                     "gewrk", "left")
    base = base.filter(since(F.col("erdat"), p.orders_since) & like_any("centro_trabalho_cabecalho", p.branch_codes))
    il = F.col("ilart")
    base = base.withColumn("tipo_manutencao",
                           F.when((il == "PRP") | il.contains("PRP"), F.lit(S.KIND_PREP))
                           .when((il == "OFI") | il.contains("OFI"), F.lit(S.KIND_SHOP))
                           .otherwise(F.lit(S.KIND_OTHER)))
    base = base.filter(F.col("tipo_manutencao").isin(S.KIND_SHOP, S.KIND_PREP))
    champ = first_per_key(base, ["equnr", "tipo_manutencao"],
                          [D.sap_date(F.col("erdat")).desc_nulls_first(), F.col("aufnr").desc_nulls_first()])
    # plan values per order: the join and the aggregation share the
    # partitioning on the order number (an order is champion of one group
    # only), so grouping by all champion columns needs no extra shuffle and
    # the champions are read once for header, plan and operations
    afko = t["afko"].select("aufnr", "gstrp", "gltrp", "rsnum", "aufpl")
    x = champ.join(afko, "aufnr").groupBy(*champ.columns).agg(
        F.max("gstrp").alias("data_inicio_programada"), F.max("gltrp").alias("data_fim_programada"),
        F.max("rsnum").alias("rsnum"), F.max("aufpl").alias("aufpl"))
    afvc, afvv = t["afvc"], t["afvv"]
    ops = step(x.join(afvc, "aufpl"), "operations")
    ops = ops.join(afvv, ["aufpl", "aplzl"], "left")
    ops = ops.join(crhd.withColumnRenamed("objid", "arbid").withColumnRenamed("arbpl", "centro_trabalho_operacao"),
                   "arbid", "left")
    ops = ops.withColumnRenamed("vornr", "num_operacao").withColumnRenamed(
        "ltxa1", "descricao_operacao").withColumnRenamed("arbei", "tempo_previsto_h")
    # The texts of an object are aggregated after the operations are joined, as in the reference: an object
    # that several operation rows share has its texts once per row. The rows of an object are gathered
    # first (rows without one stay apart), so that only their statuses are read and the operations flow
    # through once; join and grouping share the partitioning.
    marks = t["jest"].filter(F.col("inact") == "").join(
        t["tj02t"].filter(F.col("spras").isin("P", "PT", "pt", "p")), F.col("stat") == F.col("istat")).select(
        F.col("objnr").alias("s_objnr"), "txt04")
    apart = F.concat(F.lit("\u0000"), F.xxhash64("aufnr", "aplzl").cast("string"))
    whole = F.struct(*[F.col(c) for c in ops.columns])
    by_object = ops.groupBy(F.coalesce("objnr", apart).alias("__obj")).agg(F.collect_list(whole).alias("__rows"))
    texts = by_object.join(marks, F.col("__obj") == F.col("s_objnr"), "left").groupBy("__obj").agg(
        F.first("__rows").alias("__rows"), F.collect_list("txt04").alias("__texts"))
    out = texts.withColumn("__n", F.size("__rows")).select("__n", "__texts", F.inline("__rows"))
    out = out.withColumn("__texts", F.flatten(F.array_repeat("__texts", F.col("__n"))))
    out = out.withColumn("status_operacao", F.when(F.size("__texts") > 0, F.array_join(F.sort_array("__texts"), " ")))
    return out.select(
        F.col("equnr").alias("ativo"), K.strip_zeros(F.col("aufnr")).alias("ordem"), "tipo_manutencao",
        F.col("ktext").alias("descricao_os"), F.col("centro_trabalho_cabecalho").alias("centro_trabalho_responsavel"),
        "data_inicio_programada", "data_fim_programada", F.col("idat1").alias("data_liberacao"),
        F.col("ernam").alias("autor_os"), "num_operacao", "descricao_operacao", "centro_trabalho_operacao",
        "tempo_previsto_h", "status_operacao", F.col("aufnr").alias("_aufnr"))


def _detail_order() -> list[Column]:
    return [F.col("ativo").asc_nulls_last(), F.col("_aufnr").asc_nulls_last(),
            F.col("num_operacao").asc_nulls_last()]


def _detail_tie() -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in
            ("descricao_operacao", "centro_trabalho_operacao", "tempo_previsto_h", "status_operacao")]


HEADER_EXTRA = ["descricao_os", "centro_trabalho_responsavel", "data_inicio_programada", "data_fim_programada",
                "data_liberacao", "autor_os"]
OPERATION_DDL = ("ativo string, ordem string, num_operacao string, descricao_operacao string, centro_trabalho_operacao string, "
                 "tempo_previsto_h decimal(7,1), status_operacao string, _aufnr string")
DETAIL_SOURCES = ("aufk", "afih", "crhd", "afko", "afvc", "afvv", "jest", "tj02t")
# SAP date fields cleaned in the work-order payload (JS-2).
SAP_DATE_FIELDS = ("data_criacao", "data_inicio_programada", "data_fim_programada", "data_liberacao")


def _trimmed(c: str) -> Column:
    return K.py_strip(F.coalesce(F.col(c).cast("string"), F.lit("")))


def operations_of(details: DataFrame) -> DataFrame:
    """J11 ``operacoes``: distinct (asset, order, operation), first row wins (AG-9); with the raw order
    number that they sort by."""
    k = details.select(_trimmed("ativo").alias("k_ativo"), _trimmed("ordem").alias("k_ordem"),
                       _trimmed("num_operacao").alias("k_op"), "*").filter(
        (F.col("k_ativo") != "") & (F.col("k_ordem") != "") & (F.col("k_op") != ""))
    best = first_per_key(k, ["k_ativo", "k_ordem", "k_op"], _detail_order(), _detail_tie())
    return best.select(F.col("k_ativo").alias("ativo"), F.col("k_ordem").alias("ordem"),
                       F.col("k_op").alias("num_operacao"), "descricao_operacao", "centro_trabalho_operacao",
                       "tempo_previsto_h", "status_operacao", "_aufnr")


def without_headers(rows: DataFrame) -> DataFrame:
    """BF-4: the details are optional; without them the rows go out with empty header fields."""
    return rows.select("*", *[F.lit(None).cast("date" if c.startswith("data_") else "string").alias(c)
                              for c in HEADER_EXTRA])


def with_headers(rows: DataFrame, details: DataFrame) -> DataFrame:
    """J11 ``rows`` with header fields of the details query (JN-18).

    Per (asset, order), trimmed, the first details row gives the extra
    header fields; they overwrite on a match. The two queries pick 'newest'
    from different sources, so only rows where both chose the same order are
    enriched. SAP date fields are read with SC-17 (JS-2).
    """
    d = details.withColumn("k_ativo", _trimmed("ativo")).withColumn("k_ordem", _trimmed("ordem"))
    d = d.filter((F.col("k_ativo") != "") & (F.col("k_ordem") != ""))
    hdr = first_per_key(d, ["k_ativo", "k_ordem"], _detail_order(), _detail_tie()).select(
        "k_ativo", "k_ordem", *HEADER_EXTRA)
    hdr = clean_fields(hdr, SAP_DATE_FIELDS)
    r = rows.withColumn("k_ativo", _trimmed("ativo")).withColumn("k_ordem", _trimmed("ordem"))
    return enrich_header(r, hdr, ["k_ativo", "k_ordem"], HEADER_EXTRA).drop("k_ativo", "k_ordem")


def work_order_operations(t: dict[str, DataFrame], p: Params) -> DataFrame:
    """J11 ``operacoes`` by themselves."""
    return operations_of(work_order_details(t, p)).drop("_aufnr")


def work_order_enriched(t: dict[str, DataFrame], p: Params) -> DataFrame:
    """J11 ``rows`` by themselves; without the details sources their header fields are empty (BF-4)."""
    rows = work_orders_latest(t, p)
    if any(n not in t for n in DETAIL_SOURCES):
        return without_headers(rows)
    return with_headers(rows, work_order_details(t, p))


class DetailsFailed(RuntimeError):
    """The run of the work order details failed; the message holds its error."""


class WorkOrderBlock:
    """J11 as the hourly run delivers it: ``rows`` and ``operacoes`` from one run of the details (BF-4).

    The details are written once to the session's shared folder, the only place where they run, and
    both lists read them from there. If a source is not configured (SRC-4), ``error`` names it, ``rows`` go
    out with empty header fields and ``operacoes`` are empty. A run that fails is no result: both lists raise
    ``DetailsFailed``, unless the caller asks for the ``fallback``, which gives the same as without the
    source, and reports ``error``. Safe to use from several threads.
    """

    def __init__(self, t: dict[str, DataFrame], p: Params):
        self._t, self._p = t, p
        self._lock = threading.Lock()
        self._tried = False
        self._details: DataFrame | None = None
        self._failure: Exception | None = None
        self.error: str | None = None

    def details(self, fallback: bool = False) -> DataFrame | None:
        with self._lock:
            if not self._tried:
                self._tried = True
                lacking = [n for n in DETAIL_SOURCES if n not in self._t]
                if lacking:
                    self.error = "missing sources: " + ", ".join(lacking)
                    log.warning("work order details left out: %s", self.error)
                else:
                    self._run()
            if self._failure is not None and not fallback:
                raise DetailsFailed(self.error) from self._failure
            return self._details

    def _run(self) -> None:
        try:
            self._details = store(work_order_details(self._t, self._p, by_size), "details")
        except Exception as e:  # noqa: BLE001 - whatever breaks it, each caller is told
            self._failure, self.error = e, reason(e)
            log.error("work order details failed: %s", self.error)

    def note(self) -> tuple[str, str] | None:
        """Status and text of the manifest rows of lists that went out without the details."""
        return None if self.error is None else ("ok" if self._failure is None else "partial", f"work order details left out: {self.error}")

    def rows(self, fallback: bool = False) -> DataFrame:
        rows, details = work_orders_latest(self._t, self._p), self.details(fallback)
        return without_headers(rows) if details is None else with_headers(rows, details)

    def operations(self, fallback: bool = False) -> DataFrame:
        details = self.details(fallback)
        if details is None:
            spark = next(iter(self._t.values())).sparkSession
            return spark.createDataFrame([], OPERATION_DDL)
        return operations_of(details)


# --------------------------------------------------------------------- J6
EWO_HEADER = ["ordem", "ativo", "situacao_os", "status_usuario", "status_usuario_desc", "status_sistema",
              "tipo_manutencao", "tipo_manutencao_real", "descricao_os", "criticidade", "desc_prioridade", "priok",
              "centro_trabalho", "cod_responsavel", "responsavel", "autor_os", "data_criacao", "data_liberacao",
              "data_inicio_programada", "data_fim_programada", "data_inicio_real", "data_fim_real",
              "data_enc_tecnico", "data_enc_comercial"]
OP_FIELDS = ["num_operacao", "descricao_operacao", "centro_trabalho_operacao", "tempo_previsto_h"]
EWO_ROW_HEADER = ["ativo", "situacao_os", "status_os_usuario", "status_os_usuario_descricao", "status_os_sistema",
                  "tipo_manutencao", "tipo_manutencao_real", "descricao_os", "centro_trabalho_responsavel",
                  "cod_responsavel", "responsavel", "autor_os", "data_criacao", "data_liberacao",
                  "data_inicio_programada", "data_fim_programada", "data_inicio_real", "data_fim_real",
                  "data_enc_tecnico", "data_enc_comercial"]


def order_status_texts(t: dict[str, DataFrame], orders: DataFrame) -> DataFrame:
    """AG-12, CL-9 texts: active user and system statuses of the given orders.

    Status rows of the orders' objects (semi join on the trimmed object
    number), not inactive (NULL-safe, S-6), with system texts and the user
    texts of the object's status profile; per object the distinct texts
    sorted and joined ('' separators as the reference), NULL when none.
    """
    jest = t["jest"].filter(F.coalesce(F.col("inact").cast("string"), F.lit("")) != "X")
    jest = semi(jest, orders, [F.trim(F.col("objnr"))], [F.trim(F.col("objnr"))])
    st = t["tj02t"].filter(F.col("spras") == "P").select("istat", F.col("txt04").alias("st_txt04"))
    js = t["jsto"].select(F.trim(F.col("objnr")).alias("js_objnr"), F.trim(F.col("stsma")).alias("js_stsma"))
    su = t["tj30t"].filter(F.col("spras") == "P").select(
        "estat", F.trim(F.col("stsma")).alias("su_stsma"), F.col("txt04").alias("su_txt04"),
        F.col("txt30").alias("su_txt30"))
    j = (jest.join(st, F.col("stat") == F.col("istat"), "left")
         .join(js, F.trim(F.col("objnr")) == F.col("js_objnr"), "left")
         .join(su, (F.col("stat") == F.col("estat")) & (F.col("su_stsma") == F.col("js_stsma")), "left"))
    return j.groupBy(F.trim(F.col("objnr")).alias("so_objnr")).agg(
        join_sorted(F.col("su_txt04"), " ", distinct=True).alias("status_os_usuario"),
        join_sorted(F.col("su_txt30"), " | ", distinct=True).alias("status_os_usuario_descricao"),
        join_sorted(F.col("st_txt04"), " ", distinct=True).alias("status_os_sistema"))


def order_status_text(t: dict[str, DataFrame], p: Params) -> DataFrame:
    """AG-12 / CL-9 on all orders: life-cycle situation and status texts per order."""
    aufk = t["aufk"]
    so = order_status_texts(t, aufk.select("objnr"))
    o = aufk.select("aufnr", "objnr", S.order_situation(F.col("loekz"), F.col("phas3"), F.col("phas2"),
                                                        F.col("phas1"), F.col("phas0")).alias("situacao_os"))
    return o.join(so, F.trim(F.col("objnr")) == F.col("so_objnr"), "left").select(
        K.strip_zeros(F.col("aufnr")).alias("ordem"), "situacao_os", "status_os_usuario",
        "status_os_usuario_descricao", "status_os_sistema")


def external_order_rows(t: dict[str, DataFrame], p: Params) -> DataFrame:
    """J6 flat rows: order x operation, as the SQL of the reference returns them."""
    p.need("responsibles")
    aufk, afih = t["aufk"], t["afih"]
    crhd = t["crhd"]
    resp = t["pa0001"].groupBy(F.col("pernr").cast("string").alias("pernr")).agg(
        F.max("ename").alias("responsavel"))
    base = aufk.join(afih.select("aufnr", "equnr", "gewrk", "ilart", "priok", "maintordpersonresponsible"),
                     "aufnr")
    base = base.filter(since(F.col("erdat"), p.orders_since)
                       & in_any(K.strip_key(F.col("maintordpersonresponsible").cast("string")), p.responsibles))
    base = base.join(crhd.select(F.col("objid").alias("gewrk"), F.col("arbpl").alias("centro_trabalho_cabecalho")),
                     "gewrk", "left")
    base = base.join(resp, F.col("maintordpersonresponsible").cast("string") == F.col("pernr"), "left")
    base = base.select(
        "aufnr", "objnr", F.col("ktext").alias("descricao_os"), F.col("erdat").alias("data_criacao"),
        F.col("ernam").alias("autor_os"), F.col("idat1").alias("data_liberacao"),
        F.col("idat2").alias("data_enc_tecnico"), F.col("idat3").alias("data_enc_comercial"),
        F.col("equnr").alias("ativo"), "centro_trabalho_cabecalho",
        F.col("maintordpersonresponsible").alias("cod_responsavel"), "responsavel",
        F.col("ilart").alias("tipo_manutencao_real"), "priok",
        S.priority_label(F.col("priok")).alias("desc_prioridade"),
        S.maintenance_kind_code(F.col("ilart")).alias("tipo_manutencao"),
        S.order_situation(F.col("loekz"), F.col("phas3"), F.col("phas2"), F.col("phas1"),
                          F.col("phas0")).alias("situacao_os"))
    afko = t["afko"].select("aufnr", "gstrp", "gltrp", "gstri", "getri", "aufpl")
    # plan values per order; grouping by all base columns right after the
    # join on the order number needs no extra shuffle (base is one row per
    # order), so the base orders flow through plan and operations once
    x = base.join(afko, "aufnr", "left").groupBy(*base.columns).agg(
        F.max("gstrp").alias("data_inicio_programada"), F.max("gltrp").alias("data_fim_programada"),
        F.max("gstri").alias("data_inicio_real"), F.max("getri").alias("data_fim_real"),
        F.max("aufpl").alias("aufpl"))
    # orders without a plan, and so without operation and work centre, carry NULL keys: spread them
    x = with_salt(x, ["aufnr"])
    afvc = t["afvc"].select(F.col("aufpl").alias("c_aufpl"), "aplzl", "vornr", "ltxa1", "arbid")
    afvv = t["afvv"].select(F.col("aufpl").alias("v_aufpl"), F.col("aplzl").alias("v_aplzl"), "arbei")
    place = crhd.select(F.col("objid").alias("c_objid"), F.col("arbpl").alias("centro_trabalho_operacao"))
    ops = x.join(afvc, spread_nulls("aufpl") == F.col("c_aufpl"), "left")
    ops = ops.join(afvv, (spread_nulls("c_aufpl") == F.col("v_aufpl")) & (F.col("aplzl") == F.col("v_aplzl")), "left")
    ops = ops.join(place, spread_nulls("arbid") == F.col("c_objid"), "left")
    ops = ops.withColumnRenamed("vornr", "num_operacao").withColumnRenamed(
        "ltxa1", "descricao_operacao").withColumnRenamed("arbei", "tempo_previsto_h")
    so = order_status_texts(t, base)
    rows = ops.join(so, F.trim(F.col("objnr")) == F.col("so_objnr"), "left")
    return rows.select(
        "ativo", K.strip_zeros(F.col("aufnr")).alias("ordem"), "situacao_os", "status_os_usuario",
        "status_os_usuario_descricao", "status_os_sistema", "tipo_manutencao", "tipo_manutencao_real",
        "descricao_os", "priok", "desc_prioridade", F.col("centro_trabalho_cabecalho").alias("centro_trabalho_responsavel"),
        "cod_responsavel", "responsavel", "data_inicio_programada", "data_fim_programada", "data_inicio_real",
        "data_fim_real", "data_liberacao", "data_enc_tecnico", "data_enc_comercial", "data_criacao", "autor_os",
        *OP_FIELDS, F.col("aufnr").alias("_aufnr"))


def external_work_orders(t: dict[str, DataFrame], p: Params) -> DataFrame:
    """J6 as delivered: one row per external work order with its operations nested."""
    return external_work_orders_rows(t, p).drop("_aufnr")


def external_work_orders_rows(t: dict[str, DataFrame], p: Params) -> DataFrame:
    """J6 with the raw order number that it sorts by.

    Flat rows are grouped per zero-stripped order (AG-16). Header fields come
    from the first row under the reference's order (asset, order number
    descending, operation); priority and criticality take the first
    non-blank value, so a later row can fill a blank one (AG-17, CL-12).
    Operations are made unique per trimmed number, first row wins, and
    nested sorted by number (SO-5).

    Plan: the flat rows are read once by a two-level aggregation, first per
    (order, operation number) then per order. Every "first row" is a
    ``min_by`` over one ascending sort key (the descending order number is
    encoded by ``desc_text_key``), so both levels combine map-side, no
    window sorts a whole order in one task, and the nested list is bounded
    by the distinct operation numbers of an order.
    """
    r = external_order_rows(t, p)
    r = r.withColumn("k", F.ltrim(K.py_strip(F.coalesce(F.col("ordem"), F.lit(""))), F.lit("0"))).filter(
        F.col("k") != "")
    r = r.withColumn("op_key", K.py_strip(F.col("num_operacao").cast("string")))
    sort_key = F.struct(
        F.col("ativo").isNull(), F.col("ativo"), K.desc_text_key(F.col("_aufnr")),
        F.col("num_operacao").isNull(), F.col("num_operacao"),
        *[c for n in ("descricao_operacao", "centro_trabalho_operacao", "tempo_previsto_h")
          for c in (F.col(n).isNull(), F.col(n))])
    header = F.struct(*[F.col(c) for c in EWO_ROW_HEADER], F.col("_aufnr"))
    op = F.struct(*[F.col(c) for c in OP_FIELDS[1:]])

    def nb(c):
        v = F.col(c)
        return v.isNotNull() & (F.trim(v.cast("string")) != "")

    lvl1 = r.withColumn("_o", sort_key).groupBy("k", "op_key").agg(
        F.min_by(header, F.col("_o")).alias("h"), F.min("_o").alias("hk"),
        F.min_by(F.when(nb("priok"), F.col("priok")), F.when(nb("priok"), F.col("_o"))).alias("fp"),
        F.min(F.when(nb("priok"), F.col("_o"))).alias("fpk"),
        F.min_by(F.when(nb("desc_prioridade"), F.col("desc_prioridade")),
                 F.when(nb("desc_prioridade"), F.col("_o"))).alias("fd"),
        F.min(F.when(nb("desc_prioridade"), F.col("_o"))).alias("fdk"),
        F.min_by(op, F.col("_o")).alias("op"))
    has_op = F.col("op_key").isNotNull() & (F.col("op_key") != "")
    item = F.when(has_op, F.struct(F.col("op_key").alias("num_operacao"),
                                   *[F.col(f"op.{c}").alias(c) for c in OP_FIELDS[1:]]))
    lvl2 = lvl1.groupBy("k").agg(
        F.min_by(F.col("h"), F.col("hk")).alias("h"),
        F.min_by(F.col("fp"), F.col("fpk")).alias("f_priok"),
        F.min_by(F.col("fd"), F.col("fdk")).alias("f_desc"),
        F.array_sort(F.collect_list(item)).alias("operacoes"))
    crit = S.criticality(F.col("f_priok"), F.col("f_desc"))
    return lvl2.select(
        F.col("k").alias("ordem"), "h.ativo", "h.situacao_os",
        F.col("h.status_os_usuario").alias("status_usuario"),
        F.col("h.status_os_usuario_descricao").alias("status_usuario_desc"),
        F.col("h.status_os_sistema").alias("status_sistema"),
        "h.tipo_manutencao", "h.tipo_manutencao_real", "h.descricao_os",
        crit.alias("criticidade"), crit.alias("desc_prioridade"), K.py_text(F.col("f_priok")).alias("priok"),
        F.col("h.centro_trabalho_responsavel").alias("centro_trabalho"),
        F.nullif(F.ltrim(K.py_strip(F.coalesce(F.col("h.cod_responsavel").cast("string"), F.lit(""))), F.lit("0")),
                 F.lit("")).alias("cod_responsavel"),
        "h.responsavel", "h.autor_os", "h.data_criacao", "h.data_liberacao", "h.data_inicio_programada",
        "h.data_fim_programada", "h.data_inicio_real", "h.data_fim_real", "h.data_enc_tecnico",
        "h.data_enc_comercial", "operacoes", "h._aufnr")


def external_work_orders_flat(t: dict[str, DataFrame], p: Params) -> DataFrame:
    """J6 as rows: one row per (order, nested operation), header repeated.

    An order without operations gives one row with NULL operation fields.
    ``op_index`` is the 0-based position inside ``operacoes``.
    """
    n = external_work_orders(t, p)
    return n.select(*EWO_HEADER, F.size("operacoes").alias("n_operacoes"),
                    F.posexplode_outer("operacoes").alias("op_index", "op")).select(
        *EWO_HEADER, "n_operacoes", "op_index", *[F.col(f"op.{c}").alias(c) for c in OP_FIELDS])


def external_work_orders_summary(t: dict[str, DataFrame], p: Params) -> DataFrame:
    """AG-18 counters of J6: orders, orders with criticality, operations."""
    n = external_work_orders(t, p)
    return run_summary(n, {"ordens": F.count(F.lit(1)),
                           "com_criticidade": F.count_if(F.col("criticidade").isNotNull()),
                           "operacoes": F.sum(F.size("operacoes")).cast("long")})


# --------------------------------------------------------------------- J13
def order_supplies(t: dict[str, DataFrame], p: Params, step: Step = whole) -> DataFrame:
    """Supplies (purchases and reservations) of the newest orders.

    Newest order per asset and kind from the order view, partitioned by the
    kind expression (WN-3). Purchase branch: requisition assignments of the
    order -> requisition -> PO item; reservation branch: reservations of the
    order not deleted (NULL-safe, S-6) -> requisition -> PO item. The two
    branches are one ``unionByName`` with typed NULLs (ST-1); per (order,
    part) the best row is kept: purchase first, then with PO, then with
    reservation (WN-4), the remaining columns breaking ties. Texts and the
    destination (CL-2) are added after the ranking (S-11). ``step``: what is done with the newest orders and
    with each branch before the next joins (see ``stored``).
    """
    pm = _pm_branch_orders(t, p).filter(
        F.col("cod_tipo_atividade").isin("PRP", "OFI") | F.col("tipo_atividade").ilike("%prep%")
        | F.col("tipo_atividade").ilike("%ofi%"))
    pm = pm.withColumn("_kind", S.maintenance_kind_or_null(F.col("cod_tipo_atividade"), F.col("tipo_atividade")))
    pm = pm.withColumn("_d", D.sap_date(F.col("data_criacao")))
    last = first_per_key(pm, ["n_equipamento", "_kind"], [F.col("_d").desc_nulls_first()],
                         [F.col("n_ordem").desc_nulls_first()])
    os_ = step(last.select(F.col("n_equipamento").alias("ativo"), K.strip_zeros(F.col("n_ordem")).alias("ordem"),
                           K.pad_key(F.col("n_ordem"), 12).alias("ordem_sap")), "newest-orders")  # JN-9
    eban, ekpo, ebkn, resb = t["eban"], t["ekpo"], t["ebkn"], t["resb"]
    po = ekpo.select(F.col("banfn").alias("p_banfn"), F.col("bnfpo").alias("p_bnfpo"), F.col("ebeln").alias("p_ebeln"))
    buy = (os_.join(ebkn.select("aufnr", "banfn", "bnfpo"), F.col("ordem_sap") == F.col("aufnr"))
           .join(eban.select("banfn", "bnfpo", "matnr", "txz01", "menge", "knttp"), ["banfn", "bnfpo"])
           .join(po, (F.col("banfn") == F.col("p_banfn")) & (F.col("bnfpo") == F.col("p_bnfpo")), "left"))
    buy = buy.select("ativo", "ordem", K.strip_key(F.col("matnr")).alias("cod_sap"),
                     F.col("txz01").alias("desc_compra_direta"), F.col("menge").alias("qtd_req"),
                     K.strip_key(F.col("p_ebeln")).alias("pedido"),
                     # PF-21: constant and typed-NULL columns line the branches up (ST-1)
                     F.lit(None).cast("string").alias("num_reserva"), F.lit("compra").alias("origem"), "knttp")
    buy = step(buy, "purchases")
    e2 = eban.select(F.col("banfn").alias("e_banfn"), F.col("bnfpo").alias("e_bnfpo"), F.col("knttp"))
    res = os_.join(resb.filter(F.col("xloek").isNull() | (F.trim(F.col("xloek")) == "")),
                   F.col("ordem_sap") == F.col("aufnr"))
    # most reservations have no requisition: spread their NULL keys
    res = step(res, "reservations")
    res = with_salt(res, ["rsnum", "rspos"])
    res = (res.join(e2, (spread_nulls("banfn") == F.col("e_banfn")) & (F.col("bnfpo") == F.col("e_bnfpo")), "left")
           .join(po, (spread_nulls("e_banfn") == F.col("p_banfn")) & (F.col("e_bnfpo") == F.col("p_bnfpo")), "left"))
    res = res.select("ativo", "ordem", K.strip_key(F.col("matnr")).alias("cod_sap"),
                     F.lit(None).cast("string").alias("desc_compra_direta"), F.col("bdmng").alias("qtd_req"),
                     K.strip_key(F.col("p_ebeln")).alias("pedido"),
                     F.when(F.col("postp") == "N", F.lit(None).cast("string"))
                     .otherwise(K.strip_key(F.col("rsnum"))).alias("num_reserva"),
                     S.supply_origin(F.col("postp")).alias("origem"), "knttp")
    res = step(res, "reserved")
    items = buy.unionByName(res).filter(F.col("cod_sap").isNotNull() & (F.col("cod_sap") != ""))
    best = best_per_key(items, ["ordem", "cod_sap"],
                        [F.col("origem") == "compra", F.col("pedido").isNotNull(), F.col("num_reserva").isNotNull()],
                        [F.col(c).asc_nulls_last() for c in ("ativo", "pedido", "num_reserva", "qtd_req",
                                                             "desc_compra_direta", "knttp")])
    makt = t["makt"]
    best = text_lookup(best, makt, F.col("cod_sap"), K.strip_key(makt.matnr), "maktx", "m_maktx",
                       langs=p.text_langs, name="m")
    return best.select(
        "ativo", "ordem", "cod_sap",
        F.coalesce(F.col("m_maktx"), F.col("desc_compra_direta"), F.lit("Sem Descrição")).alias("descricao"),
        "qtd_req", "num_reserva", "pedido", "origem",
        F.nullif(F.trim(F.coalesce(F.col("knttp"), F.lit(""))), F.lit("")).alias("knttp"),
        S.destination(F.col("knttp")).alias("destinacao"))
