"""Delivery of the jobs: batch sizes, tails, value profiles and row order of each job (SURVEY 2.6,
2.10, 2.11), the windowed backfills and the run manifest."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.functions import keys as K
from fleetlake.operators.backfill import WindowedDelivery, run_jobs, window_counts
from fleetlake.operators.batches import row_index, serialised, to_batches, with_envelope
from fleetlake.operators.stored import remove, shared_folder, slices_for, steps_for, store
from fleetlake.params import Params
from fleetlake.plans import orders, parts, purchasing, reservations, yard

Job = Callable[[dict[str, DataFrame], Params], DataFrame]


def up(*names: str) -> list[Column]:
    """Ascending as PostgreSQL sorts: NULLs last."""
    return [F.col(n).asc_nulls_last() for n in names]


def down(*names: str) -> list[Column]:
    """Descending as PostgreSQL sorts: NULLs first."""
    return [F.col(n).desc_nulls_first() for n in names]


@dataclass(frozen=True)
class Batched:
    """How a job is cut into batches. ``rows`` may have columns named ``_...`` that only sort."""

    rows: Job
    size: int
    tail: str
    profile: str
    order: Callable[[], list[Column]]
    counters: Callable[[], dict[str, Column]] = dict
    columns: list[str] | None = None


def has_order(name: str) -> Column:
    """AG-18: the row has a PO."""
    return F.coalesce(F.trim(F.col(name)), F.lit("")) != ""


# Batch size, tail form, value profile and row order of the jobs sent in batches. The
# order is that of the reference's query (SO-1, SO-2); the last columns only break ties. Receipts come
# from MySQL, which sorts NULLs of a descending key last.
BATCHED = {
    "po_approval": Batched(purchasing.po_approval, 500, "none", "iso_float",
                           lambda: [*down("hora_inicio", "hora_fim", "data_inicio"), *up("pedido")]),
    "goods_receipt_status": Batched(
        purchasing.goods_receipt_status, 500, "none", "iso_float",
        lambda: [*up("status_migo"), F.col("data_do_recebimento_fisico").desc_nulls_last(), *up("pedido_key")]),
    "external_work_orders": Batched(orders.external_work_orders_rows, 300, "none", "iso_float",
                                    lambda: [*up("ativo"), *down("_aufnr"), *up("ordem")]),
    "po_payment": Batched(purchasing.po_payment_rows, 2000, "none", "iso_float", lambda: up("_ebeln", "pedido")),
    "purchase_history": Batched(purchasing.purchase_history_stepped, 2000, "final", "text",
                                lambda: up("janela", "_ebeln", "_ebelp", "pedido", "item_pc")),
    "requisition_flow": Batched(purchasing.requisition_flow_stepped, 800, "final", "text",
                                lambda: up("janela", "_banfn", "_ebeln", "_ebelp", "num_rc", "item_rc"),
                                lambda: {"com_pedido": has_order("pedido")}, purchasing.RC_COLUMNS),
    "parts_history": Batched(parts.parts_history_stepped, 500, "trailer", "text_isots", lambda: up("periodo", "ativo", "cod_sap")),
}


@dataclass(frozen=True)
class Listed:
    """A job delivered as one list (DL-6): value profile and columns of the written order."""

    rows: Job
    profile: str
    sorted_by: tuple[str, ...]

    def order(self) -> list[Column]:
        return up(*self.sorted_by)


# Value profile and order of the jobs delivered as one list. Where the reference has no
# ORDER BY (yard and meter feeds, picking lines) the order is by key, then time.
LISTED = {
    "yard_entries": Listed(yard.yard_entries, "br_offset", (
        "asset_no", "data_entrada", "filial", "situacao", "cliente", "horimetro", "equipamento", "marca", "modelo")),
    "yard_events": Listed(yard.yard_events, "br_offset", (
        "asset_no", "ts", "tipo_relatorio", "filial", "situacao", "cliente", "horimetro", "descricao")),
    "hourmeter": Listed(yard.hourmeter_merged, "br_offset", ("asset_no", *yard.VALID_COLS[1:], *yard.REJECTED_COLS)),
    "work_orders": Listed(orders.work_order_enriched, "br_offset", ("ativo", "tipo_manutencao", "ordem")),
    "work_order_operations": Listed(lambda t, p: orders.operations_of(orders.work_order_details(t, p)), "br_offset",
                                    ("ativo", "_aufnr", "num_operacao")),
    "equipment": Listed(yard.equipment, "br_offset", ("ativo", "descricao", "chassi", "local_instalacao")),
    "order_supplies": Listed(orders.order_supplies, "br_offset", ("ativo", "ordem", "cod_sap")),
    "picking_reservations": Listed(reservations.picking_reservations, "utc_offset", (
        "chave", "remessa", "data", "centro_custo", "descricao_ativo", "descr_material")),
}


def sent_columns(rows: DataFrame, columns: list[str] | None = None) -> list[str]:
    """The columns that are delivered: those given, or all but the sorting ones."""
    return columns or [c for c in rows.columns if not c.startswith("_")]


def ordered_batches(rows: DataFrame, spec: Batched, counters: bool = False) -> DataFrame:
    """Rows of a job in its batches and order, as values of its profile. The order is that of the typed
    columns, not of their texts."""
    payload = serialised(rows, spec.profile, sent_columns(rows, spec.columns))
    return to_batches(rows, spec.size, spec.order(), tail=spec.tail, payload=payload, counters=spec.counters() if counters else None)


def _batches_of_job(name: str, t: dict[str, DataFrame], p: Params, counters: bool) -> DataFrame:
    """The batches of a job, whose rows are written before they are numbered, so that its joins and the
    numbering do not need the disks at the same time. The index has a copy of the rows of its own."""
    spec = BATCHED[name]
    spark = next(iter(t.values())).sparkSession
    path = shared_folder(spark, f"rows-{name}")
    batches = ordered_batches(store(spec.rows(t, p), name, path), spec, counters)
    remove(spark, path)
    return batches


def job_batches(name: str, t: dict[str, DataFrame], p: Params) -> DataFrame:
    """The batches a job delivers."""
    return _batches_of_job(name, t, p, counters=False)


def envelopes(rows: DataFrame, spec: Batched, failed_windows: int = 0) -> DataFrame:
    """The batches of a job's rows with the run fields of its envelope (DL-3, DL-4)."""
    return with_envelope(ordered_batches(rows, spec, counters=True), spec.tail, failed_windows)


def job_envelopes(name: str, t: dict[str, DataFrame], p: Params) -> DataFrame:
    """The batches a job delivers with the run fields of its envelope."""
    return with_envelope(_batches_of_job(name, t, p, counters=True), BATCHED[name].tail)


def listed_rows(rows: DataFrame, spec: Listed) -> DataFrame:
    """DL-6: one list in its order, as values of its profile. A sort by range, so the files of the
    written list follow one another in this order."""
    return rows.orderBy(*spec.order()).select(*serialised(rows, spec.profile, sent_columns(rows)))


def listed_index(rows: DataFrame, spec: Listed, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of a list with their place ``pos`` in it. What is read to number the rows is
    written first, so that the job of the rows runs once: finding the bounds of a sort by range is a run of its own."""
    path = shared_folder(rows.sparkSession, "listed")
    narrow = store(rows.select(*dict.fromkeys([*spec.sorted_by, *keep])), "listed", path)
    placed = row_index(narrow, spec.order(), index_col="pos", keep=keep)
    remove(rows.sparkSession, path)
    return placed


def job_list(name: str, t: dict[str, DataFrame], p: Params) -> DataFrame:
    spec = LISTED[name]
    return listed_rows(spec.rows(t, p), spec)


# --------------------------------------------------------------------- windowed jobs (BF-3)
def requisition_windows(t: dict[str, DataFrame], p: Params, path: str) -> WindowedDelivery:
    """J3 delivered window by window into ``path``: a window that fails is noted and the others go on."""
    def rows(parts: purchasing.RequisitionParts | None = None) -> DataFrame:
        return K.require_keys(purchasing.requisition_rows(t, p, parts), ["num_rc", "item_rc", "cod_sap"]).drop("janela")
    source = rows()
    n = slices_for(source)
    # the sides of the requisition items are the same for every window and attempt
    return WindowedDelivery(source.sparkSession, path, source, "data_requisicao", purchasing.RC_KEY(),
                            purchasing.RC_ORDER()[1:], p.rc_total_days, p.rc_step_days, p.as_of,
                            (lambda: [rows(x) for x in purchasing.requisition_parts_stored(t, p, n)]) if n > 1 else None)


def history_windows(t: dict[str, DataFrame], p: Params, path: str) -> WindowedDelivery:
    """J2 delivered window by window into ``path``. Its looked-up columns are added to the delivered rows
    (``purchasing.history_texts``)."""
    rows = purchasing.history_items(t, p).drop("janela")
    return WindowedDelivery(rows.sparkSession, path, rows, "data_emissao_pc",
                            [F.col("pedido"), F.col("item_pc")], purchasing.HISTORY_ORDER(),
                            p.hist_total_days, p.hist_step_days, p.as_of)


def windowed_envelopes(name: str, t: dict[str, DataFrame], p: Params, windows: WindowedDelivery, run: str) -> DataFrame:
    """The envelopes of a windowed run: the rows of the windows that were delivered, and a warning if
    some were not."""
    rows = windows.rows(run)
    if name == "purchase_history":
        rows = purchasing.history_texts(rows, t, p)
    return envelopes(rows, BATCHED[name], windows.failed_windows(run))


WINDOWED = {"requisition_flow": requisition_windows, "purchase_history": history_windows}


def requisition_window_counts(t: dict[str, DataFrame], p: Params) -> DataFrame:
    """BF-3 counters of the requisition flow per 14-day window (one pass)."""
    spark = next(iter(t.values())).sparkSession
    rows = purchasing.requisition_rows(t, p)
    guard = ((K.py_strip(F.coalesce("num_rc", F.lit(""))) != "")
             & (K.py_strip(F.coalesce("item_rc", F.lit(""))) != "")
             & (K.py_strip(F.coalesce("cod_sap", F.lit(""))) != ""))
    rows = rows.withColumn("_k_rc", K.py_strip(F.col("num_rc"))).withColumn("_k_item", K.py_strip(F.col("item_rc")))
    return window_counts(spark, rows, "data_requisicao", ["_k_rc", "_k_item"], purchasing.RC_ORDER(), guard,
                         p.rc_total_days, p.rc_step_days, p.as_of, spread_by=["num_rc", "item_rc"])


def stepped_supplies(t: dict[str, DataFrame], p: Params) -> DataFrame:
    """J13, over large files in steps."""
    return orders.order_supplies(t, p, steps_for(orders.order_supplies(t, p)))


def hourly_manifest(spark: SparkSession, t: dict[str, DataFrame], p: Params) -> DataFrame:
    """BF-4: the hourly yard block as independent jobs with a manifest row each. The two work-order
    lists share one run of the details; if it fails, the orders go out without header fields (``partial``) and
    the operations are an error. Two jobs at a time, as their shuffles share the disks."""
    block = orders.WorkOrderBlock(t, p)
    return run_jobs(spark, {
        "yard_entries": lambda: yard.yard_entries(t, p),
        "yard_events": lambda: yard.yard_events(t, p),
        "hourmeter": lambda: yard.hourmeter_merged(t, p),
        "work_orders": lambda: block.rows(fallback=True),
        "work_order_operations": block.operations,
        "equipment": lambda: yard.equipment(t, p),
        "order_supplies": lambda: stepped_supplies(t, p),
    }, parallel=2, notes={n: block.note for n in ("work_orders", "work_order_operations")})
