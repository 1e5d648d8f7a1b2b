"""Classification and status labels. Column -> Column.

The label texts are fixed values: they must equal the reference output.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetlake.functions._util import as_col
from fleetlake.functions.keys import strip_key

# Approval flow status code -> label (CL-4).
APPROVAL_LABELS = {
    "STARTED": "1. Iniciado/Aguardando",
    "READY": "2. Pronto para Aprovacao",
    "COMPLETED": "3. Aprovado",
    "CANCELLED": "0. Cancelado/Reprovado",
}

# Payment status labels (CL-5).
PAID = "Pago / Fatura Lançada (MIRO)"
NOT_PAID = "Não Lançado"

# Goods receipt status labels (CL-6).
RECEIPT_DONE = "MIGO FEITA"
RECEIPT_PENDING = "MIGO PENDENTE"

# Account category code -> consumption type (CL-3).
CONSUMPTION_TYPES = {
    "K": "Centro de Custo",
    "A": "Ativo Fixo (Imobilizado)",
    "F": "Ordem (Manutencao/Interna)",
    "P": "Projeto (PEP)",
    "Q": "Projeto (PEP)",
    "N": "Rede",
    "": "Estoque",
}
CONSUMPTION_OTHER = "Outro"

# Order priority code -> criticality label (CL-12).
PRIORITY_LABELS = {"1": "Urgente", "2": "Alta", "3": "Média", "4": "Baixa"}

# Maintenance kinds (CL-7, CL-8).
KIND_PREP = "Preparação"
KIND_SHOP = "Oficina"
KIND_OTHER = "Outro"

# Movement type -> label (CL-13).
MOVEMENT_LABELS = {"201": "Reserva Manual", "261": "Ordem"}


def _map_lookup(key: Column, mapping: dict[str, str]) -> Column:
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*pairs), key)


def approval_label(c) -> Column:
    """CL-4: status code to label; unknown codes pass through."""
    col = as_col(c)
    return F.coalesce(_map_lookup(col, APPROVAL_LABELS), col)


def payment_status(any_invoice: Column) -> Column:
    """CL-5: label from 'has an invoice receipt' (NULL counts as no)."""
    return F.when(F.coalesce(any_invoice, F.lit(False)), F.lit(PAID)).otherwise(F.lit(NOT_PAID))


def receipt_status(received_at) -> Column:
    """CL-6: goods receipt done when a receipt date is present."""
    return F.when(as_col(received_at).isNotNull(), F.lit(RECEIPT_DONE)).otherwise(F.lit(RECEIPT_PENDING))


def category(po_cat, rc_cat) -> Column:
    """Account category as written in the requisition query: PO first, then RC.

    COALESCE only skips NULL, so a blank category on the PO wins over a
    filled one on the requisition (S-7).
    """
    return F.coalesce(as_col(po_cat), as_col(rc_cat))


def destination(cat) -> Column:
    """CL-2: stock / cost centre / consumption from an account category."""
    t = F.trim(F.coalesce(as_col(cat), F.lit("")))
    return (F.when(t == "", F.lit("estoque"))
            .when(t == "K", F.lit("centro_custo"))
            .otherwise(F.lit("consumo")))


def consumption_type(cat) -> Column:
    """CL-3: account category to consumption type, default 'Outro'."""
    t = F.trim(F.coalesce(as_col(cat), F.lit("")))
    return F.coalesce(_map_lookup(t, CONSUMPTION_TYPES), F.lit(CONSUMPTION_OTHER))


def process_status(received, po_qty, po_release, po_number, po_deleted, rc_deleted, rc_number) -> Column:
    """CL-1: requisition process status; the first matching rule wins."""
    rec = F.coalesce(as_col(received), F.lit(0))
    q = as_col(po_qty)
    return (
        F.when((rec >= q) & (q > 0), F.lit("recebido"))
        .when(rec > 0, F.lit("entrega_parcial"))
        .when(as_col(po_release) == "X", F.lit("aguardando_aprovacao"))
        .when(as_col(po_number).isNotNull()
              & (F.coalesce(F.trim(as_col(po_deleted)), F.lit("")) != "L"), F.lit("pedido_emitido"))
        .when(F.trim(F.coalesce(as_col(po_deleted), F.lit(""))) == "L", F.lit("pedido_cancelado"))
        .when(F.trim(F.coalesce(as_col(rc_deleted), F.lit(""))) == "X", F.lit("rc_excluida"))
        .when(as_col(rc_number).isNotNull()
              & (F.coalesce(F.trim(as_col(po_number)), F.lit("")) == ""), F.lit("aguardando_pedido"))
        .otherwise(F.lit("verificar"))
    )


def maintenance_kind(code, text) -> Column:
    """CL-7: kind by exact activity code or case-insensitive description."""
    c, t = as_col(code), as_col(text)
    return (F.when((c == "PRP") | t.ilike("%prep%"), F.lit(KIND_PREP))
            .when((c == "OFI") | t.ilike("%ofi%"), F.lit(KIND_SHOP))
            .otherwise(F.lit(KIND_OTHER)))


def maintenance_kind_or_null(code, text) -> Column:
    """CL-7 without the default: NULL when neither kind matches."""
    c, t = as_col(code), as_col(text)
    return (F.when((c == "PRP") | t.ilike("%prep%"), F.lit(KIND_PREP))
            .when((c == "OFI") | t.ilike("%ofi%"), F.lit(KIND_SHOP)))


def maintenance_kind_code(code) -> Column:
    """CL-8: kind by substring of the maintenance activity code."""
    c = as_col(code)
    return (F.when(c.contains("PRP"), F.lit(KIND_PREP))
            .when(c.contains("OFI"), F.lit(KIND_SHOP))
            .otherwise(F.lit(KIND_OTHER)))


def order_situation(deleted, phase3, phase2, phase1, phase0) -> Column:
    """CL-9: deletion first, then the latest phase."""
    return (F.when(as_col(deleted) == "X", F.lit("Marcada p/ eliminação"))
            .when(as_col(phase3) == "X", F.lit("Encerrada"))
            .when(as_col(phase2) == "X", F.lit("Encerrada tecnicamente"))
            .when(as_col(phase1) == "X", F.lit("Liberada"))
            .when(as_col(phase0) == "X", F.lit("Aberta"))
            .otherwise(F.lit("Indefinido")))


def order_phase(closed_commercial, closed_technical, released) -> Column:
    """CL-10: numbered order phase."""
    return (F.when(as_col(closed_commercial) == "X", F.lit("3 - Encerrada Comercial"))
            .when(as_col(closed_technical) == "X", F.lit("2 - Concluída Tecnicamente"))
            .when(as_col(released) == "X", F.lit("1 - Liberada"))
            .otherwise(F.lit("0 - Criada / Aberta")))


def branch(work_centre, codes) -> Column:
    """CL-11: first branch code contained in the work centre, else the work centre."""
    wc = as_col(work_centre)
    out = None
    for code in codes:
        out = (F.when(wc.contains(code), F.lit(code)) if out is None
               else out.when(wc.contains(code), F.lit(code)))
    return out.otherwise(wc) if out is not None else wc


def priority_label(code) -> Column:
    """CL-12 in SQL form: trimmed code to label, no zero-stripping, else NULL."""
    return _map_lookup(F.trim(F.coalesce(as_col(code).cast("string"), F.lit(""))), PRIORITY_LABELS)


def criticality(code, text) -> Column:
    """CL-12 in Python form: a ready text is kept, else the zero-stripped code's label."""
    from fleetlake.functions.keys import py_text
    return F.coalesce(py_text(text), _map_lookup(F.ltrim(F.coalesce(py_text(code), F.lit("")), F.lit("0")),
                                                 PRIORITY_LABELS))


def movement_label(bwart) -> Column:
    """CL-13: movement type label, '' for other types."""
    return F.coalesce(_map_lookup(as_col(bwart), MOVEMENT_LABELS), F.lit(""))


def supply_origin(postp) -> Column:
    """CL-15: origin of a reservation item ('N' items are bought)."""
    return F.when(as_col(postp) == "N", F.lit("compra")).otherwise(F.lit("reserva"))


def asset_text(cost_centre, profit_centre_text, asset_text_) -> Column:
    """CL-14 / SC-13: asset description by cost-centre key length (10: profit centre, 7: asset); no default."""
    n = F.length(as_col(cost_centre))
    return F.when(n == 10, as_col(profit_centre_text)).when(n == 7, as_col(asset_text_))


def stock_asset(equnr) -> Column:
    """CL-16: asset of a requisition, 'ESTOQUE' when there is none."""
    return F.coalesce(F.nullif(strip_key(equnr), F.lit("")), F.lit("ESTOQUE"))


