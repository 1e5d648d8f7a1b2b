"""Yard, telemetry and equipment jobs.

Source tables: ``uca_yard`` (yard entry/exit reports), ``hourmeter`` and
``hourmeter_invalid`` (telemetry readings), ``fi_ativos`` (equipment).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.functions import keys as K
from fleetlake.functions._util import as_col
from fleetlake.functions.predicates import like_any
from fleetlake.operators.dedup import first_per_key, latest_per_key
from fleetlake.operators.lookups import semi
from fleetlake.params import Params

# Report types of the yard feed that are entries or exits.
YARD_REPORT_TYPES = ("Entrada", "Saída", "Saida")


def compared(c, p: Params) -> Column:
    """S-8: a text that is compared as the source's collation compares it. Without ``p.collation`` the bytes
    decide; with one, Spark's hash partitioning, windows, joins and IN lists follow it as well."""
    col = as_col(c)
    return F.collate(col, p.collation) if p.collation else col


def asset_code(c: str, p: Params) -> Column:
    """S-14: what "newest per asset" groups on: the raw code, or the upper-trimmed one."""
    return compared(K.norm_code(c) if p.group_normalised else c, p)


# --------------------------------------------------------------------- J8
def yard_entries(t: dict[str, DataFrame], p: Params) -> DataFrame:
    """Assets whose newest yard report is an entry at a branch.

    The newest report per raw asset code is taken over all branches first,
    ties kept (JN-11 as one ``rank`` window, WN-5); only then the report
    type and branch are tested (S-13), so an asset that later left does not
    show. The key is the raw code, the output code is upper-trimmed (S-14).
    """
    p.need("yard_branches")
    u = t["uca_yard"].filter(F.col("asset_no").isNotNull())
    newest = latest_per_key(u, asset_code("asset_no", p), "created_at_form", ties="all")
    newest = newest.filter((compared("tipo_relatorio", p) == "Entrada") & like_any(compared("filial", p), p.yard_branches))
    return newest.select(
        K.norm_code("asset_no").alias("asset_no"),
        F.col("tipo_equipamento").alias("equipamento"),
        K.norm_code("marca").alias("marca"),
        K.norm_code("modelo").alias("modelo"),
        "cliente", "situacao",
        F.col("created_at_form").alias("data_entrada"),
        "horimetro", "filial")


# --------------------------------------------------------------------- J9
def yard_events(t: dict[str, DataFrame], p: Params) -> DataFrame:
    """All entry/exit reports of assets ever seen at a branch.

    The correlated ``EXISTS`` on the upper-trimmed code is a left semi join
    against the distinct codes seen at a branch (JN-14, O-8).
    """
    p.need("yard_branches")
    u = t["uca_yard"]
    code = compared(K.norm_code("asset_no"), p)
    seen = u.filter(like_any(compared("filial", p), p.yard_branches)).select(code.alias("k")).distinct()
    rows = u.filter(F.col("asset_no").isNotNull() & (F.col("asset_no") != "")
                    & F.col("created_at_form").isNotNull()
                    & compared("tipo_relatorio", p).isin(*YARD_REPORT_TYPES))
    rows = semi(rows, seen, [code], [F.col("k")])
    return rows.select(
        K.norm_code("asset_no").alias("asset_no"), "tipo_relatorio", F.col("created_at_form").alias("ts"),
        "filial", "cliente", "situacao", "horimetro", F.col("tipo_equipamento").alias("descricao"))


# --------------------------------------------------------------------- J10
VALID_COLS = ["asset_no", "data_comunicacao", "horimetro_sistema", "contrato", "atualizado_em"]
REJECTED_COLS = ["comunicacao_rastreador_em", "horimetro_rastreador", "fonte_rastreador", "motivo_rastreador"]
REJECTED_TYPES = {"comunicacao_rastreador_em": "timestamp_ntz", "horimetro_rastreador": "decimal(12,2)",
                  "fonte_rastreador": "string", "motivo_rastreador": "string"}


def hourmeter_latest(t: dict[str, DataFrame], p: Params) -> DataFrame:
    """J10 valid feed: newest reading per raw code, ties kept (JN-11).

    The meter is the equipment meter, else the panel meter (SC-9).
    """
    h = t["hourmeter"].filter(F.col("asset_code").isNotNull() & (F.col("asset_code") != ""))
    newest = latest_per_key(h, asset_code("asset_code", p), "event_datetime", ties="all")
    return newest.select(
        K.norm_code("asset_code").alias("asset_no"),
        F.col("event_datetime").alias("data_comunicacao"),
        F.coalesce("equipment_hourmeter", "panel_hourmeter").alias("horimetro_sistema"),
        F.col("contract").alias("contrato"),
        F.col("updated_at").alias("atualizado_em"))


def hourmeter_rejected(t: dict[str, DataFrame], p: Params) -> DataFrame:
    """J10 rejected feed: newest rejected reading per raw code, ties kept."""
    h = t["hourmeter_invalid"].filter(F.col("asset_code").isNotNull() & (F.col("asset_code") != ""))
    newest = latest_per_key(h, asset_code("asset_code", p), "event_datetime", ties="all")
    return newest.select(
        K.norm_code("asset_code").alias("asset_no"),
        F.col("event_datetime").alias("comunicacao_rastreador_em"),
        F.col("hourmeter").alias("horimetro_rastreador"),
        F.col("source").alias("fonte_rastreador"),
        F.col("error_code").alias("motivo_rastreador"))


def merge_feeds(valid: DataFrame, rejected: DataFrame, valid_cols: list[str], rejected_cols: list[str],
                key: str = "asset_no") -> DataFrame:
    """JN-12: enrich the valid feed with the rejected feed, append non-matches.

    Both feeds are keyed on the Python form of the code
    (``str(x).strip().upper()``). Per key only one valid row receives the
    rejected columns: the last one under a total order of its columns; and
    only the last rejected row per key is used (S-12). Rejected keys with no
    valid row become rows of their own with only the code and the rejected
    columns. A full outer join on the key does it in one shuffle.
    """
    def norm(c):
        return F.upper(K.py_strip(F.coalesce(F.col(c), F.lit(""))))

    v_order = [F.col(c).desc_nulls_last() for c in [c for c in valid_cols if c != key] + [key]]
    r_order = [F.col(c).desc_nulls_last() for c in rejected_cols + [key]]
    v = valid.withColumn("__k", norm(key)).withColumn(
        "__last", F.row_number().over(Window.partitionBy("__k").orderBy(*v_order)) == 1)
    r = first_per_key(rejected.withColumn("__k", norm(key)).filter(F.col("__k") != ""), "__k", r_order)
    r = r.select(F.col("__k").alias("__rk"), *[F.col(c) for c in rejected_cols])
    # one full outer join: only the last valid row of a key can match, the
    # other valid rows and unmatched rejected keys come through unmatched
    joined = v.join(r, (v["__k"] == r["__rk"]) & v["__last"], "full_outer")
    return joined.select(
        F.coalesce(F.col(key), F.col("__rk")).alias(key), *[F.col(c) for c in valid_cols if c != key],
        *[F.col(c) for c in rejected_cols])


def hourmeter_merged(t: dict[str, DataFrame], p: Params) -> DataFrame:
    """Newest valid readings merged with the newest rejected ones.

    The rejected feed is optional (BF-4): without ``hourmeter_invalid`` the
    valid readings are delivered with empty rejected columns.
    """
    valid = hourmeter_latest(t, p)
    if "hourmeter_invalid" not in t:
        return valid.select(*VALID_COLS, *[F.lit(None).cast(T).alias(c) for c, T in REJECTED_TYPES.items()])
    return merge_feeds(valid, hourmeter_rejected(t, p), VALID_COLS, REJECTED_COLS)


# --------------------------------------------------------------------- J12
def equipment(t: dict[str, DataFrame], p: Params) -> DataFrame:
    """Active equipment with renamed columns (SRC-3, PF-10)."""
    a = t["fi_ativos"].filter(F.col("status_ativo") == "Ativo")  # PF-3
    return a.select(
        F.col("bu").alias("tipo_holo"), F.col("asset_number").alias("ativo"), "descricao", "chassi", "marca",
        "modelo", F.col("tipo").alias("tipo_equipamento"), F.col("grupo").alias("porte_tonelagem"),
        "ano_fabricacao", "status_ativo", "local_instalacao")
