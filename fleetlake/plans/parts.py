"""Parts history per asset and half-year."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.functions import dates as D
from fleetlake.functions import keys as K
from fleetlake.operators.lookups import agg_lookup, salted_join
from fleetlake.functions.predicates import year_range
from fleetlake.operators.stored import Step, steps_for, whole
from fleetlake.params import Params


def _consumption(t: dict[str, DataFrame], p: Params) -> DataFrame:
    """Order x component rows keyed on normalised order numbers (JN-6, O-12).

    The trim + zero-strip key is derived once per table and joined as a plain
    equi-join, instead of wrapping the join condition in functions.
    """
    # PF-13: not NULL and not empty; JN-17: the left join of the reference is
    # made inner by its WHERE, so it is written as inner
    afih = t["afih"].filter(F.col("equnr").isNotNull() & (F.col("equnr") != "")).select(
        F.col("aufnr").alias("afih_aufnr"), K.strip_key(F.col("equnr")).alias("ativo"))
    resb = t["resb"].filter(F.col("matnr").isNotNull() & (F.col("matnr") != "")).select(
        F.col("aufnr").alias("resb_aufnr"), K.strip_key(F.col("matnr")).alias("cod_sap"), "bdmng")
    # the periods need the creation date, so the orders are cut to them first,
    # joined at order grain, and only then meet the reservation lines
    aufk = _in_periods(t["aufk"].select(K.strip_key(F.col("aufnr")).alias("okey"), D.sap_date(F.col("erdat")).alias("erdat"),
                                        F.col("erdat").alias("erdat_text")), p)
    afih = afih.withColumn("afih_key", K.strip_key(F.col("afih_aufnr")))
    heads = afih.join(aufk, F.col("afih_key") == F.col("okey")).drop("afih_key")
    # lines without an order share the blank key; they are spread by part, which every grouping has
    lines = resb.withColumn("resb_key", K.strip_key(F.col("resb_aufnr"))).drop("resb_aufnr")
    return salted_join(lines, heads, F.col("resb_key"), F.col("okey"), [""], how="inner", name="rk",
                       spread=["cod_sap"], bucket_col="bucket").drop("resb_key")


def _in_periods(rows: DataFrame, p: Params) -> DataFrame:
    """Rows created inside the half-years ``parts_first_year`` .. year of ``as_of``.

    ``date_mode='text'`` compares the raw ``YYYYMMDD`` text with the period
    bounds as the reference does (PF-18, S-9); the period is then taken from
    the text's first six characters.
    """
    lo, hi = dt.date(p.parts_first_year, 1, 1), dt.date(p.as_of.year, 12, 31)
    if p.date_mode == "text":
        t = F.col("erdat_text")
        rows = rows.filter((t >= lo.strftime("%Y%m%d")) & (t <= hi.strftime("%Y%m%d")))
        year, month = F.substring(t, 1, 4), F.substring(t, 5, 2).cast("int")
    else:
        rows = rows.filter(year_range("erdat_text", lo.year, hi.year) & F.col("erdat").between(F.lit(lo), F.lit(hi)))
        year, month = F.year("erdat").cast("string"), F.month("erdat")
    return rows.withColumn("periodo", F.concat(year, F.when(month <= 6, F.lit("H1")).otherwise(F.lit("H2"))))


def _with_texts(g: DataFrame, t: dict[str, DataFrame], p: Params) -> DataFrame:
    """Asset text, component text and material group, one value per key (S-11).

    The reference joins the text tables before it sums, so that every further text of a key counts the
    quantity again. With ``fanout='keep'`` the totals are those: the texts are counted per key and the
    sum is taken that many times, without multiplying any row.
    """
    lookups = [("eqkt", "ativo", "equnr", "eqktx", "descricao_ativo", True), ("makt", "cod_sap", "matnr", "maktx", "descricao_componente", True),
               ("mara", "cod_sap", "matnr", "matkl", "grupo_mercadoria", False)]
    for table, own, key, text, out, by_language in lookups:
        texts = t[table]
        g = agg_lookup(g, texts, [F.col(own)], [K.strip_key(texts[key])],
                       [F.max(text).alias(out), F.count(F.lit(1)).alias(f"__n_{table}")],
                       F.col("spras").isin(*p.text_langs) if by_language else None, table)
    if p.fanout == "keep":
        times = F.lit(1)
        for table, *_ in lookups:
            times = times * F.greatest(F.coalesce(F.col(f"__n_{table}"), F.lit(1)), F.lit(1))
        g = g.withColumn("qtd_total", (F.col("qtd_total") * times).cast(g.schema["qtd_total"].dataType))
    return g


def _aggregate(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per ``keys``: orders, quantity, last order (text max), last date, order of the last date.

    Two levels instead of ``COUNT(DISTINCT)``: first per order (folding an
    order's reservation lines map-side, AG-3), then per ``keys`` where the
    order count is a plain count (AG-4). The stripped order number is fixed
    by the order, so it is a grouping key of the first level. So is the bucket of the join, fixed by order
    and part: the first level then runs where the join left the rows, without a shuffle of the lines.
    """
    per_order = rows.groupBy(*keys, "afih_aufnr", "okey", "bucket").agg(
        F.sum("bdmng").alias("__qty"), F.max("erdat").alias("__date"))
    okey = F.col("okey")
    # the total keeps the type one SUM over the lines has (precision + 10)
    qty_t = rows.schema["bdmng"].dataType
    total_t = T.DecimalType(min(38, qty_t.precision + 10), qty_t.scale) if isinstance(qty_t, T.DecimalType) else qty_t
    return per_order.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("qtd_ocorrencias"),
        F.sum("__qty").cast(total_t).alias("qtd_total"),
        F.max(okey).alias("ultima_ordem"),
        F.max("__date").alias("ultima_data"),
        F.max_by(okey, F.struct(F.col("__date"), okey)).alias("ultima_ordem_por_data"))


OUT = ["ativo", "descricao_ativo", "cod_sap", "descricao_componente", "grupo_mercadoria", "qtd_ocorrencias",
       "qtd_total", "ultima_ordem", "ultima_data", "ultima_ordem_por_data"]


def parts_history(t: dict[str, DataFrame], p: Params, step: Step = whole) -> DataFrame:
    """Per half-year, asset and part: orders, quantity, last order and date.

    The reference runs one query per half-year (BF-2) and concatenates the
    results without merging them (AG-19); here each row gets its period by
    date arithmetic and one aggregation groups by (period, asset, part).
    ``ultima_ordem`` is the text maximum of the stripped order numbers as in
    the reference (S-15: '9' > '10'); ``ultima_ordem_por_data`` is the order
    of the newest creation date. Texts are joined after the aggregation, one
    per key, so they do not multiply sums (S-11). Creation dates are read as
    dates (SC-17) by default; ``date_mode='text'`` compares the raw text with
    the period bounds as the reference does (S-9). ``step``: what is done with the sums before the texts are
    looked up (see ``stored``).
    """
    rows = _consumption(t, p)
    g = step(_aggregate(rows, ["periodo", "ativo", "cod_sap"]), "parts-sums")
    return _with_texts(g, t, p).select("periodo", *OUT)


def parts_history_stepped(t: dict[str, DataFrame], p: Params) -> DataFrame:
    """``parts_history``, over large files in steps."""
    return parts_history(t, p, steps_for(parts_history(t, p)))


def parts_history_merged(t: dict[str, DataFrame], p: Params) -> DataFrame:
    """J15 with the periods merged: one row per (asset, part) over the whole range."""
    rows = _consumption(t, p)
    g = _aggregate(rows, ["ativo", "cod_sap"])
    return _with_texts(g, t, p).select(*OUT)
