"""Asset dossier: orders, PO items, reservations, goods
movements and material texts of assets.

The reference builds one document for one asset given on the command line.
Re-aimed for scale: the job takes a DataFrame of asset codes (or all assets)
and returns each section as a DataFrame keyed by asset, so the work is joins
on order and material keys. ``documents`` cuts each section into ordered,
bounded pages per asset for delivery (DL-5).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.functions import keys as K
from fleetlake.operators.batches import in_order, row_index
from fleetlake.operators.stored import remove, shared_folder, store, store_sliced
from fleetlake.params import Params


def asset_key(c):
    """S-20: asset codes are compared upper-cased and zero-stripped."""
    return F.upper(K.strip_key(F.coalesce(c, F.lit(""))))


def orders(t: dict[str, DataFrame], p: Params, assets: DataFrame | None = None) -> DataFrame:
    """Orders of the assets with type, text and creation date."""
    afih, aufk = t["afih"], t["aufk"]
    o = afih.select(asset_key(F.col("equnr")).alias("ativo"), "aufnr").filter(F.col("ativo") != "")
    if assets is not None:  # PF-20 / JN-15: restrict to the given assets (left semi)
        o = o.join(assets.select(asset_key(F.col(assets.columns[0])).alias("ativo")).distinct(), "ativo", "left_semi")
    k = aufk.select(F.col("aufnr").alias("k_aufnr"), "auart", "ktext", "erdat")
    o = o.join(k, F.col("aufnr") == F.col("k_aufnr"), "left")
    return o.select("ativo", F.trim(F.col("aufnr")).alias("aufnr_raw"), K.strip_key(F.col("aufnr")).alias("ordem"),
                    F.nullif(F.trim(F.coalesce(F.col("auart"), F.lit(""))), F.lit("")).alias("tipo"),
                    F.nullif(F.trim(F.coalesce(F.col("ktext"), F.lit(""))), F.lit("")).alias("texto"),
                    F.col("erdat").alias("criada_em"))


def _order_keys(ords: DataFrame) -> DataFrame:
    """(asset, normalised order key); the default normalised join of S-18."""
    return ords.select("ativo", F.col("ordem").alias("okey")).filter(F.col("okey") != "").distinct()


def of_orders(rows: DataFrame, ords: DataFrame, variants: bool = False) -> DataFrame:
    """Rows of a table with an order number ``aufnr``, for every asset that has the order: with ``ativo`` and
    the normalised order key ``okey``.

    S-18: by default orders meet on the normalised key. With ``variants`` they meet as in the reference,
    on the raw text being one of the written forms of the order (SC-5): rows and orders are joined on the
    key that a form belongs to, each key once per asset, so that a row meets an asset once, however many
    forms of its orders agree, and no form is written out.
    """
    keyed = rows.withColumn("okey", K.strip_key(F.col("aufnr")))
    if not variants:
        return keyed.join(_order_keys(ords), "okey")
    written = F.array_union(K.form_keys(F.col("aufnr_raw")), K.form_keys(F.col("ordem")))
    forms = ords.select("ativo", F.explode(written).alias("form")).distinct()
    return keyed.join(forms, K.form_key(F.col("aufnr")) == F.col("form")).drop("form")


def purchase_items(t: dict[str, DataFrame], p: Params, ords: DataFrame, variants: bool = False) -> DataFrame:
    ekkn, ekpo, ekko, lfa1 = t["ekkn"], t["ekpo"], t["ekko"], t["lfa1"]
    n = of_orders(ekkn.select("aufnr", F.col("ebeln").alias("n_ebeln"), F.col("ebelp").alias("n_ebelp")), ords, variants).drop("aufnr")
    # JN-2: inner join on the composite PO item key
    x = n.join(ekpo, (F.col("n_ebeln") == ekpo.ebeln) & (F.col("n_ebelp") == ekpo.ebelp))
    # the suppliers join at the grain of the orders, so that the items travel once less
    heads = ekko.select(F.col("ebeln").alias("k_ebeln"), "bedat", F.col("lifnr").alias("k_lifnr")).join(
        lfa1.select(F.col("lifnr").alias("v_lifnr"), "name1"), F.col("k_lifnr") == F.col("v_lifnr"), "left")
    x = x.join(heads.select("k_ebeln", "bedat", "name1"), F.col("ebeln") == F.col("k_ebeln"), "left")
    return x.select(
        "ativo", F.col("okey").alias("ordem"), K.strip_key(F.col("ebeln")).alias("pedido"),
        F.trim(F.col("ebelp").cast("string")).alias("item"),
        K.strip_key(F.coalesce(F.col("matnr"), F.lit(""))).alias("cod_sap"), F.col("txz01").alias("descricao"),
        F.col("menge").alias("qtd"), F.col("meins").alias("un"), F.col("netpr").alias("vlr_unit"),
        F.col("netwr").alias("vlr_total"), F.col("bedat").alias("data_pc"), F.col("name1").alias("fornecedor"),
        F.nullif(F.trim(F.coalesce(F.col("loekz"), F.lit(""))), F.lit("")).alias("excluido"),
        F.nullif(K.strip_key(F.coalesce(F.col("banfn"), F.lit(""))), F.lit("")).alias("rc"))


def reservations(t: dict[str, DataFrame], p: Params, ords: DataFrame, variants: bool = False) -> DataFrame:
    r = of_orders(t["resb"], ords, variants)
    return r.select(
        "ativo", F.col("okey").alias("ordem"), F.col("rsnum").alias("reserva"), F.col("rspos").alias("item"),
        K.strip_key(F.coalesce(F.col("matnr"), F.lit(""))).alias("cod_sap"), F.col("sgtxt").alias("descricao"),
        F.col("bdmng").alias("qtd_reservada"), F.col("enmng").alias("qtd_retirada"), F.col("meins").alias("un"),
        F.col("bdter").alias("data_necessidade"), F.col("gpreis").alias("preco_unit"),
        K.flag01(F.col("xloek")).alias("estornado"))


def consumption(t: dict[str, DataFrame], p: Params, ords: DataFrame, variants: bool = False) -> DataFrame:
    m = of_orders(t["mseg"], ords, variants)
    return m.select(
        "ativo", F.col("okey").alias("ordem"), F.col("mblnr").alias("doc"), F.col("bwart").cast("string").alias("mov"),
        F.col("budat_mkpf").alias("data"), K.strip_key(F.coalesce(F.col("matnr"), F.lit(""))).alias("cod_sap"),
        F.col("sgtxt").alias("descricao"), F.col("menge").alias("qtd"), F.col("meins").alias("un"),
        F.col("dmbtr").alias("valor"))


def material_texts(t: dict[str, DataFrame], p: Params, *sections: DataFrame, variants: bool = False) -> DataFrame:
    """Texts (all P/PT rows) of the materials used in the sections (AG-20). With ``variants`` a text belongs
    to a material if its raw number is one of the material's written forms, also padded with blanks to
    forty characters (SC-6)."""
    mats = None
    for s in sections:
        m = s.select("ativo", "cod_sap")
        mats = m if mats is None else mats.unionByName(m)
    mats = mats.filter(F.trim(F.col("cod_sap")) != "")
    makt = t["makt"].filter(F.col("spras").isin(*p.text_langs)).select(
        K.strip_key(F.col("matnr")).alias("cod_sap"), F.col("matnr"), "maktx")
    if not variants:
        return mats.distinct().join(makt, "cod_sap").select("ativo", "cod_sap", "maktx")
    forms = mats.select("ativo", F.explode(K.form_keys(F.col("cod_sap"))).alias("form")).distinct()
    return forms.join(makt, K.material_form_key(F.col("matnr")) == F.col("form")).select("ativo", "cod_sap", "maktx")


def asset_dossier(t: dict[str, DataFrame], p: Params, assets: DataFrame | None = None, variants: bool = False) -> dict[str, DataFrame]:
    """The five sections of the dossier, each keyed by asset; lazy. ``variants``: S-18."""
    o = orders(t, p, assets)
    pe, re, co = (section(t, p, o, variants) for section in (purchase_items, reservations, consumption))
    return {"ordens": o, "pedidos": pe, "reservas": re, "consumo": co, "makt": material_texts(t, p, pe, re, co, variants=variants)}


def stored_dossier(t: dict[str, DataFrame], p: Params, assets: DataFrame | None = None, variants: bool = False,
                   columns: dict[str, list[str]] | None = None) -> dict[str, DataFrame]:
    """The sections for consumers that read all of them: orders and the three sections that the texts
    follow from are written once to the shared folder, so that no section is computed twice. ``columns``
    names per section those that the consumer reads (all rows are kept); the texts need ``ativo`` and
    ``cod_sap``, the sections the asset and the order number of the orders."""
    def read(df: DataFrame, name: str) -> DataFrame:
        return df.select(*columns[name]) if columns else df
    o = store(read(orders(t, p, assets), "ordens"), "dossier-orders")
    found = {"ordens": o}
    for name, section in (("pedidos", purchase_items), ("reservas", reservations), ("consumo", consumption)):
        found[name] = store(read(section(t, p, o, variants), name), f"dossier-{name}")
    return found | {"makt": material_texts(t, p, *list(found.values())[1:], variants=variants)}


def section_counts(sections: dict[str, DataFrame], assets: DataFrame | None = None) -> DataFrame:
    """Rows per asset and section, one row per asset (zeros for empty sections). With ``assets`` (codes
    in the first column) every asked-for asset has a row, also one without any order."""
    out = None
    if assets is not None:
        out = assets.select(asset_key(F.col(assets.columns[0])).alias("ativo")).where("ativo <> ''").distinct()
    for name, df in sections.items():
        c = df.groupBy("ativo").agg(F.count(F.lit(1)).alias(name))
        out = c if out is None else out.join(c, "ativo", "full_outer")
    return out.select("ativo", *[F.coalesce(F.col(n), F.lit(0)).alias(n) for n in sections])


# Fixed order of the rows of each section (the ORDER BY of each dossier query).
SECTION_ORDER = {
    "ordens": ["criada_em", "ordem"], "pedidos": ["data_pc", "pedido", "item"],
    "reservas": ["ordem", "reserva", "item"], "consumo": ["data", "doc"], "makt": ["cod_sap", "maktx"],
}


# Fixed value: a column of each section that its rows can be made by in slices.
SECTION_SLICES = {"pedidos": "pedido", "reservas": "reserva", "consumo": "doc", "makt": "cod_sap"}


def documents(sections: dict[str, DataFrame], max_items: int = 1000) -> dict[str, DataFrame]:
    """DL-5: the dossier as ordered pages per asset and section.

    For each section: one row per (asset, page) with ``itens`` holding at
    most ``max_items`` rows in the section's order, plus ``pagina`` and
    ``paginas``. The position of a row inside its asset comes from the
    grouped ``row_index`` (range partitioning on asset and order), so an
    asset with a third of all rows is spread over many tasks and no list
    grows past ``max_items``. The rows are written before they are numbered (see ``stored``).
    """
    out = {}
    for name, df in sections.items():
        rest = [c for c in df.columns if c != "ativo"]
        order = [F.col(c).asc_nulls_first() for c in SECTION_ORDER[name]] + \
                [F.col(c).asc_nulls_first() for c in rest if c not in SECTION_ORDER[name]]
        path = shared_folder(df.sparkSession, f"rows-{name}")
        idx = row_index(store_sliced(df, SECTION_SLICES.get(name), name, path), order, group=["ativo"], index_col="__i")
        remove(df.sparkSession, path)
        pages = idx.groupBy("ativo", F.floor(F.col("__i") / max_items).cast("int").alias("pagina")).agg(
            in_order("__i", rest).alias("itens"), F.first("__i_total").alias("__t"))
        out[name] = pages.select("ativo", "pagina", F.ceil(F.col("__t") / max_items).cast("int").alias("paginas"), "itens")
    return out
