"""Delivery: gapless row index, fixed-size batches, payload value profiles
(SURVEY 2.10 DL-1..DL-7, 2.11 JS-1).

The reference slices an in-memory list into chunks. Here the index is built
without a single-partition window: the rows are range-partitioned on a
unique order, sorted inside each partition, counted per partition, and each
partition gets the running total of the partitions before it as offset
(a table with one row per partition, the only thing broadcast).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.functions import dates as D
from fleetlake.functions._util import as_col
from fleetlake.operators.stored import shuffles_dropped, store


def _order_cols(order: Sequence) -> list[Column]:
    return [as_col(c) for c in order]


def row_index(df: DataFrame, order: Sequence, num_partitions: int | None = None,
              index_col: str = "row_idx", group: Sequence | None = None, keep: Sequence[str] | None = None) -> DataFrame:
    """Add a 0-based gapless index following ``order`` (see ``_indexed``)."""
    return _indexed(df, order, num_partitions, index_col, group, keep=keep)[0]


def _indexed(df: DataFrame, order: Sequence, num_partitions: int | None, index_col: str, group: Sequence | None = None,
             sums: dict[str, Column] | None = None, keep: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """A 0-based gapless index following ``order`` (unique within a group), and the totals.

    ``order`` may mix directions: each entry is a column or a Column with its direction and null place
    (``F.col("d").desc_nulls_first()``), which the range partitioning follows. ``sums`` are numbers per
    row; their totals come from the same per-partition table as the row counts and are added to every
    row. The second result is one row: ``total`` and the sums (0 for an empty input). ``keep`` names the
    columns that the result has next to the index; the others only sort.

    Without ``group`` the index is global; with ``group`` it restarts at 0 in
    every group. The rows are range-partitioned on (group, order) and sorted
    inside each partition, so a group's rows are contiguous and a large group
    spans many partitions: no task holds a whole hot group. Per (partition,
    group) the rows are counted; a group's offset in a partition is the sum
    of its counts in the partitions before (a window over the small counts
    table). ``repartitionByRange`` samples the data to pick bounds, so the
    ranged frame is written once to the session's shared folder before it is
    read twice (counts, rows): a lost executor then cannot move a row to
    another partition, and the counts read no payload column. Without ``num_partitions`` the range exchange
    starts from AQE's ``initialPartitionNum`` and is merged by data size.
    """
    gcols = _order_cols(group or [])
    cols = gcols + _order_cols(order)
    gnames = [f"__g{i}" for i in range(len(gcols))]
    ranged = (df.select("*", *[c.alias(g) for c, g in zip(gcols, gnames)])
              .repartitionByRange(*([num_partitions] if num_partitions else []), *cols).sortWithinPartitions(*cols)
              .withColumn("__pid", F.spark_partition_id())
              .withColumn("__local", F.monotonically_increasing_id()))
    # monotonically_increasing_id = (partition << 33) + position in partition
    ranged = ranged.withColumn("__local", F.col("__local") - F.shiftleft(F.col("__pid").cast("long"), 33))
    if keep is not None:
        ranged = ranged.select(*dict.fromkeys(keep), *gnames, "__pid", "__local")
    ranged = store(ranged, "index")
    keys = ["__pid", *gnames]
    sums = sums or {}
    counts = ranged.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.min("__local").alias("__start"),
                                       *[F.sum(c).alias(n) for n, c in sums.items()])
    totals = counts.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("total"), *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in sums])
    w = Window.partitionBy(*gnames).orderBy("__pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = counts.select(*keys, "__start", (F.sum("__n").over(w) - F.col("__n")).alias("__off"),
                            F.sum("__n").over(Window.partitionBy(*gnames)).alias("__total"),
                            *[F.sum(n).over(Window.partitionBy(*gnames)).alias(n) for n in sums])
    if not gnames:
        # one row per partition: a proven size bound for the broadcast
        offsets = F.broadcast(offsets)
    cond = None
    for k in keys:  # group values may be NULL
        e = F.col(f"r.{k}").eqNullSafe(F.col(f"o.{k}"))
        cond = e if cond is None else cond & e
    out = ranged.alias("r").join(offsets.alias("o"), cond)
    out = out.select("r.*", "o.__start", "o.__off", "o.__total", *[f"o.{n}" for n in sums])
    out = out.withColumn(index_col, F.col("__off") + F.col("__local") - F.col("__start")).withColumnRenamed(
        "__total", f"{index_col}_total").drop("__pid", "__local", "__off", "__start", *gnames)
    return out, totals


def in_order(index: str, cols: Sequence) -> Column:
    """Aggregate: the rows of a group as structs of ``cols``, by a unique ``index`` that the structs leave out.

    ``sort_array`` compares in generated code and the index is left out by reading a field, where ``array_sort``
    evaluates a lambda for each comparison and ``dropFields`` one for each row.
    """
    rows = F.sort_array(F.collect_list(F.struct(as_col(index).alias("at"), F.struct(*cols).alias("v"))))
    return rows.getField("v")


def to_batches(df: DataFrame, size: int, order: Sequence, tail: str = "none",
               emit_empty: bool = True, num_partitions: int | None = None, payload: Sequence[Column] | None = None,
               counters: dict[str, Column] | None = None) -> DataFrame:
    """DL-1..DL-4: rows in batches of ``size`` under ``order``.

    Output: ``batch_index int, is_last boolean, n_rows int, rows array<struct>``
    with the rows in order. The structs hold all columns of ``df``, or those of ``payload``, so that the
    order may use columns that are not sent, or that are sent as text. ``tail``:

    - ``'none'``  (DL-1) the last batch holding rows is the last one; with
      ``emit_empty`` an empty input gives one empty last batch (DL-2);
    - ``'final'`` (DL-3) full batches, then a final batch with the remainder
      that may be empty;
    - ``'trailer'`` (DL-4) all batches have ``is_last = false`` and an extra
      empty batch closes the run.

    With ``counters`` (conditions per row) every batch also has ``total``, the rows of the run, and how
    many of them meet each condition; they are counted with the index, not in a pass of their own.

    Every batch holds at most ``size`` rows, so ``collect_list`` is bounded.
    """
    cols = list(payload) if payload is not None else [F.col(c) for c in df.columns]
    names = {f"__c_{n}": n for n in counters or {}}
    idx, totals = _indexed(df, order, num_partitions, "__i",
                           sums={k: F.when(counters[n], 1).otherwise(0).cast("long") for k, n in names.items()})
    idx = idx.withColumn("batch_index", F.floor(F.col("__i") / size).cast("int")).withColumn(
        "__pos", (F.col("__i") % size).cast("int"))
    grouped = idx.groupBy("batch_index").agg(
        in_order("__pos", cols).alias("rows"),
        F.first("__i_total").alias("total"), *[F.first(k).alias(n) for k, n in names.items()])
    rows_t = grouped.schema["rows"].dataType
    if tail == "trailer":
        is_last = F.lit(False)
    elif tail == "final":
        is_last = F.col("batch_index") == F.floor(F.col("total") / size)
    else:
        is_last = F.col("batch_index") == F.floor((F.col("total") - 1) / size)
    extras = ["total", *names.values()] if counters is not None else []
    batches = grouped.select("batch_index", is_last.alias("is_last"), F.size("rows").alias("n_rows"), "rows", *extras)
    # a closing batch without rows comes from the totals alone (one row)
    t = F.col("total")
    closing = {"trailer": (F.lit(True), F.ceil(t / size)), "final": (t % size == 0, F.floor(t / size)),
               "none": (t == 0, F.lit(0))}[tail]
    if tail == "none" and not emit_empty:
        return batches
    extra = totals.where(closing[0]).select(
        closing[1].cast("int").alias("batch_index"), F.lit(True).alias("is_last"), F.lit(0).alias("n_rows"),
        F.array().cast(rows_t).alias("rows"), *([F.col("total")] if extras else []), *[F.col(k).alias(n) for k, n in names.items()])
    return batches.unionByName(extra)


def bundle(lists: dict[str, tuple[DataFrame, Sequence, Sequence[Column]]], max_items: int) -> DataFrame:
    """DL-5: one document with several row lists, as pages of at most ``max_items`` rows.

    ``lists`` gives per name the rows, their order (unique, see ``row_index``) and the payload columns. The
    lists follow one another under one numbering, so a page holds the end of one and the start of the next
    where they meet: ``pagina``, ``paginas`` and one array column per list, in order, empty where the page
    has none. Without any row there is one empty page. Positions come from the range-partitioned index of
    each list, so no task holds a whole list.
    """
    placed = None
    spark = next(iter(lists.values()))[0].sparkSession
    types = {name: rows.select(F.struct(*payload).alias("s")).schema["s"].dataType for name, (rows, _, payload) in lists.items()}
    total = 0
    for name, (rows, order, payload) in lists.items():
        idx, totals = _indexed(rows, order, None, "__i")
        at = (F.col("__i") + F.lit(total)).alias("at")
        part = idx.select(at, *[(F.struct(*payload) if n == name else F.lit(None).cast(types[n])).alias(n) for n in lists])
        placed = part if placed is None else placed.unionByName(part)
        total += totals.first()["total"]  # one number, from the per-partition counts
    pages = max(1, -(-total // max_items))

    def items(name: str) -> Column:
        found = F.sort_array(F.collect_list(F.when(F.col(name).isNotNull(), F.struct("at", F.col(name).alias("v")))))
        return found.getField("v").alias(name)
    out = placed.groupBy(F.floor(F.col("at") / max_items).cast("int").alias("pagina")).agg(*[items(n) for n in lists])
    if total == 0:
        out = spark.range(1).select(F.lit(0).alias("pagina"), *[F.array().cast(T.ArrayType(types[n])).alias(n) for n in lists])
    return out.select("pagina", F.lit(pages).alias("paginas"), *lists)


def run_summary(df: DataFrame, counters: dict[str, Column]) -> DataFrame:
    """AG-18: one row of run counters, e.g. ``{'total': F.count(F.lit(1))}``."""
    return df.agg(*[c.alias(n) for n, c in counters.items()])


# --------------------------------------------------------------------- JS-1
# The value profiles of SURVEY 2.11. 'iso_float_strict' (the
# dossier's) equals 'iso_float' here: its only difference, failing on a
# time-of-day value, cannot arise as Spark has no time-of-day column type.
PROFILES = ("iso_float", "iso_float_strict", "text", "text_isots", "br_offset", "utc_offset")


def _serialise_value(c: Column, dt: T.DataType, profile: str) -> Column:
    if isinstance(dt, T.DecimalType):
        return c.cast("double") if profile.startswith("iso_float") else c.cast("string")
    if isinstance(dt, (T.TimestampNTZType, T.TimestampType)):
        ntz = c.cast("timestamp_ntz")
        if profile == "br_offset":
            return D.iso_offset(ntz, "-03:00")
        if profile == "utc_offset":
            return D.iso_offset(ntz, "+00:00")
        micros = F.date_format(ntz, "SSSSSS")
        frac = F.when(micros != "000000", F.concat(F.lit("."), micros)).otherwise(F.lit(""))
        sep = " " if profile == "text" else "'T'"
        return F.when(ntz.isNotNull(), F.concat(F.date_format(ntz, f"yyyy-MM-dd{sep}HH:mm:ss"), frac))
    if isinstance(dt, T.DateType):
        if profile == "br_offset":
            return D.iso_offset(c, "-03:00")
        if profile == "utc_offset":
            return D.iso_offset(c, "+00:00")
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(dt, T.BinaryType):
        return F.decode(c, "UTF-8")
    if isinstance(dt, T.ArrayType) and isinstance(dt.elementType, T.StructType):
        st = dt.elementType
        return F.transform(c, lambda s: F.struct(*[
            _serialise_value(s[f.name], f.dataType, profile).alias(f.name) for f in st.fields]))
    if isinstance(dt, T.StructType):
        return F.struct(*[_serialise_value(c[f.name], f.dataType, profile).alias(f.name) for f in dt.fields])
    return c


def serialised(df: DataFrame, profile: str, columns: Sequence[str] | None = None) -> list[Column]:
    """JS-1: the JSON-ready values of a job profile (2.11) of the columns of ``df``, or of some of them."""
    if profile not in PROFILES:
        raise ValueError(f"unknown profile {profile!r}")
    return [_serialise_value(F.col(c), df.schema[c].dataType, profile).alias(c) for c in columns or df.columns]


def serialise(df: DataFrame, profile: str) -> DataFrame:
    """JS-1: ``df`` with its columns as JSON-ready values."""
    return df.select(*serialised(df, profile))


# Fixed value: the warning on the final batch when windows failed.
FAILED_WINDOWS = "{n} janela(s) falharam e serão refeitas no próximo sync"


def with_envelope(batches: DataFrame, tail: str = "none", failed_windows: int = 0) -> DataFrame:
    """DL-3/DL-4: the run fields of a delivery next to ``batch_index``, ``is_last`` and ``rows``.

    ``'final'``: on the last batch ``final``, the counts that ``to_batches`` was asked for and, if windows
    failed, ``aviso``; null elsewhere. ``'trailer'``: ``batch_total``, -1 until the closing batch, there the
    number of batches.
    """
    env = batches.select("batch_index", "is_last", "rows")
    if tail == "trailer":
        return env.withColumn("batch_total", F.when(F.col("is_last"), F.col("batch_index") + 1).otherwise(-1))
    if tail != "final":
        return env
    counts = [c for c in batches.columns if c not in ("batch_index", "is_last", "n_rows", "rows")]
    warning = FAILED_WINDOWS.format(n=failed_windows) if failed_windows else None
    return batches.select("batch_index", "is_last", "rows", F.col("is_last").alias("final"),
                          *[F.when(F.col("is_last"), F.col(c)).alias(c) for c in counts],
                          F.when(F.col("is_last"), F.lit(warning)).cast("string").alias("aviso"))


MANIFEST_DDL = "run string, started_at string, rows long, documents long, schema string"


def write_delivery(docs: DataFrame, path: str, started_at: str) -> int:
    """DL-6, DL-7: write the documents of one run and commit them by a manifest row; returns the rows.

    ``docs`` are envelopes (with ``rows``), one JSON document each, or one plain list (DL-6). Every run has
    a folder of its own under ``path``; ``read_delivery`` reads the runs that the manifest names, with the
    schema it names, so a broken or unfinished run is never seen and an empty one still has its columns.
    Envelopes are written as gzip (``.json.gz``), the lines of a list as they are.
    """
    spark = docs.sparkSession
    seen = Observation()
    batched = "rows" in docs.columns
    # a line of an envelope is a whole batch, whose rows repeat every field name
    packed = {"compression": "gzip"} if batched else {}
    rows = F.coalesce(F.sum(F.size("rows") if batched else F.lit(1)), F.lit(0)).cast("long")
    if batched:
        docs = docs.select(F.lit(started_at).alias("started_at"), *docs.columns)
    run = uuid.uuid4().hex
    observed = docs.observe(seen, rows.alias("rows"), F.count(F.lit(1)).alias("documents"))
    with shuffles_dropped(spark):
        observed.write.options(ignoreNullFields="false", **packed).json(f"{path}/run={run}")
    counts = seen.get
    record = [(run, started_at, int(counts["rows"] or 0), int(counts["documents"]), docs.schema.json())]
    spark.createDataFrame(record, MANIFEST_DDL).coalesce(1).write.mode("append").json(f"{path}/_manifest")
    return record[0][2]


def deliveries(spark: SparkSession, path: str) -> DataFrame:
    """The committed runs of a delivery."""
    return spark.read.schema(MANIFEST_DDL).json(f"{path}/_manifest")


def read_delivery(spark: SparkSession, path: str, run: str | None = None) -> DataFrame:
    """The documents of a committed run, by default the one started last."""
    runs = deliveries(spark, path)
    found = (runs if run is None else runs.where(F.col("run") == run)).orderBy(F.desc("started_at"), "run").limit(1).collect()
    if not found:
        raise ValueError(f"no committed delivery in {path}")
    return spark.read.schema(T.StructType.fromJson(json.loads(found[0]["schema"]))).json(f"{path}/run={found[0]['run']}")


def clean_fields(df: DataFrame, cols) -> DataFrame:
    """JS-2: read the SAP date texts of ``cols`` with SC-17 (invalid -> NULL)."""
    return df.select(*[D.sap_date(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])
