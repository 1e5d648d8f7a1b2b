"""Joins of the jobs: aggregated lookups, text lookups, semi joins.

No broadcast hints are written here. Dimension and lookup sides are
pre-aggregated to one row per key, and the physical choice is left to the
optimizer: AQE measures the shuffled side at run time and broadcasts it only
below ``spark.sql.adaptive.autoBroadcastJoinThreshold``; above that the join
stays sort-merge, with skewed partitions split by AQE.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.functions._util import as_col


SALT = "__salt"


def with_salt(df: DataFrame, cols: Sequence, buckets: int = 1024) -> DataFrame:
    """Add a deterministic spread value from columns that identify a row.

    Used by ``spread_nulls``: it depends only on the row's own values, so a
    retried task sends each row to the same place.
    """
    return df.withColumn(SALT, F.pmod(F.xxhash64(*[as_col(c) for c in cols]), F.lit(buckets)))


def spread_nulls(key, salt: Column | None = None) -> Column:
    """Left join key whose NULLs are spread over many shuffle partitions.

    A NULL key never matches, but a hash shuffle sends every NULL to one
    task: with a third of the rows lacking the key (requisitions without a
    PO, reservations without a requisition) that task would hold a third of
    the data. NULL becomes '\\0' + a salt value, which no real key equals.
    """
    k = as_col(key)
    s = salt if salt is not None else F.col(SALT)
    return F.coalesce(k, F.concat(F.lit("\u0000"), s.cast("string")))


def _cond(left_on: Sequence, names: Sequence[str], alias: str) -> Column:
    cond = None
    for lc, n in zip(left_on, names):
        e = as_col(lc) == F.col(f"{alias}.{n}")
        cond = e if cond is None else cond & e
    return cond


def agg_lookup(df: DataFrame, right: DataFrame, left_on: Sequence, right_on: Sequence,
               aggs: Sequence[Column], where: Column | None = None, name: str = "lk") -> DataFrame:
    """JN-10 / O-7: ``LEFT JOIN LATERAL (SELECT agg FROM right WHERE keys match) ON TRUE``.

    The right side is filtered, grouped to one row per key (a partial and a final
    aggregation, so a hot key is folded before the shuffle) and left
    joined. A key without rows gives NULL aggregates, like the lateral form.
    ``left_on`` are Columns of ``df``; ``right_on`` Columns of ``right``.
    """
    r = right.filter(where) if where is not None else right
    keyed = r.select(*[as_col(c).alias(f"__{name}{i}") for i, c in enumerate(right_on)],
                     *[c for c in r.columns])
    keys = [f"__{name}{i}" for i in range(len(right_on))]
    grouped = keyed.groupBy(*keys).agg(*aggs).alias(name)
    # NULL keys never match, as in SQL
    out = df.join(grouped, _cond(left_on, keys, name), "left")
    return out.drop(*[F.col(f"{name}.{k}") for k in keys])


def text_lookup(df: DataFrame, texts: DataFrame, left_on, right_on, text_col: str, out: str,
                lang_col: str | None = "spras", langs: Sequence[str] = ("P", "PT"),
                name: str = "tx") -> DataFrame:
    """JN-19 / S-11: text of a code in the given languages.

    ``max(text)`` per key (AG-2: MAX as pick-one; one row per key, as the lateral form).
    """
    where = as_col(lang_col).isin(*langs) if lang_col else None
    left_on = left_on if isinstance(left_on, (list, tuple)) else [left_on]
    right_on = right_on if isinstance(right_on, (list, tuple)) else [right_on]
    return agg_lookup(df, texts, left_on, right_on, [F.max(text_col).alias(out)], where, name)


def semi(df: DataFrame, keys: DataFrame, left_on: Sequence, right_on: Sequence) -> DataFrame:
    """JN-13/JN-14/JN-15: rows of ``df`` whose key is in ``keys`` (left semi join)."""
    k = keys.select(*[as_col(c).alias(f"__s{i}") for i, c in enumerate(right_on)]).alias("sk")
    return df.join(k, _cond(left_on, [f"__s{i}" for i in range(len(right_on))], "sk"), "left_semi")


def enrich_header(rows: DataFrame, header: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """JN-18: overwrite/add header ``fields`` on ``rows`` matching on ``keys``.

    ``header`` must hold one row per key (use ``first_per_key`` first).
    Rows without a match keep their own values of the fields (or NULL when
    they have none); matched rows take the header's values.
    """
    h = header.select(*[F.col(k).alias(f"__h_{k}") for k in keys], *[F.col(f).alias(f"__h_{f}") for f in fields])
    cond = None
    for k in keys:
        e = F.col(k) == F.col(f"__h_{k}")
        cond = e if cond is None else cond & e
    out = rows.join(h, cond, "left")
    matched = F.col(f"__h_{keys[0]}").isNotNull()
    for f in fields:
        own = F.col(f) if f in rows.columns else F.lit(None)
        out = out.withColumn(f, F.when(matched, F.col(f"__h_{f}")).otherwise(own))
    return out.drop(*[f"__h_{k}" for k in keys], *[f"__h_{f}" for f in fields])


def salted_join(left: DataFrame, right: DataFrame, left_key, right_key, hot: Sequence[str],
                how: str = "left", buckets: int = 64, name: str = "sj", spread: Sequence[str] | None = None,
                bucket_col: str | None = None) -> DataFrame:
    """Equi-join where a few known key values (``hot``) hold a large share of the left rows.

    Left rows with a hot key get a bucket from a hash of the whole row (or of the columns ``spread``), the
    right rows with that key are replicated into every bucket, and the join
    runs on (key, bucket): the hot key is spread over ``buckets`` tasks and
    every pair still meets exactly once. Other keys use bucket 0. The right
    side must hold few rows per hot key (a dimension or a pre-aggregated
    lookup), as those rows are copied ``buckets`` times. ``bucket_col`` keeps the bucket: a grouping by
    key, ``spread`` columns and bucket then needs no further shuffle.
    """
    lk, rk = as_col(left_key), as_col(right_key)
    # a NULL key matches nothing, but would gather in one task like any other value
    is_hot_l = lk.isNull() | lk.isin(*hot)
    l2 = left.withColumn(f"__{name}_b", F.when(is_hot_l, F.pmod(F.xxhash64(*[F.col(c) for c in spread or left.columns]),
                                                                F.lit(buckets)).cast("int")).otherwise(F.lit(0)))
    r2 = right.withColumn(f"__{name}_b", F.explode(F.when(rk.isin(*hot), F.sequence(F.lit(0), F.lit(buckets - 1)))
                                                   .otherwise(F.array(F.lit(0)))))
    r2 = r2.withColumnRenamed(f"__{name}_b", f"__{name}_rb")
    out = l2.join(r2, (lk == rk) & (F.col(f"__{name}_b") == F.col(f"__{name}_rb")), how)
    if bucket_col:
        out = out.withColumn(bucket_col, F.col(f"__{name}_rb"))
    return out.drop(f"__{name}_b", f"__{name}_rb")
