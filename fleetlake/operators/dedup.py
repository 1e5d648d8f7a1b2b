"""Latest-per-key and first-wins deduplication.

All of them are one window with ``row_number``/``rank`` filtered to 1.
Catalyst turns that filter into a ``WindowGroupLimit`` that runs *before*
the shuffle as well as after it, so a hot key with a third of all rows is
cut down to its top rows inside every map task: the shuffle and the final
window see at most (tasks x ties) rows per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.functions._util import as_col

_RN = "__rn"


def _cols(x) -> list[Column]:
    if x is None:
        return []
    if isinstance(x, (str, Column)):
        x = [x]
    return [as_col(c) for c in x]


def first_per_key(df: DataFrame, key, order: Sequence, tiebreak: Sequence | None = None) -> DataFrame:
    """AG-8/AG-9/AG-10, SO-3: keep the first row per ``key`` under ``order``.

    The DataFrame form needs no ``QUALIFY`` (S-23: not parsed by Spark SQL).

    ``order`` holds sort columns with explicit null placement
    (``F.col(x).desc_nulls_first()`` ...). ``tiebreak`` adds columns that
    make the order total, so the kept row never depends on partitioning.
    """
    w = Window.partitionBy(*_cols(key)).orderBy(*(_cols(order) + _cols(tiebreak)))
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def latest_per_key(df: DataFrame, key, ts, ties: str = "one", tiebreak: Sequence | None = None) -> DataFrame:
    """JN-11/WN-1/WN-5: newest row per key by ``ts`` (NULL ``ts`` never wins).

    ``ties='all'`` keeps every row that shares the newest ``ts`` (the same rows
    as a self-join on ``max(ts)``); ``ties='one'`` keeps one, chosen by
    ``tiebreak``.
    """
    t = as_col(ts) if not isinstance(ts, (list, tuple)) else None
    order = [c.desc_nulls_last() for c in (_cols(ts))]
    if ties == "all":
        w = Window.partitionBy(*_cols(key)).orderBy(*order)
        out = df.withColumn(_RN, F.rank().over(w)).filter(F.col(_RN) == 1).drop(_RN)
        # the self-join form drops keys whose newest ts is NULL
        return out.filter(t.isNotNull()) if t is not None else out
    return first_per_key(df, key, order, tiebreak)


def best_per_key(df: DataFrame, key, priority: Sequence[Column], tiebreak: Sequence | None = None) -> DataFrame:
    """WN-4: first row per key under ordered priority tests (true first)."""
    order = [F.when(p, 1).otherwise(2) for p in priority]
    return first_per_key(df, key, order, tiebreak)


def any_match(pred: Column) -> Column:
    """AG-5: aggregate 'any row satisfies pred' (NULL counts as no)."""
    return F.bool_or(F.coalesce(pred, F.lit(False)))
