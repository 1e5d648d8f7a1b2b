"""Filter predicates of the jobs. All are Column expressions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetlake.functions._util import as_col
from fleetlake.functions.dates import sap_date
from fleetlake.functions.keys import has_key  # noqa: F401  (PF-12, re-exported)


def in_any(c, values: Sequence[str]) -> Column:
    """PF-4: ``col IN (...)``; NULL is not in any list."""
    return F.coalesce(as_col(c).isin(*values), F.lit(False))


def owned_by(group_cols: Sequence, user_col, groups: Sequence[str], users: Sequence[str]) -> Column:
    """PF-5: any group column in ``groups``, or the creator in ``users``."""
    cond = F.lit(False)
    for g in group_cols:
        cond = cond | in_any(g, groups)
    if user_col is not None:
        cond = cond | in_any(user_col, users)
    return cond


def like_any(c, needles: Sequence[str]) -> Column:
    """PF-6: text contains any of the substrings (``LIKE '%x%' OR ...``, S-19)."""
    col = as_col(c)
    cond = F.lit(False)
    for n in needles:
        cond = cond | col.contains(n)
    return cond


def ilike_any(c, patterns: Sequence[str]) -> Column:
    """PF-7: case-insensitive ``ILIKE`` against any pattern."""
    col = as_col(c)
    cond = F.lit(False)
    for pat in patterns:
        cond = cond | col.ilike(pat)
    return cond


def not_flag(c, flag: str) -> Column:
    """PF-8: NULL-safe 'not deleted': ``TRIM(COALESCE(x, '')) <> flag`` (NULL passes)."""
    return F.trim(F.coalesce(as_col(c), F.lit(""))) != flag


def blank_or(c, value: str) -> Column:
    """PF-11: the flag is NULL, blank or ``value``."""
    return F.coalesce(as_col(c), F.lit("")).isin("", value)


def year_range(c, first: int, last: int | None) -> Column:
    """Plain comparisons on the raw text that every date from year ``first`` to ``last`` passes, so that
    they reach the scan; the exact test decides.

    A date text is read by its digits (SC-17), so it may start with other characters and may have
    separators inside the year. A text of four leading digits passes if they lie in the range; so does one
    that starts with other characters, or with one to three digits of the first or last year and a
    separator. (With digits of the years between, it lies in the range of texts anyway.)
    """
    raw = as_col(c).cast("string")
    low = f"{first:04d}"
    inside = raw >= low
    if last is not None:
        inside = inside & (raw < f"{last + 1:04d}")
    for k in (1, 2, 3):
        # a separator that sorts before the digits puts the text below the first year, ...
        inside = inside | ((raw >= low[:k]) & (raw < low[:k] + "0"))
        if last is not None:
            # ... one that sorts behind them above the last
            top = f"{last:04d}"[:k]
            inside = inside | ((raw >= top + ":") & (raw < top[:-1] + chr(ord(top[-1]) + 1)))
    return inside | (raw < "0") | (raw >= ":")


def since(c, first_day: dt.date) -> Column:
    """PF-15: SAP date text on or after ``first_day`` (read as a date, SC-17)."""
    return year_range(c, first_day.year, None) & (sap_date(c) >= F.lit(first_day))


def between_days(c, ini: int, fim: int, as_of: dt.date, mode: str = "date") -> Column:
    """PF-16/PF-17, SC-20: ``as_of - ini <= c <= as_of - fim`` (``as_of`` replaces CURRENT_DATE).

    ``mode='date'`` reads the text as a date first (SC-17), so compact and
    dashed rows both count; ``mode='text'`` compares the raw text with
    compact bounds, as the purchase-history query does (S-9).
    """
    lo, hi = as_of - dt.timedelta(days=ini), as_of - dt.timedelta(days=fim)
    if mode == "text":
        col = as_col(c)
        return (col >= lo.strftime("%Y%m%d")) & (col <= hi.strftime("%Y%m%d"))
    # both bounds with one evaluation of the date: its distance from the middle, in half days
    days = (hi - lo).days
    return year_range(c, lo.year, hi.year) & (F.abs(F.datediff(sap_date(c), F.lit(lo)) * 2 - days) <= days)
