"""Date helpers: tolerant SAP dates, zones, day arithmetic."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetlake.functions._util import as_col
from fleetlake.functions.keys import digits

# ISO date/time shapes accepted by Python's ``datetime.fromisoformat``
# (two-digit month and day; optional time, fraction and offset).
ISO_SHAPE = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}([.,]\d{1,6})?)?)?)?(Z|[+-]\d{2}(:?\d{2})?)?$"


def sap_timestamp(c) -> Column:
    """SC-17 as a TIMESTAMP_NTZ.

    Text without a digit (blank, 'none', 'null', 'nan', 'nat', 'infinity') and
    all-zero digit strings give NULL. When the digits of the text are exactly eight, they are read as
    ``yyyyMMdd`` (so ``x2024-01-31`` is a date, ``2024-1-31`` is not).
    Otherwise the text is read as an ISO timestamp, keeping the written wall
    clock (an offset is not applied); anything invalid is NULL. The result
    does not depend on the session time zone.
    Date and timestamp inputs pass through.
    """
    col = as_col(c)
    s = F.trim(col.cast("string"))
    d = digits(s)
    # parsed without the session time zone: a compact text is a date (a
    # timestamp parse would move midnight inside old DST gaps), an ISO text
    # keeps the wall clock as written, like Python's fromisoformat
    compact = F.try_to_date(d, "yyyyMMdd").cast("timestamp_ntz")
    iso = F.when(s.rlike(ISO_SHAPE), s.try_cast("timestamp_ntz"))
    # NULL, blank text and the words have no digit; eight zeros are no date. Few references to the text,
    # as each is evaluated by itself in a filter
    return F.when(F.length(d) == 8, compact).when(F.ltrim(d, F.lit("0")) != "", iso)


def sap_date(c) -> Column:
    """SC-17 as a DATE (see ``sap_timestamp``)."""
    return sap_timestamp(c).cast("date")


def null_date(c) -> Column:
    """SC-24: the sentinel '0000-00-00' becomes NULL; other values pass."""
    col = as_col(c)
    return F.when(col.cast("string") != "0000-00-00", col)


def iso_offset(c, offset: str) -> Column:
    """ISO text of a naive date/timestamp with a fixed offset, Python style.

    A date gives midnight. Microseconds are printed only when not zero, like
    ``datetime.isoformat``.
    """
    ts = as_col(c).cast("timestamp_ntz")
    base = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "SSSSSS")
    return F.when(ts.isNotNull(), F.concat(
        base, F.when(micros != "000000", F.concat(F.lit("."), micros)).otherwise(F.lit("")),
        F.lit(offset)))


def stamp_dmy(c, zero: str = "0.0000000") -> Column:
    """SC-25: change stamp ``YYYYMMDD...`` to ``DD-MM-YYYY``; the zero stamp gives ''.

    SC-12: the year is ``substring(s, 1, 4)``; PostgreSQL's ``substring(s, 0, 5)``
    means the same four characters.
    """
    s = as_col(c).cast("string")
    return F.when(s == zero, F.lit("")).otherwise(
        F.concat(F.substring(s, 7, 2), F.lit("-"), F.substring(s, 5, 2), F.lit("-"), F.substring(s, 1, 4)))


def day_windows(total_days: int, step: int, as_of: dt.date) -> list[tuple[int, dt.date, dt.date]]:
    """BF-1: windows counted back from ``as_of``; both ends inclusive.

    Window i covers ``as_of - ini`` to ``as_of - fim`` with ``ini`` starting
    at ``total_days`` and going down by ``step``; ``fim = max(0, ini - step)``.
    Neighbouring windows share one day. Returned oldest first as
    (window_index, first_day, last_day).
    """
    out = []
    ini, i = total_days, 0
    while ini > 0:
        fim = max(0, ini - step)
        out.append((i, as_of - dt.timedelta(days=ini), as_of - dt.timedelta(days=fim)))
        ini -= step
        i += 1
    return out


def first_window_index(d, total_days: int, step: int, as_of: dt.date) -> Column:
    """Index of the oldest window of ``day_windows`` that holds date ``d``.

    Pure date arithmetic, so a row is placed without joining to a window
    table. Rows outside the range give NULL.
    """
    back = F.datediff(F.lit(as_of), as_col(d))  # days before as_of
    # window i covers x = total_days - back in [i*step, (i+1)*step]; a day on
    # the shared edge belongs first to the older window
    x = F.lit(total_days) - back
    i = F.greatest(F.ceil(x / F.lit(step)).cast("int") - 1, F.lit(0))
    return F.when((back >= 0) & (back <= total_days), i)
