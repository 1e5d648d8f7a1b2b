"""Loading the source tables of the jobs.

A spec maps a source name to how it is read::

    {"ekpo": {"format": "parquet", "path": "s3a://lake/sap/ekpo"},
     "hourmeter": {"format": "jdbc", "url": "jdbc:mysql://...", "table": "telemetry.hourmeter",
                   "predicates": ["event_datetime >= '2024-01-01'"], "properties": {"user": "..."},
                   "optional": True},
     "hourmeter_invalid": {"same_as": "hourmeter", "table": "telemetry.hourmeter_invalid"},
     "ekko": {"format": "parquet", "path": "s3a://lake/sap/ekko",
              "dates": {"column": "bedat", "month": "mes", "total_days": 1095, "as_of": "2024-03-01"}}}

``dates`` reads only a range of days, the last ``total_days`` up to ``as_of`` (SRC-5): ``column`` is the SAP
date text, ``month`` the partition column of a table written by ``write_by_month``, whose folders outside
the range are not listed as input. With ``step`` a JDBC source is read in disjoint slices, one partition
of the read each.

Column names are lower-cased at the boundary, so quoted mixed-case source
columns (``"NumeroPedido"``) and SAP upper-case names become the snake/lower
case names the jobs use. A source marked ``optional`` that cannot be read is
left out; jobs that need it are then skipped by the run manifest (SRC-4).
"""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.functions.dates import sap_date
from fleetlake.functions.predicates import between_days

log = logging.getLogger(__name__)


def _read(spark: SparkSession, spec: dict) -> DataFrame:
    fmt = spec.get("format", "parquet")
    if fmt == "jdbc":
        props = dict(spec.get("properties", {}))
        predicates = spec.get("predicates")
        if "dates" in spec:
            d = _range(spec["dates"])
            predicates = jdbc_date_predicates(d["column"], d["total_days"], d.get("step") or d["total_days"], d["as_of"])
        if predicates:
            # one partition per predicate: date slices of SRC-5 read in parallel
            return spark.read.jdbc(spec["url"], spec["table"], predicates=predicates, properties=props)
        reader = spark.read.format("jdbc").option("url", spec["url"]).option("dbtable", spec["table"])
        for k, v in props.items():
            reader = reader.option(k, v)
        return reader.load()
    reader = spark.read.format(fmt)
    for k, v in spec.get("options", {}).items():
        reader = reader.option(k, v)
    df = reader.load(spec["path"])
    return date_range(df, **_range(spec["dates"])) if "dates" in spec else df


def _range(dates: dict) -> dict:
    as_of = dates["as_of"]
    return dates | {"as_of": dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of}


def write_by_month(df: DataFrame, path: str, column: str, month: str = "mes", mode: str = "overwrite") -> None:
    """Write a source as parquet with one folder per month of the SAP date text ``column`` (NULL for texts
    that are no date), so that ranges of days read few folders. Rows of a month are written by the tasks
    that hold them; a month with most rows is not gathered in one."""
    df.withColumn(month, F.date_format(sap_date(F.col(column)), "yyyyMM").cast("int")).write.mode(mode).partitionBy(month).parquet(path)


def date_range(df: DataFrame, column: str, total_days: int, as_of: dt.date, month: str | None = None, step: int | None = None) -> DataFrame:
    """Rows dated in the last ``total_days`` days up to ``as_of``, both ends included. With ``month`` the
    partitions of other months are pruned; the partition column is not part of the table."""
    first = as_of - dt.timedelta(days=total_days)
    rows = df.where(between_days(F.col(column), total_days, 0, as_of))
    if month:
        rows = rows.where(F.col(month).between(first.year * 100 + first.month, as_of.year * 100 + as_of.month)).drop(month)
    return rows


def _resolve(specs: dict[str, dict], name: str) -> dict:
    """SRC-4: a spec may take its settings from another one (``same_as``)."""
    spec = dict(specs[name])
    base = spec.pop("same_as", None)
    if base:
        merged = _resolve(specs, base)
        merged.pop("optional", None)
        merged.update(spec)
        return merged
    return spec


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def load_tables(spark: SparkSession, specs: dict[str, dict]) -> dict[str, DataFrame]:
    """Read every source of ``specs``; optional ones that fail are left out."""
    out: dict[str, DataFrame] = {}
    for name in specs:
        spec = _resolve(specs, name)
        try:
            out[name] = lower_columns(_read(spark, spec))
        except Exception as e:  # noqa: BLE001
            if not spec.get("optional"):
                raise
            log.warning("optional source %s skipped: %s", name, str(e).splitlines()[0] if str(e) else e)
    return out


def missing(tables: dict[str, DataFrame], needed) -> list[str]:
    """Names of ``needed`` sources that were not loaded."""
    return [n for n in needed if n not in tables]


def jdbc_date_predicates(column: str, total_days: int, step: int, as_of: dt.date,
                         fmt: str = "%Y%m%d") -> list[str]:
    """SRC-5: one JDBC partition predicate per day slice of the range.

    The slices follow the backfill windows (BF-1) but are half-open, so the
    partitions are disjoint and cover ``as_of - total_days .. as_of`` once:
    a row on a day shared by two windows is read once, not twice. ``fmt`` is
    the text form of the date column in the source.
    """
    out = []
    ini = total_days
    while ini > 0:
        fim = max(0, ini - step)
        lo = (as_of - dt.timedelta(days=ini)).strftime(fmt)
        hi = (as_of - dt.timedelta(days=fim)).strftime(fmt)
        last = fim == 0
        out.append(f"{column} >= '{lo}' AND {column} {'<=' if last else '<'} '{hi}'")
        ini -= step
    return out
