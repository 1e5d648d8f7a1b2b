"""Windowed backfill and run manifest.

The reference loops over day windows and sends each one, keeping a seen-set
in the process; failures of one window are counted and the rest goes on.
Here the range is read once: every row carries the windows it falls in by
date arithmetic, the dedup is one shuffle on the key, and the manifest is a
small DataFrame built from per-job outcomes.
"""

from __future__ import annotations

import datetime as dt
import traceback
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.functions import dates as D
from fleetlake.functions.predicates import between_days
from fleetlake.operators.dedup import first_per_key
from fleetlake.operators.stored import reason, remove, shared_folder, shuffles_dropped, store_parts


def window_table(spark: SparkSession, total_days: int, step: int, as_of: dt.date) -> DataFrame:
    """BF-1 windows as a DataFrame (one row per window, ``total_days/step`` rows)."""
    rows = [(i, a, b) for i, a, b in D.day_windows(total_days, step, as_of)]
    schema = T.StructType([T.StructField("janela", T.IntegerType()), T.StructField("inicio", T.DateType()),
                           T.StructField("fim", T.DateType())])
    return spark.createDataFrame(rows, schema)


def window_memberships(d: Column, total_days: int, step: int, as_of: dt.date) -> Column:
    """Array of the windows holding date ``d``: one, or two on a shared edge day."""
    n = len(D.day_windows(total_days, step, as_of))
    first = D.first_window_index(d, total_days, step, as_of)
    back = F.datediff(F.lit(as_of), d)
    x = F.lit(total_days) - back
    edge = (x > 0) & (x % step == 0) & (first + 1 < n)
    return F.when(first.isNull(), F.array().cast("array<int>")).when(
        edge, F.array(first, first + 1)).otherwise(F.array(first))


def window_counts(spark: SparkSession, rows: DataFrame, date_col: str, key: list[str], order: list[Column],
                  guard: Column, total_days: int, step: int, as_of: dt.date,
                  spread_by: list[str] | None = None) -> DataFrame:
    """BF-3 counters per window, in one pass over the window query rows.

    ``linhas``: rows each window query returns (a row on a shared edge day
    counts in both windows, S-17). ``novas``: rows first kept in the window,
    i.e. rows passing ``guard`` that come first for their ``key`` under
    ``order`` (whose first sort key is the window index). One window ranks
    the rows; rows failing the guard are ranked on a spread key so they do
    not gather in one task (``spread_by`` names the columns hashed for that,
    so that all others can be pruned); then one aggregation over the exploded window
    memberships.
    """
    w = window_table(spark, total_days, step, as_of)
    d = D.sap_date(F.col(date_col))
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in spread_by or rows.columns]), F.lit(1024))
    keyed = rows.withColumn("__ok", F.coalesce(guard, F.lit(False)))
    parts = [F.when(F.col("__ok"), F.col(k).cast("string")).otherwise(
        F.concat(F.lit("\u0000"), spread.cast("string"))) for k in key]
    ranked = keyed.withColumn("__rn", F.row_number().over(Window.partitionBy(*parts).orderBy(*order)))
    kept = F.col("__ok") & (F.col("__rn") == 1)
    first = D.first_window_index(d, total_days, step, as_of)
    per = ranked.select(kept.alias("__kept"), first.alias("__first"),
                        F.explode(window_memberships(d, total_days, step, as_of)).alias("janela"))
    c = per.groupBy("janela").agg(F.count(F.lit(1)).alias("linhas"),
                                  F.count_if(F.col("__kept") & (F.col("__first") == F.col("janela"))).alias("novas"))
    return (w.join(c, "janela", "left")
            .select("janela", "inicio", "fim", F.coalesce("linhas", F.lit(0)).alias("linhas"),
                    F.coalesce("novas", F.lit(0)).alias("novas")))


MANIFEST_SCHEMA = T.StructType([
    T.StructField("job", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("rows", T.LongType()), T.StructField("error", T.StringType())])


def run_jobs(spark: SparkSession, jobs: dict[str, Callable[[], DataFrame]],
             sink: Callable[[str, DataFrame], DataFrame | None] | None = None,
             available: set[str] | None = None, needs: dict[str, list[str]] | None = None,
             parallel: int = 4, notes: dict[str, Callable[[], tuple[str, str] | None]] | None = None) -> DataFrame:
    """BF-4: run independent jobs; one failing job does not stop the next.

    Each job builds a DataFrame; ``sink(name, df)`` writes it and may return
    a DataFrame over what it wrote, which is then counted instead of running
    the job twice (default: the job is only counted). The jobs are
    independent, so up to ``parallel`` of them are submitted at once from
    driver threads and share the executors. The manifest has one row per
    job, in the order given: status ``ok``, ``error`` or ``skipped`` (SRC-4:
    a source named in ``needs`` is not in ``available``), rows and the error
    text. ``notes`` gives after a job that ended the status and error text of a row whose job went without an
    optional part, e.g. ``partial`` if that part failed. The manifest is built on the driver from the
    outcomes; no job data passes through the driver.
    """
    def one(name: str, job: Callable[[], DataFrame]) -> tuple:
        lacking = [n for n in (needs or {}).get(name, []) if available is not None and n not in available]
        if lacking:
            # SRC-4: an optional source is not configured; the job is skipped
            return (name, "skipped", None, "missing sources: " + ", ".join(lacking))
        try:
            df = job()  # a DataFrame to count, or the count of what the job has written
            written = sink(name, df) if sink is not None else None
            df = written if written is not None else df
            rows = df if isinstance(df, int) else int(df.count())
            status, error = (notes or {}).get(name, lambda: None)() or ("ok", None)
            return (name, status, rows, error)
        except Exception as e:  # noqa: BLE001 - isolation is the point
            traceback.print_exc()
            return (name, "error", None, str(e) or repr(e))

    with shuffles_dropped(spark), ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        futures = [pool.submit(one, n, j) for n, j in jobs.items()]
        out = [f.result() for f in futures]
    return spark.createDataFrame(out, MANIFEST_SCHEMA)


# ------------------------------------------------------------------ BF-3, windows that can fail
LEDGER_SCHEMA = T.StructType([
    T.StructField("run", T.StringType()), T.StructField("tentativa", T.IntegerType()), T.StructField("janela", T.IntegerType()),
    T.StructField("inicio", T.DateType()), T.StructField("fim", T.DateType()), T.StructField("status", T.StringType()),
    T.StructField("novas", T.LongType()), T.StructField("erro", T.StringType())])


class AllWindowsFailed(RuntimeError):
    """No window of the run could be delivered (BF-3); the message holds the first error."""


@dataclass(frozen=True)
class WindowedDelivery:
    """BF-3: rows delivered window by window into ``path``, which must be shared storage.

    ``source`` is the job's query over the whole range, with the SAP date text in ``date_col``; a window
    filters it, so that the bounds of its days reach the scan. ``key`` and ``order`` are the seen-set of
    the job: of the rows of a key the one of the oldest delivered window stays, within a window the first
    under ``order``.

    ``path/rows`` holds the rows by window; a write replaces only the windows it covers (dynamic partition
    overwrite). ``path/ledger`` holds one outcome per run, attempt and window. A window's rows count only
    if the ledger names the attempt that wrote them, so that what a broken or older attempt left behind
    is never read.

    ``prepared`` gives the rows of ``source`` in slices whose keys differ, made from parts that are written
    beforehand; an attempt writes one slice after the other. It is called by the first attempt, whose windows
    fail if it does.
    """

    spark: SparkSession
    path: str
    source: DataFrame
    date_col: str
    key: Sequence[Column]
    order: Sequence[Column]
    total_days: int
    step: int
    as_of: dt.date
    prepared: Callable[[], list[DataFrame]] | None = None

    def windows(self) -> list[tuple[int, dt.date, dt.date]]:
        return D.day_windows(self.total_days, self.step, self.as_of)

    def start(self) -> str:
        """Deliver all windows as a new run and return its name. Raises ``AllWindowsFailed``."""
        run = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S.%f")
        outcomes = self._deliver(run, 1, [i for i, _, _ in self.windows()], [])
        errors = [o[-1] for o in outcomes if o[5] != "ok"]
        if len(errors) == len(outcomes):
            raise AllWindowsFailed(f"todas as janelas falharam: {errors[0] if errors else 'sem detalhe'}")
        return run

    def retry(self, run: str, windows: Sequence[int] | None = None) -> None:
        """Deliver windows of ``run`` again, by default those whose last attempt failed. The others stay as
        they are, and keys that they have delivered are left out."""
        last = self.outcomes(run).select("janela", "status", "tentativa").collect()
        again = [r["janela"] for r in last if (r["status"] != "ok" if windows is None else r["janela"] in windows)]
        self._deliver(run, 1 + max(r["tentativa"] for r in last), again,
                      [r["janela"] for r in last if r["status"] == "ok" and r["janela"] not in again])

    def ledger(self) -> DataFrame:
        return self.spark.read.schema(LEDGER_SCHEMA).parquet(f"{self.path}/ledger")

    def outcomes(self, run: str) -> DataFrame:
        """The last attempt of every window of a run."""
        return first_per_key(self.ledger().where(F.col("run") == run), "janela", [F.col("tentativa").desc()])

    def failed_windows(self, run: str) -> int:
        return self.outcomes(run).where("status <> 'ok'").count()

    def rows(self, run: str) -> DataFrame:
        """The delivered rows of a run with their window ``janela``."""
        good = first_per_key(self.ledger().where((F.col("run") == run) & (F.col("status") == "ok")), "janela",
                             [F.col("tentativa").desc()]).select("janela", F.col("run").alias("_run"), F.col("tentativa").alias("_tentativa"))
        # one row per window: a proven size bound
        return self._stored().join(F.broadcast(good), ["janela", "_run", "_tentativa"]).drop("_run", "_tentativa")

    @cached_property
    def _slices(self) -> list[DataFrame]:
        return [self.source] if self.prepared is None else self.prepared()

    @cached_property
    def _schema(self) -> T.StructType:
        return T.StructType([*self.source.schema.fields, T.StructField("_run", T.StringType()), T.StructField("_tentativa", T.IntegerType()),
                             T.StructField("janela", T.IntegerType())])

    def _stored(self) -> DataFrame:
        # no file has been written yet if every window so far was empty, so the schema is given
        return self.spark.read.schema(self._schema).parquet(f"{self.path}/rows")

    def _record(self, outcomes: list[tuple]) -> list[tuple]:
        self.spark.createDataFrame(outcomes, LEDGER_SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.path}/ledger")
        return outcomes

    def _deliver(self, run: str, attempt: int, windows: list[int], done: list[int]) -> list[tuple]:
        outcomes: list[tuple] = []
        for chunk in _neighbours(windows):
            outcomes += self._attempt(run, attempt, chunk, done)
        return outcomes

    def _attempt(self, run: str, attempt: int, chunk: list[int], done: list[int]) -> list[tuple]:
        """Deliver neighbouring windows in one job; if it fails, each half by itself, older half first, so
        that F failing windows of W cost about F log W jobs. ``done`` are the windows delivered so far."""
        days = {i: (a, b) for i, a, b in self.windows()}
        made = shared_folder(self.spark, "windows") if self.prepared is not None else None
        try:
            new = [self._new_rows(part, run, chunk, days[chunk[0]][0], days[chunk[-1]][1], done) for part in self._slices]
            rows = store_parts(lambda k: new[k], len(new), "windows", made) if made else new[0]
            with shuffles_dropped(self.spark):
                (rows.withColumn("_run", F.lit(run)).withColumn("_tentativa", F.lit(attempt)).write.mode("overwrite")
                 .option("partitionOverwriteMode", "dynamic").partitionBy("janela").parquet(f"{self.path}/rows"))
        except Exception as e:  # noqa: BLE001 - isolation is the point
            if len(chunk) > 1:
                half = len(chunk) // 2
                return self._attempt(run, attempt, chunk[:half], done) + self._attempt(run, attempt, chunk[half:], done)
            text = reason(e)[:500]
            return self._record([(run, attempt, chunk[0], *days[chunk[0]], "error", None, text)])
        finally:
            if made:
                remove(self.spark, made)
        mine = (F.col("_run") == run) & (F.col("_tentativa") == attempt) & F.col("janela").isin(chunk)
        counts = {r["janela"]: r["count"] for r in self._stored().where(mine).groupBy("janela").count().collect()}
        done.extend(chunk)
        return self._record([(run, attempt, i, *days[i], "ok", counts.get(i, 0), None) for i in chunk])

    def _new_rows(self, source: DataFrame, run: str, chunk: list[int], first_day: dt.date, last_day: dt.date, done: list[int]) -> DataFrame:
        days = between_days(F.col(self.date_col), (self.as_of - first_day).days, (self.as_of - last_day).days, self.as_of)
        # a day shared with the window before belongs to the oldest of the windows at hand
        oldest = D.first_window_index(D.sap_date(F.col(self.date_col)), self.total_days, self.step, self.as_of)
        names = [f"__key{i}" for i in range(len(self.key))]
        keyed = source.where(days).withColumn("janela", F.greatest(oldest, F.lit(chunk[0])))
        best = first_per_key(keyed.withColumns(dict(zip(names, self.key))), names, [F.col("janela").asc(), *self.order])
        if done:
            seen = self.rows(run).where(F.col("janela").isin(done)).select(*[k.alias(n) for n, k in zip(names, self.key)])
            best = best.join(seen, names, "left_anti")
        return best.drop(*names)


def _neighbours(windows: Sequence[int]) -> list[list[int]]:
    """Sorted window numbers cut into runs without gaps."""
    out: list[list[int]] = []
    for i in sorted(windows):
        if out and out[-1][-1] == i - 1:
            out[-1].append(i)
        else:
            out.append([i])
    return out
