"""Windowed deliveries with failing windows, retries and the ledger."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

import star_queries as SQ
from fleetlake.operators.backfill import AllWindowsFailed, WindowedDelivery, _neighbours
from fleetlake.plans import delivery as DL
from fleetlake.sources.star import star_tables

AS_OF = dt.date(2024, 3, 1)
SF = "/root/testdata/sf0.001"


def day(back):
    return (AS_OF - dt.timedelta(days=back)).strftime("%Y%m%d")


# windows of 10 days over 40: days back 40..30, 30..20, 20..10, 10..0; 30, 20 and 10 are shared
ROWS = [("a", day(35), 1), ("a", day(25), 2), ("b", day(30), 3), ("c", day(22), 4), ("d", day(20), 5), ("e", day(12), 6), ("f", day(3), 7),
        ("f", day(3), 8), ("g", day(0), 9)]


def windowed(spark, path, bad=(), rows=ROWS):
    df = spark.createDataFrame(rows, "k string, d string, v int")
    broken = F.when(F.col("d").isin([day(b) for b in bad]), F.raise_error(F.lit("lost slice")).cast("string"))
    return WindowedDelivery(spark, str(path), df.withColumn("k", F.coalesce(broken, "k")), "d", [F.col("k")], [F.col("v").asc()], 40, 10, AS_OF)


def delivered(w, run):
    return sorted((r["k"], r["v"], r["janela"]) for r in w.rows(run).select("k", "v", "janela").collect())


WHOLE = [("a", 1, 0), ("b", 3, 0), ("c", 4, 1), ("d", 5, 1), ("e", 6, 2), ("f", 7, 3), ("g", 9, 3)]


def test_all_windows_in_one_job(spark, tmp_path):
    w = windowed(spark, tmp_path)
    run = w.start()
    assert delivered(w, run) == WHOLE and w.failed_windows(run) == 0
    assert [(r["janela"], r["novas"]) for r in w.outcomes(run).orderBy("janela").collect()] == [(0, 2), (1, 2), (2, 1), (3, 2)]


def test_failed_window_is_noted_and_retried(spark, tmp_path):
    run = windowed(spark, tmp_path, bad=[22]).start()
    w = windowed(spark, tmp_path)
    # the day shared with the next window is delivered by that one, and 'a' by the older window
    assert delivered(w, run) == [("a", 1, 0), ("b", 3, 0), ("d", 5, 2), ("e", 6, 2), ("f", 7, 3), ("g", 9, 3)]
    last = {r["janela"]: r for r in w.outcomes(run).collect()}
    assert w.failed_windows(run) == 1 and "lost slice" in last[1]["erro"] and last[1]["novas"] is None
    others = {f: os.path.getmtime(os.path.join(tmp_path, "rows", f)) for f in os.listdir(tmp_path / "rows") if f.startswith("janela=")}
    w.retry(run)
    assert delivered(w, run) == [("a", 1, 0), ("b", 3, 0), ("c", 4, 1), ("d", 5, 2), ("e", 6, 2), ("f", 7, 3), ("g", 9, 3)]
    assert {f: os.path.getmtime(os.path.join(tmp_path, "rows", f)) for f in others} == others  # only the failed window was written
    assert w.failed_windows(run) == 0 and w.ledger().count() == 5


def test_seen_keys_of_older_windows_are_left_out(spark, tmp_path):
    # window 0 fails: its 'a' is delivered by window 1; a retry brings only what nobody has delivered
    run = windowed(spark, tmp_path, bad=[35]).start()
    w = windowed(spark, tmp_path)
    assert ("a", 2, 1) in delivered(w, run) and ("b", 3, 1) in delivered(w, run)
    w.retry(run)
    assert delivered(w, run) == [("a", 2, 1), ("b", 3, 1), ("c", 4, 1), ("d", 5, 1), ("e", 6, 2), ("f", 7, 3), ("g", 9, 3)]


def test_refreshed_window_that_became_empty(spark, tmp_path):
    run = windowed(spark, tmp_path).start()
    w = windowed(spark, tmp_path, rows=[r for r in ROWS if r[0] != "e"])
    w.retry(run, [2])
    assert delivered(w, run) == [r for r in WHOLE if r[0] != "e"]


def test_new_run_does_not_see_an_older_one(spark, tmp_path):
    windowed(spark, tmp_path).start()
    w = windowed(spark, tmp_path, rows=ROWS[-1:])
    assert delivered(w, w.start()) == [("g", 9, 3)]
    empty = windowed(spark, tmp_path, rows=[])
    assert delivered(empty, empty.start()) == []


def test_all_windows_failed(spark, tmp_path):
    w = windowed(spark, tmp_path, bad=[35, 22, 12, 3])
    with pytest.raises(AllWindowsFailed, match="todas as janelas falharam: .*lost slice"):
        w.start()
    assert w.ledger().where("status = 'error'").count() == 4


def test_neighbours():
    assert _neighbours([3, 1, 2, 7, 5, 6]) == [[1, 2, 3], [5, 6, 7]] and _neighbours([]) == []


def test_windowed_jobs_deliver_the_same_rows_as_one_pass(spark, tmp_path):
    t = star_tables(spark, SF, SQ.RC_VIEWS)
    for name, params in (("requisition_flow", SQ.P_BF), ("purchase_history", SQ.Params(**{**SQ.STAR.__dict__, "hist_step_days": 405}))):
        w = DL.WINDOWED[name](t, params, str(tmp_path / name))
        env = DL.windowed_envelopes(name, t, params, w, w.start())
        whole = DL.job_envelopes(name, t, params)
        a, b = (sorted(map(repr, x.withColumn("rows", F.to_json("rows")).collect())) for x in (env, whole))
        assert a == b and len(a) > 1
