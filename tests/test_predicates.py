"""Predicates, key joins, header enrichment, manifest."""

import datetime as dt

from pyspark.sql import functions as F

from fleetlake.functions import predicates as PR
from fleetlake.operators.backfill import run_jobs
from fleetlake.operators.lookups import enrich_header


def vals(spark, rows, schema, pred):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(pred).collect()]


def test_flags_and_lists(spark):
    rows = [("L",), (" L ",), ("",), (None,), ("X",)]
    assert vals(spark, rows, "f string", PR.not_flag(F.col("f"), "L")) == [False, False, True, True, True]
    assert vals(spark, rows, "f string", PR.blank_or(F.col("f"), "L")) == [True, False, True, True, False]
    assert vals(spark, rows, "f string", PR.in_any(F.col("f"), ["X", "L"])) == [True, False, False, False, True]
    assert vals(spark, [("Preparo",), ("x",), (None,)], "t string", PR.ilike_any(F.col("t"), ["%prep%"])) == [
        True, False, None]


def test_between_days_and_since(spark):
    rows = [("20240215",), ("2024-02-20",), ("20240101",), (None,)]
    d = PR.between_days(F.col("d"), 30, 5, dt.date(2024, 3, 1))
    assert vals(spark, rows, "d string", d) == [True, True, False, None]
    assert vals(spark, rows, "d string", PR.since(F.col("d"), dt.date(2024, 2, 16))) == [False, True, False, None]


def test_enrich_header(spark):
    rows = spark.createDataFrame([("A", "1", "old"), ("B", "2", "keep")], "a string, o string, txt string")
    hdr = spark.createDataFrame([("A", "1", "new", "x")], "a string, o string, txt string, extra string")
    got = sorted(tuple(r) for r in enrich_header(rows, hdr, ["a", "o"], ["txt", "extra"]).collect())
    assert got == [("A", "1", "new", "x"), ("B", "2", "keep", None)]


def test_run_jobs_isolates_failures(spark):
    def bad():
        raise RuntimeError("boom")
    m = run_jobs(spark, {"a": lambda: spark.range(3), "b": bad, "c": lambda: spark.range(1)},
                 available={"x"}, needs={"c": ["x", "y"]})
    got = {r["job"]: (r["status"], r["rows"]) for r in m.collect()}
    assert got == {"a": ("ok", 3), "b": ("error", None), "c": ("skipped", None)}


def test_salted_join_matches_plain_join(spark):
    from fleetlake.operators.lookups import salted_join
    left = spark.createDataFrame([("", i) for i in range(40)] + [("a", 100), ("b", 101), (None, 102)],
                                 "k string, v int")
    right = spark.createDataFrame([("", "blank1"), ("", "blank2"), ("a", "A")], "rk string, w string")
    plain = sorted(map(tuple, left.join(right, left.k == right.rk, "left").select("v", "w").collect()),
                   key=repr)
    salted = sorted(map(tuple, salted_join(left, right, "k", "rk", [""], buckets=8).select("v", "w").collect()),
                    key=repr)
    assert salted == plain and len(salted) == 83


def test_year_range_passes_every_date_of_the_years(spark):
    """Separators of any kind anywhere in the text: a date of the wanted years is never cut off."""
    import itertools
    import random

    from fleetlake.functions.dates import sap_date
    from fleetlake.functions.predicates import year_range
    r = random.Random(2)
    texts = []
    for year, sep in itertools.product((1989, 1994, 1995, 1996, 1999, 2000, 2001, 2002, 2010, 3001), ("", "-", "/", " ", ".", ":", "x", "~", "\u00e9")):
        day = f"{year}{r.randint(1, 12):02d}{r.randint(1, 28):02d}"
        for at in range(9):
            texts.append(day[:at] + sep + day[at:])
        texts.append(sep.join(day))
    df = spark.createDataFrame([(t,) for t in texts], "d string")
    for first, last in ((1995, 2001), (1995, 1995), (1999, 2010), (2000, None), (1995, None)):
        wanted = F.year(sap_date(F.col("d"))).between(first, last or 9999)
        rows = df.select(wanted.alias("wanted"), year_range(F.col("d"), first, last).alias("passes")).collect()
        assert all(x.passes for x in rows if x.wanted) and sum(bool(x.wanted) for x in rows) > 50
        assert any(not x.passes for x in rows)
