"""Operators: dedup against a Python model, batches and merge."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetlake.operators.batches import row_index, to_batches
from fleetlake.operators.dedup import first_per_key, latest_per_key
from fleetlake.plans.yard import merge_feeds

rows_st = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.one_of(st.none(), st.integers(0, 5)),
                             st.integers(0, 1000)), min_size=0, max_size=40, unique_by=lambda r: r[2])


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_st, parts=st.sampled_from([1, 3, 7]))
def test_first_per_key_matches_model(spark, rows, parts):
    df = spark.createDataFrame(rows, "k string, v int, id int").repartition(parts)
    got = sorted(tuple(r) for r in first_per_key(df, "k", [F.col("v").desc_nulls_first()],
                                                 [F.col("id").asc()]).collect())
    best = {}
    for k, v, i in rows:
        key = (0 if v is None else 1, -(v or 0), i)  # DESC NULLS FIRST, then id
        if k not in best or key < best[k][0]:
            best[k] = (key, (k, v, i))
    assert got == sorted(b for _, b in best.values())


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_st)
def test_latest_ties_all_equals_self_join(spark, rows):
    df = spark.createDataFrame(rows, "k string, v int, id int")
    got = sorted(tuple(r) for r in latest_per_key(df, "k", "v", ties="all").collect())
    mx = {}
    for k, v, _ in rows:
        if v is not None:
            mx[k] = max(mx.get(k, v), v)
    assert got == sorted(r for r in rows if r[1] is not None and mx.get(r[0]) == r[1])


def test_row_index_gapless(spark):
    for parts in (1, 4, 50):
        df = spark.range(0, 1234).select((F.col("id") * 7 % 1234).alias("x"))
        idx = row_index(df, ["x"], num_partitions=parts)
        got = sorted((r["x"], r["row_idx"]) for r in idx.collect())
        assert got == [(i, i) for i in range(1234)]


def _check_batches(b, n, size, tail):
    rows = sorted((r["batch_index"], r["is_last"], r["n_rows"], [x["x"] for x in r["rows"]]) for r in b.collect())
    flat = [x for _, _, _, xs in rows for x in xs]
    assert flat == list(range(n))  # each row once, in order
    idxs = [r[0] for r in rows]
    assert idxs == list(range(len(rows)))
    if tail == "trailer":
        assert rows[-1][1] is True and rows[-1][2] == 0 and not any(r[1] for r in rows[:-1])
        body = rows[:-1]
    else:
        assert [r[1] for r in rows] == [False] * (len(rows) - 1) + [True]
        body = rows
    assert all(r[2] == size for r in body[:-1]) if body else True
    if tail == "final":
        assert rows[-1][2] == n % size
    return rows


def test_batches_sizes_and_tails(spark):
    size = 5
    for n in (0, 1, size - 1, size, size + 1, 2 * size):
        for tail in ("none", "final", "trailer"):
            df = spark.range(0, n).select(F.col("id").alias("x"))
            rows = _check_batches(to_batches(df, size, ["x"], tail=tail, num_partitions=3), n, size, tail)
            if tail == "none":
                assert len(rows) == max(1, -(-n // size))


def test_merge_feeds(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    valid = spark.createDataFrame([("A1", t1, 1), ("A1", t1, 2), ("B1", t2, 3)],
                                  "asset_no string, data timestamp_ntz, h int")
    rej = spark.createDataFrame([("a1 ", t1, "E1"), ("A1", t2, "E2"), ("C1", t1, "E3")],
                                "asset_no string, em timestamp_ntz, motivo string")
    got = sorted((r["asset_no"], r["h"], r["motivo"]) for r in merge_feeds(
        valid, rej, ["asset_no", "data", "h"], ["em", "motivo"]).collect())
    # A1: only the last valid row (h=2) gets the last rejected row (E2); C1 appended
    assert got == [("A1", 1, None), ("A1", 2, "E2"), ("B1", 3, None), ("C1", None, "E3")]
