"""Physical plan checks over every registered query (sf0.001)."""

import pytest

import star_queries as E
from fleetlake.params import Params
from fleetlake.plans import orders, parts, purchasing, reservations, yard
from fleetlake.sources.star import BASE_TABLES, VIEWS, load_base, star_tables

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in E.queries() if n not in ("run_manifest",)))
def test_no_python_udf_no_cross_join(spark, name):
    plan = plan_of(E.queries()[name](spark, SF))
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad}"


@pytest.mark.parametrize("name", ["yard_entries", "hourmeter_latest", "po_approval", "goods_receipt_status",
                                  "purchase_history", "requisition_flow", "work_orders_latest", "order_supplies"])
def test_top1_windows_are_limited_before_shuffle(spark, name):
    # first/latest per key: a partial WindowGroupLimit cuts each key to its top rows map-side
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(E.queries()[name](spark, SF))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "WindowGroupLimit" in plan and "Partial" in plan, name


def test_scan_prunes_columns(spark):
    df = E.queries()["po_payment"](spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    # orders is read for key, customer, priority and status only
    assert "o_totalprice" not in plan


@pytest.mark.parametrize("name", sorted(n for n in E.queries() if n not in ("run_manifest",)))
def test_no_single_partition_stage(spark, name):
    """A single-partition exchange may carry only partial aggregates or the per-partition offset table of the
    batch index (one row per partition), never rows of a job."""
    df = E.queries()[name](spark, SF)
    df.write.format("noop").mode("overwrite").save()
    lines = plan_of(df).splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = next(x for x in lines[i + 1:] if "WholeStageCodegen" not in x and "Project" not in x and "InputAdapter" not in x)
            assert "Aggregate(" in below and ("partial_" in below or "__pid" in below), (name, below)


@pytest.mark.parametrize("name", ["requisition_flow", "external_work_orders", "order_supplies", "hourmeter_merged",
                                  "picking_reservations"])
def test_result_independent_of_partitioning(spark, name):
    out = []
    for n in (1, 7):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        df = E.queries()[name](spark, SF)
        out.append(sorted(repr(tuple(r)) for r in df.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert out[0] == out[1]


def test_job_filter_reaches_parquet_scan(spark):
    # the yard history's "report time is not NULL" is pushed through the view into the scan
    plan = plan_of(E.queries()["yard_events"](spark, SF))
    assert "PushedFilters: [IsNotNull(o_orderdate)]" in plan


DATED = {
    "purchase_history": (purchasing.purchase_history, "bedat", True), "requisition_flow": (purchasing.requisition_flow, "badat", True),
    "external_work_orders": (orders.external_work_orders_flat, "erdat", False),
    "work_orders_latest": (orders.work_orders_latest, "data_criacao", False),
    "work_order_operations": (orders.work_order_operations, "erdat", False),
    "order_supplies": (orders.order_supplies, "data_criacao", False), "parts_history": (parts.parts_history, "erdat", True),
}


@pytest.mark.parametrize("name", sorted(DATED))
def test_date_filter_reaches_source_scan(spark, tmp_path, name):
    # on source-shaped parquet the bounds of the job's date are in the scan, and the rows are the same
    fn, column, both = DATED[name]
    views = E._REG[name][0]
    tables = star_tables(spark, SF, views)
    stored = {}
    for v, df in tables.items():
        df.write.parquet(f"{tmp_path}/{v}")
        stored[v] = spark.read.parquet(f"{tmp_path}/{v}")
    df = fn(stored, E.STAR)
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    pushed = [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "PushedFilters" in line]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert any(f"GreaterThanOrEqual({column}," in p and (not both or f"LessThan({column}," in p) for p in pushed), pushed
    assert sorted(map(repr, df.collect())) == sorted(map(repr, fn(tables, E.STAR).collect()))


def test_adapter_views_keep_every_base_row(spark):
    base = load_base(spark, SF)
    counts = {n: df.count() for n, df in base.items()}
    one_to_one = {"ekko": "orders", "ekbe": "lineitem", "eket": "lineitem", "lips": "lineitem", "mseg": "lineitem",
                  "approvals": "events", "receipts": "orders", "requisitions": "customer", "resb": "lineitem",
                  "rkpf": "orders", "rsadd": "lineitem", "aqua": "lineitem", "pm_order_view": "orders",
                  "fi_ativos": "customer", "lfa1": "customer", "mara": "part"}
    for view, table in one_to_one.items():
        assert star_tables(spark, SF, [view])[view].count() == counts[table], view
    both = star_tables(spark, SF, ["hourmeter", "hourmeter_invalid"])
    assert sum(df.count() for df in both.values()) == counts["lineitem"]
    assert set(BASE_TABLES) == set(counts) and set(one_to_one) < set(VIEWS)


def test_jobs_refuse_missing_parameters(spark):
    def tables(names):
        return star_tables(spark, SF, names)
    for job, names in ((purchasing.requisition_flow, E.RC_VIEWS), (purchasing.po_payment, ["ekko", "ekpo", "ekbe"]),
                       (orders.work_orders_latest, ["pm_order_view"]), (orders.external_work_orders, E.EWO_VIEWS),
                       (yard.yard_entries, ["uca_yard"]), (yard.yard_events, ["uca_yard"]),
                       (reservations.picking_reservations, E.RS_VIEWS)):
        with pytest.raises(ValueError, match="not set"):
            job(tables(names), Params())


def test_null_order_headers_are_spread(spark):
    # nine headers in ten have no order: no shuffle partition holds much more than its share of them
    from pyspark.sql import functions as F

    from fleetlake.operators.lookups import salted_join, spread_nulls, with_salt
    rows = spark.range(20_000).select(F.col("id").cast("string").alias("rsnum"),
                                      F.when(F.col("id") % 10 == 0, F.col("id").cast("string")).alias("aufnr"))
    keyed = with_salt(rows, ["rsnum"]).select(spread_nulls("aufnr").alias("k"))
    spread = keyed.repartition(16, "k").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in spread) < 3 * 20_000 / 16
    orders_ = spark.range(0, 20_000, 10).select(F.col("id").cast("string").alias("o"))
    out = salted_join(rows, orders_, F.col("aufnr"), F.col("o"), [""])
    assert out.count() == 20_000 and out.where("o IS NOT NULL").count() == 2_000
