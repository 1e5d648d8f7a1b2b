"""A failed run of the work order details is no result."""

import pytest
from pyspark.sql import functions as F

import star_queries as SQ
from fleetlake.plans import delivery as DL
from fleetlake.plans import orders as OR
from fleetlake.sources.star import star_tables

SF = "/root/testdata/sf0.001"


def broken(t):
    return {**t, "afvc": t["afvc"].withColumn("aufpl", F.raise_error(F.lit("table not readable")).cast("string"))}


def test_manifest_names_failed_details(spark):
    t = star_tables(spark, SF, SQ._MAN_VIEWS)
    got = {r["job"]: r for r in DL.hourly_manifest(spark, broken(t), SQ.STAR).collect()}
    operations, rows = got["work_order_operations"], got["work_orders"]
    assert (operations["status"], operations["rows"]) == ("error", None) and "table not readable" in operations["error"]
    # the orders go out without header fields (BF-4), but not as if nothing had happened
    assert rows["status"] == "partial" and "table not readable" in rows["error"]
    assert rows["rows"] == OR.work_orders_latest(t, SQ.STAR).count() > 0
    assert {r["status"] for j, r in got.items() if not j.startswith("work_order")} == {"ok"}
    lacking = {k: v for k, v in t.items() if k != "afvc"}
    noted = {r["job"]: r["error"] for r in DL.hourly_manifest(spark, lacking, SQ.STAR).collect()}
    assert "missing sources: afvc" in noted["work_orders"] and "missing sources: afvc" in noted["work_order_operations"]


def test_document_fails_with_its_details(spark):
    t = star_tables(spark, SF, SQ._REG["work_order_document"][0])
    with pytest.raises(OR.DetailsFailed, match="table not readable"):
        SQ._orders_and_operations(broken(t), SQ.STAR)


def test_fallback_is_asked_for(spark):
    block = OR.WorkOrderBlock(broken(star_tables(spark, SF, SQ._MAN_VIEWS)), SQ.STAR)
    for list_ in (block.rows, block.operations):
        with pytest.raises(OR.DetailsFailed, match="table not readable"):
            list_()
    assert block.operations(fallback=True).count() == 0 and block.rows(fallback=True).count() > 0
    assert "table not readable" in block.error
