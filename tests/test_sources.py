import datetime as dt

import pytest
from pyspark.sql import functions as F

import star_queries as SQ
from fleetlake.sources.star import star_tables
from fleetlake.sources.tables import jdbc_date_predicates, load_tables, missing, write_by_month

SF = "/root/testdata/sf0.001"


def test_load_parquet_and_optional(spark):
    t = load_tables(spark, {
        "orders": {"format": "parquet", "path": f"{SF}/orders.parquet"},
        "orders_again": {"same_as": "orders"},
        "nope": {"format": "parquet", "path": f"{SF}/does_not_exist.parquet", "optional": True},
    })
    assert set(t) == {"orders", "orders_again"}
    assert t["orders"].columns == [c.lower() for c in t["orders"].columns]
    assert missing(t, ["orders", "nope"]) == ["nope"]
    with pytest.raises(Exception, match="does_not_exist"):
        load_tables(spark, {"nope": {"path": f"{SF}/does_not_exist.parquet"}})


def test_jdbc_date_predicates_disjoint_cover():
    preds = jdbc_date_predicates("BADAT", 30, 14, dt.date(2024, 3, 1))
    assert preds == ["BADAT >= '20240131' AND BADAT < '20240214'",
                     "BADAT >= '20240214' AND BADAT < '20240228'",
                     "BADAT >= '20240228' AND BADAT <= '20240301'"]


def months_read(df):
    return {r[0].split("mes=")[1][:6] for r in df.select(F.input_file_name()).distinct().collect()}


def test_range_of_days_prunes_months(spark, tmp_path):
    ekko = star_tables(spark, SF, ["ekko"])["ekko"]
    odd = ekko.limit(3).withColumn("bedat", F.lit("no date"))
    write_by_month(ekko.unionByName(odd), str(tmp_path / "ekko"), "bedat")
    spec = {"ekko": {"path": str(tmp_path / "ekko"), "dates": {"column": "bedat", "month": "mes", "total_days": 90, "as_of": "1998-03-15"}}}
    df = load_tables(spark, spec)["ekko"]
    assert df.columns == ekko.columns
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(mes" in plan and ">= 199712" in plan and "<= 199803" in plan
    months = months_read(df)
    assert months <= {"199712", "199801", "199802", "199803"} and len(months) == 4
    first, last = dt.date(1997, 12, 15), dt.date(1998, 3, 15)
    day = SQ.FD.sap_date(F.col("bedat"))
    assert sorted(map(repr, df.collect())) == sorted(map(repr, ekko.where(day.between(F.lit(first), F.lit(last))).collect()))


def test_spec_of_the_history_reads_only_its_months(spark):
    t = star_tables(spark, SF, SQ.PH_VIEWS_J2)
    spec = SQ.lake_spec(t, SQ.P_LAKE)
    loaded = load_tables(spark, spec)
    assert missing(loaded, spec) == ["hourmeter", "hourmeter_invalid"]
    assert len(months_read(loaded["ekko"])) == 14  # of 80
