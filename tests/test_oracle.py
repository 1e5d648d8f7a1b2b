"""Every registered query against its DuckDB oracle at sf0.001 (the driver does sf0.01)."""

import duckdb
import pytest

import __spark_entry__
import star_queries as E
from compare import digest
from fleetlake.sources.star import BASE_TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in BASE_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    srows, scols = [tuple(r) for r in df.collect()], df.columns
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(srows, scols) == digest(drows, dcols)


TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
         "boolean": "BOOLEAN", "double": "DOUBLE"}


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_types_match_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rel = con.sql(E.oracle_sql()[name])
    duck = {c: str(t).upper().replace(" ", "") for c, t in zip(rel.columns, rel.types)}
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        want = t.upper().replace(" ", "") if t.startswith("decimal") else TYPES.get(t, t.upper())
        assert duck[f.name] == want, (name, f.name)


def test_every_query_has_an_oracle():
    assert set(E.queries()) == set(E.oracle_sql())


def test_entry_smoke(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns[0] == "ativo" and df.count() >= 0
