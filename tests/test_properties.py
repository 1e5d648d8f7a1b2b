"""Property tests of key functions against Python models."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetlake.functions import keys as K

keys_st = st.lists(st.one_of(st.none(), st.text(alphabet=" 0123A\t", max_size=8)), min_size=1, max_size=30)
SETTINGS = dict(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@settings(**SETTINGS)
@given(vals=keys_st)
def test_strip_key_model(spark, vals):
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    got = [tuple(r) for r in df.select(K.strip_key("x"), K.strip_zeros("x"), K.py_strip("x")).collect()]
    want = [(None, None, None) if v is None else (v.strip(" ").lstrip("0"), v.lstrip("0"), v.strip())
            for v in vals]
    assert got == want


@settings(**SETTINGS)
@given(vals=st.lists(st.one_of(st.none(), st.text(max_size=6)), min_size=1, max_size=30))
def test_desc_text_key_model(spark, vals):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, x string")
    got = [r["x"] for r in df.orderBy(K.desc_text_key(F.col("x")), "i").collect()]
    # descending by UTF-8 bytes with NULLs first, as Spark orders strings
    want = sorted(vals, key=lambda v: (v is not None, [] if v is None else [-b for b in v.encode()] + [1]))
    assert got == want
