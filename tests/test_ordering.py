"""Chunk-parallel row numbers and prefix scans equal plain per-key windows."""

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidewatch.operators.ordering import running

rows_st = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 5), st.integers(0, 10 ** 6),
                             st.one_of(st.none(), st.floats(-100, 100, allow_nan=False))),
                   min_size=1, max_size=60, unique_by=lambda r: r[2])


def expected(rows):
    out = {}
    for key in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))
        s, mn, mx, low = 0.0, math.inf, -math.inf, math.inf
        for i, (k, c, o, x) in enumerate(mine, 1):
            if x is not None:
                s += x
                mn, mx, low = min(mn, x), max(mx, x), min(low, s)
            out[(k, o)] = (i, s, None if mn == math.inf else mn, None if mx == -math.inf else mx, low)
    return out


@pytest.fixture
def chunks(spark):
    """A chunk for each few rows."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")


@settings(max_examples=10, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows_st)
def test_chunked_scans(chunks, rows):
    df = chunks.createDataFrame(rows, "k string, c long, o long, x double")
    d = running(df, "k", ["c", "o"], count="rn", sums={"sx": "x"}, mins={"mn": "x"}, maxs={"mx": "x"}, min_of_sum={"low": "sx"})
    got = {(r.k, r.o): (r.rn, r.sx, r.mn, r.mx, r.low) for r in d.collect()}
    exp = expected(rows)
    assert got.keys() == exp.keys()
    for key, (rn, sx, mn, mx, low) in exp.items():
        g = got[key]
        assert g[0] == rn and g[2] == mn and g[3] == mx
        seen = mn is not None
        assert (g[1] is None) == (not seen)
        assert (g[4] is None) == (not seen)
        assert not seen or abs(g[1] - sx) < 1e-9 and abs(g[4] - low) < 1e-9


def test_one_hour_with_all_rows_is_dealt_evenly(chunks):
    """One key and one time hold all rows: chunks of about equal size, values over all of them; structs compare by field."""
    rows = [("a", 7, i, float((i * 37) % 101)) for i in range(5000)] + [("b", 7, 1, 1.0)]
    df = chunks.createDataFrame(rows, "k string, hour long, o long, x double")
    d = running(df.selectExpr("*", "struct(x, -o AS i) AS t"), "k", ["hour", "o"], count="rn", sums={"sx": "x"}, mins={"low": "t"})
    got = {r.rn: (r.sx, tuple(r.low), r.pid) for r in d.selectExpr("*", "spark_partition_id() AS pid").where("k = 'a'").collect()}
    total, low = 0.0, (math.inf, 0)
    for i in range(5000):
        total, low = total + rows[i][3], min(low, (rows[i][3], -i))
        assert got[i + 1][:2] == (total, low)
    sizes = [list(v[2] for v in got.values()).count(p) for p in {v[2] for v in got.values()}]
    assert len(sizes) >= 4 and max(sizes) < 2 * 5000 / len(sizes)
