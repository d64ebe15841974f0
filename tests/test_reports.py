"""State-table reports and maintenance."""

import datetime as dt

from tidewatch.plans import reports as R
from tidewatch.session import scratch_path

ROWS = [("a", "ax-0", 0.0, dt.datetime(2024, 1, 1, 0, 0)), ("a", "ax-0", 0.9, dt.datetime(2024, 1, 1, 0, 30)),
        ("b", "ax-1", 0.8, dt.datetime(2024, 1, 1, 0, 5)), ("b", "ax-1", 0.0, dt.datetime(2024, 1, 1, 0, 55))]
SCHEMA = "model_id string, axon string, drift_probability double, timestamp timestamp_ntz"


def test_reports(spark):
    t = spark.createDataFrame(ROWS, SCHEMA)
    assert [r.timestamp.minute for r in R.recent_first(t).collect()] == [55, 30, 5, 0]
    assert {(r.model_id, r.drift_probability) for r in R.latest_per_model(t).collect()} == {("a", 0.9), ("b", 0.0)}
    assert R.row_count(t).first().n == 4
    kept = R.drop_axon_older_than(t, "ax-0", "2024-01-01 00:35:00", minutes=10)
    assert sorted(r.timestamp.minute for r in kept.collect()) == [5, 30, 55]
    assert R.expire(t, "2024-01-01 01:00:00", 1800).count() == 2


def test_rewrite_applies_delete(spark):
    t = spark.createDataFrame(ROWS, SCHEMA)
    dst = scratch_path(spark, "t-rewrite")
    out = R.rewrite(spark, R.drop_axon_older_than(t, "ax-1", "2024-01-01 01:00:00", minutes=10), dst, "axon")
    assert out.count() == 3


def test_metric_push_grouping(spark):
    from pyspark.sql import Row

    from tidewatch.streaming.push import group_lines
    rows = [Row(url="http://g/metrics/job/a/pod/", line="m_ax__1 0.9\n"),
            Row(url="http://g/metrics/job/b/pod/", line="m_ax__2 0.0\n"),
            Row(url="http://g/metrics/job/a/pod/", line="m_ax__0 0.8\n")]
    assert group_lines(rows) == {"http://g/metrics/job/a/pod/": "m_ax__1 0.9\nm_ax__0 0.8\n",
                                 "http://g/metrics/job/b/pod/": "m_ax__2 0.0\n"}
    assert group_lines([("u", "x 1\n")]) == {"u": "x 1\n"}
