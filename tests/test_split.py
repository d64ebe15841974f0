"""Feature-split stream = one-state-per-model vector stream on the same lines."""

from functools import partial

import pytest
from pyspark.sql import functions as F

from tidewatch.operators.detectors import make_detector
from tidewatch.operators.vector import vector_factory
from tidewatch.plans import inputs as I
from tidewatch.session import scratch_path
from tidewatch.sources.loglines import request_log_lines
from tidewatch.streaming import job
from tidewatch.streaming.sinks import read_final_states
from tidewatch.streaming.split import start_split

SF = "/root/testdata/sf0.001"
PH = ("PAGE_HINKLEY", dict(min_n=30, delta=0.005, lam=20.0, alpha=0.9999))


def _states(spark, out):
    return {(r.model_id, r.batch_id): (r.warning_detected, r.change_detected, r.drift_probability, r.axon,
                                       r.n_requests) for r in read_final_states(spark, out).collect()}


@pytest.mark.parametrize("combine,thr", [("any", 0.5), ("majority", 0.3), ("logistic", 0.3)])
def test_split_equals_vector_state(spark, combine, thr):
    root = scratch_path(spark, "t-split")
    lines = request_log_lines(I.events(spark, SF), keep_ids=True)
    days = sorted(r.d for r in lines.selectExpr("date_format(ts, 'yyyyMMdd') AS d").distinct().collect())
    lines = lines.selectExpr("value", "date_format(ts, 'yyyyMMdd') AS day")
    for d in days:                  # 4 days per micro-batch: the model state crosses micro-batches
        lines.filter(lines.day == d).select("value").coalesce(1).write.text(f"{root}/landing/day={d}")
    q = start_split(spark, f"{root}/landing", f"{root}/split", f"{root}/ck1", partial(make_detector, *PH[:1], **PH[1]),
                    combine, thr, signal=I.vector_signal, max_files_per_trigger=4)
    q.awaitTermination()
    assert q.exception() is None
    q2 = job.start(spark, f"{root}/landing", f"{root}/vec", f"{root}/ck2",
                   detector=vector_factory(*PH, combine=combine, threshold=thr), max_files_per_trigger=4)
    q2.awaitTermination()
    got, exp = _states(spark, f"{root}/split"), _states(spark, f"{root}/vec")
    assert got == exp and len(got) > 0
    assert any(v[1] for v in got.values())          # the planted drift is found


def test_empty_requests_spend_the_warm_up(spark):
    """A first day of empty requests is the warm-up batch in both streams; the next day's change is reported."""
    root = scratch_path(spark, "t-split-empty")
    lines = request_log_lines(I.events(spark, SF), keep_ids=True)
    days = sorted(r.d for r in lines.selectExpr("date_format(ts, 'yyyyMMdd') AS d").distinct().collect())[:4]
    lines = lines.selectExpr("value", "date_format(ts, 'yyyyMMdd') AS day")
    emptied = F.regexp_replace("value", r"ndarray([^\[]*)\[\[[^\]]*\]\]", "ndarray$1[]")
    for d in days:
        value = emptied if d == days[0] else F.col("value")
        lines.filter(lines.day == d).select(value.alias("value")).coalesce(1).write.text(f"{root}/landing/day={d}")
    eager = ("PAGE_HINKLEY", dict(min_n=2, delta=0.0, lam=0.01, alpha=1.0))
    q = start_split(spark, f"{root}/landing", f"{root}/split", f"{root}/ck1", partial(make_detector, eager[0], **eager[1]),
                    "any", signal=I.vector_signal, max_files_per_trigger=1)
    q.awaitTermination()
    assert q.exception() is None
    q2 = job.start(spark, f"{root}/landing", f"{root}/vec", f"{root}/ck2",
                   detector=vector_factory(*eager, combine="any"), max_files_per_trigger=1)
    q2.awaitTermination()
    got, exp = _states(spark, f"{root}/split"), _states(spark, f"{root}/vec")
    first, second = sorted({b for _, b in got})[:2]
    assert got == exp
    assert all(v[2] == 0.0 and v[4] > 0 for (_, b), v in got.items() if b == first)
    assert any(v[1] for (_, b), v in got.items() if b == second)
