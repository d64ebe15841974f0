"""Vector detectors: per-feature detectors combined per request."""

import numpy as np
from pyspark.sql import functions as F

from tidewatch.functions.vectors import explode_vectors
from tidewatch.operators import detectors as D
from tidewatch.operators.fold import alarms_by, fold_alarms
from tidewatch.operators.keyed import fold_batch_states
from tidewatch.operators.state import batch_grid, latch
from tidewatch.operators.vector import VectorDetector, vector_factory
from tidewatch.plans import inputs as I
from tidewatch.session import scratch_path
from tidewatch.sources.loglines import request_log_lines
from tidewatch.streaming import job
from tidewatch.streaming.sinks import read_final_states

PH = ("PAGE_HINKLEY", dict(min_n=30, delta=0.005, lam=20.0, alpha=0.9999))
SF = "/root/testdata/sf0.001"


def test_any_is_or_of_features_and_state_round_trips():
    rng = np.random.default_rng(11)
    rows = np.concatenate([rng.normal(0, 1, (150, 4)), rng.normal(0, 1, (150, 4)) + [0, 5, 0, 0]])
    v = VectorDetector(lambda: D.make_detector(*PH[:1], **PH[1]), "any")
    singles = [D.make_detector(PH[0], **PH[1]) for _ in range(4)]
    b = VectorDetector(lambda: D.make_detector(*PH[:1], **PH[1]), "any")
    for k, r in enumerate(rows):
        got = v.step(r)
        v.end_request()
        flags = [d.step(float(e)) for d, e in zip(singles, r)]
        assert got == (any(f[0] for f in flags), any(f[1] for f in flags))
        if k % 29 == 0:
            c = VectorDetector(lambda: D.make_detector(*PH[:1], **PH[1]), "any")
            c.load(b.dump())
            b = c
        assert b.step(r) == got
        b.end_request()


def test_majority_and_logistic_votes():
    v = VectorDetector(lambda: D.make_detector("CUSUM", min_n=1, delta=0.0, lam=1.0), "majority", 0.5)
    assert v.step([0.0, 0.0, 0.0]) == (False, False)
    v.end_request()
    assert v.step([10.0, 10.0, 0.0]) == (True, True)      # 2 of 3 features changed
    v.end_request()
    g = VectorDetector(lambda: D.make_detector("CUSUM", min_n=1, delta=0.0, lam=1.0), "logistic", 0.3)
    g.step([0.0, 0.0])
    g.end_request()
    assert g.step([10.0, 0.0]) == (True, True)           # vote 0.993 / 2 > 0.3
    for _ in range(8):
        g.end_request()
        out = g.step([0.0, 0.0])
    assert out == (False, False)                         # the vote decayed


def _table_vector(spark):
    reqs = I.requests(spark, SF)
    st = fold_batch_states(I.with_vector_inputs(reqs), vector_factory(*PH, combine="any"))
    return {(r.model_id, r.batch_id): (r.warning_detected, r.change_detected, r.drift_probability) for r in st.collect()}


def test_vector_state_equals_per_feature_plan(spark):
    reqs = I.requests(spark, SF)
    long = explode_vectors(reqs, ["model_id", "insert_id", "ts", "batch_id"])
    long = long.withColumn("x", I.vector_signal(F.col("x"), F.col("feature_idx"), F.col("ts")))
    al = fold_alarms(long, ["model_id", "feature_idx"], ["ts", "insert_id", "row_idx"], "x",
                     vector_factory(*PH, combine="any").args[0], req="insert_id", carry=["batch_id"])
    grid = batch_grid(reqs, "model_id", "batch_id")
    st = latch(grid, alarms_by(al, ["model_id", "batch_id"]))
    setwise = {(r.model_id, r.batch_id): (r.warning_detected, r.change_detected, r.drift_probability)
               for r in st.collect()}
    table = _table_vector(spark)
    assert table == setwise
    assert any(v[1] for v in table.values())


def test_vector_stream_equals_table(spark):
    root = scratch_path(spark, "t-vector")
    job.write_landing(request_log_lines(I.events(spark, SF), keep_ids=True), f"{root}/landing")
    q = job.start(spark, f"{root}/landing", f"{root}/out", f"{root}/ckpt",
                  detector=vector_factory(*PH, combine="any"))
    q.awaitTermination()
    assert q.exception() is None
    got = {(r.model_id, r.batch_id): (r.warning_detected, r.change_detected, r.drift_probability)
           for r in read_final_states(spark, f"{root}/out").collect()}
    assert got == _table_vector(spark)
