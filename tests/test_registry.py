"""Detector configuration in the job vocabulary, and every detector in the keyed fold."""

import sys

import numpy as np
import pytest

from tidewatch.operators.blocks import block_alarms
from tidewatch.operators.fold import fold_alarms
from tidewatch.operators.keyed import KeyState, fold_batch_states
from tidewatch.operators.kl import KlKmeansRows, kl_cells
from tidewatch.plans import inputs as I
from tidewatch.plans.queries import BLOCK_QUERIES, KEY, ORDER
from tidewatch.registry import UNIVARIATE_NAMES, detector_from_conf
from tidewatch.session import scratch_path
from tidewatch.sources.loglines import request_log_lines
from tidewatch.streaming import job
from tidewatch.streaming.sinks import read_final_states

BIG = sys.maxsize
# The option table of the reference's mean-shift test.
TEST_OPTIONS = {
    "CUSUM": {"minNumInstancesOption": {"type": "IntOption", "value": 300, "min": 0, "max": BIG},
              "deltaOption": {"type": "FloatOption", "value": 0.005, "min": 0.0, "max": 1.0},
              "lambdaOption": {"type": "FloatOption", "value": 50.0, "min": 0.0, "max": sys.float_info.max}},
    "ADWIN": {"deltaAdwinOption": {"type": "FloatOption", "value": 0.002, "min": 0.0, "max": 1.0}},
    "DDM": {"minNumInstancesOption": {"type": "IntOption", "value": 30, "min": 0, "max": BIG},
            "warningLevelOption": {"type": "FloatOption", "value": 2.0, "min": 1.0, "max": 4.0},
            "outcontrolLevelOption": {"type": "FloatOption", "value": 3.0, "min": 1.0, "max": 5.0}},
    "EWMA": {"minNumInstancesOption": {"type": "IntOption", "value": 30, "min": 0, "max": BIG},
             "lambdaOption": {"type": "FloatOption", "value": 0.2, "min": 0.0, "max": sys.float_info.max}},
    "GEOMETRIC_MOVING_AVERAGE": {
        "minNumInstancesOption": {"type": "IntOption", "value": 30, "min": 0, "max": BIG},
        "lambdaOption": {"type": "FloatOption", "value": 1.0, "min": 0.0, "max": sys.float_info.max},
        "alphaOption": {"type": "FloatOption", "value": 0.99, "min": 0.0, "max": 1.0}},
    "EDDM": {},
    "PAGE_HINKLEY": {"minNumInstancesOption": {"type": "IntOption", "value": 30, "min": 0, "max": BIG},
                     "deltaOption": {"type": "FloatOption", "value": 0.005, "min": 0.0, "max": 1.0},
                     "lambdaOption": {"type": "FloatOption", "value": 50.0, "min": 0.0, "max": sys.float_info.max},
                     "alphaOption": {"type": "FloatOption", "value": 1 - 0.0001, "min": 0.0, "max": 1.0}},
    "HDDM_A": {"driftConfidenceOption": {"type": "FloatOption", "value": 0.001, "min": 0.0, "max": 1.0},
               "warningConfidenceOption": {"type": "FloatOption", "value": 0.005, "min": 0.0, "max": 1.0},
               "oneSidedTestOption": {"type": "MultiChoiceOption", "value": 1, "options": [0, 1]}},
    "HDDM_W": {"driftConfidenceOption": {"type": "FloatOption", "value": 0.001, "min": 0.0, "max": 1.0},
               "warningConfidenceOption": {"type": "FloatOption", "value": 0.005, "min": 0.0, "max": 1.0},
               "lambdaOption": {"type": "FloatOption", "value": 0.05, "min": 0.0, "max": 1.0},
               "oneSidedTestOption": {"type": "MultiChoiceOption", "value": 0, "options": [0, 1]}},
    "SEED": {"deltaSEEDOption": {"type": "FloatOption", "value": 0.05, "min": 0.0, "max": 1.0},
             "blockSizeSEEDOption": {"type": "IntOption", "value": 32, "min": 32, "max": 256},
             "epsilonPrimeSEEDOption": {"type": "FloatOption", "value": 0.01, "min": 0.0025, "max": 0.01},
             "alphaSEEDOption": {"type": "FloatOption", "value": 0.8, "min": 0.2, "max": 0.8},
             "compressTermSEEDOption": {"type": "IntOption", "value": 75, "min": 50, "max": 100}},
    "SEQ1": {"deltaOption": {"type": "FloatOption", "value": 0.01, "min": 0.0, "max": 1.0},
             "deltaWarningOption": {"type": "FloatOption", "value": 0.1, "min": 0.0, "max": 1.0},
             "blockSeqDriftOption": {"type": "IntOption", "value": 200, "min": 100, "max": 10000}},
}


def conf(uni, kind="MOA_SUBSAMPLE_SIMPLE_MAJORITY", threshold=0.01):
    return {"drift_detector_type": kind, "univariate_detector_type": uni,
            "univariate_detector_options": TEST_OPTIONS[uni], "threshold": threshold}


@pytest.fixture(scope="module")
def batches():
    """20 batches of 10 rows x 100 features; half the features move by 100 from row 100."""
    rng = np.random.default_rng(42)
    shift = (rng.random(100) < 0.5) * 100.0
    data = np.concatenate([rng.normal(0, 1, (100, 100)), rng.normal(0, 1, (100, 100)) + shift])
    return np.array_split(data, 20)


def run_batches(factory, batches):
    """Latched (warning, change) per batch, one single-row request per row."""
    st = KeyState(factory)
    out = []
    for b, rows in enumerate(batches):
        w_b = c_b = False
        for r in rows:
            w, c = st.request([r])
            w_b, c_b = w_b or w, c_b or c
        out.append(st.close_batch(b, w_b, c_b)[:2])
    return out


@pytest.mark.parametrize("uni", UNIVARIATE_NAMES)
def test_mean_shift_ensemble(batches, uni):
    factory, vector = detector_from_conf(conf(uni))
    assert vector
    flags = run_batches(factory, batches)
    changed = [i for i, (_, c) in enumerate(flags) if c]
    if uni in ("CUSUM", "SEQ1"):          # 200 rows: too short for min_n 300 / one block of 200
        assert changed == []
    if uni == "PAGE_HINKLEY":
        assert changed[:1] == [10]
    if uni == "ADWIN":
        assert changed[:1] == [12]        # first check after the shift is row 127
    assert all(w == c for w, c in flags)  # the ensemble's warning answers its change flag


def test_bad_configurations():
    with pytest.raises(ValueError):
        detector_from_conf({"drift_detector_type": "OTHER_X"})
    with pytest.raises(ValueError):
        detector_from_conf({"drift_detector_type": "MOA_NOPE"})
    with pytest.raises(ValueError):
        detector_from_conf({**conf("CUSUM"), "univariate_detector_type": "RDDM"})
    with pytest.raises(ValueError):
        detector_from_conf({k: v for k, v in conf("CUSUM").items() if k != "threshold"})
    bad = {**conf("DDM")}
    bad["univariate_detector_options"] = {"warningLevelOption": {"type": "FloatOption", "value": 9.0,
                                                                 "min": 1.0, "max": 4.0}}
    with pytest.raises(ValueError):
        detector_from_conf(bad)
    with pytest.raises(ValueError):
        detector_from_conf({**conf("CUSUM"), "univariate_detector_options": {"noSuchOption": {"value": 1}}})
    for kind in ("MOA_KL", "MOA_SPLL2", "SKMULTIFLOW_EDDM", "SKMULTIFLOW_PageHinkley", "SKMULTIFLOW_DDM",
                 "SKMULTIFLOW_ADWIN"):
        f, vector = detector_from_conf({"drift_detector_type": kind})
        assert vector and f() is not None


@pytest.mark.parametrize("name", ["det_seed", "det_seqdrift1"])
def test_block_detectors_row_wise_equal_block_plan(spark, name):
    from functools import partial

    from tidewatch.operators.detectors import make_detector
    det, signal, opts = BLOCK_QUERIES[name]
    sig = I.signals(spark, "/root/testdata/sf0.01")
    blocks = {(r.model_id, r.rn, r.change) for r in block_alarms(sig, KEY, ORDER, signal, det, **opts).collect()}
    rows = {(r.model_id, r.rn, r.change) for r in fold_alarms(sig, [KEY], ORDER, signal,
                                                               partial(make_detector, det, **opts)).collect()}
    assert rows == blocks and blocks


def test_streaming_kl_equals_window_plan(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(0, 1, (60, 3)), rng.normal(2, 1, (60, 3))])
    det = KlKmeansRows(10, 5)
    got = [i for i, r in enumerate(x) if det.step(r)[1]]
    exp = [10 * g + 9 for g in range(1, 12) if kl_cells(x[10 * (g - 1):10 * g], x[10 * g:10 * (g + 1)], 5, 10)[1]]
    assert got == exp and got
    d2 = KlKmeansRows(10, 5)
    for r in x[:35]:
        d2.step(r)
    d3 = KlKmeansRows(10, 5)
    d3.load(d2.dump())
    assert [d3.step(r) for r in x[35:]] == [d2.step(r) for r in x[35:]]


@pytest.mark.parametrize("kind", ["MOA_KL", "SKMULTIFLOW_PageHinkley", "MOA_SUBSAMPLE_LOGISTIC_DECAY"])
def test_stream_with_job_conf_equals_table(spark, kind):
    sf = "/root/testdata/sf0.001"
    c = {"drift_detector_type": kind}
    if kind.startswith("MOA_SUBSAMPLE"):
        c = conf("PAGE_HINKLEY", kind, 0.3)
    root = scratch_path(spark, "t-conf")
    job.write_landing(request_log_lines(I.events(spark, sf), keep_ids=True), f"{root}/landing")
    q = job.start(spark, f"{root}/landing", f"{root}/out", f"{root}/ckpt", job_conf=c)
    q.awaitTermination()
    assert q.exception() is None
    got = {(r.model_id, r.batch_id): r.drift_probability for r in read_final_states(spark, f"{root}/out").collect()}
    factory, _ = detector_from_conf(c)
    table = fold_batch_states(I.with_vector_inputs(I.requests(spark, sf), I.identity_cells), factory)
    assert got == {(r.model_id, r.batch_id): r.drift_probability for r in table.collect()}
