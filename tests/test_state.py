"""State semantics of SURVEY 2.4, one edge case each (table mode)."""

import datetime as dt
import sys

from pyspark import cloudpickle

from tidewatch.operators.state import snapshot_all_keys
from tidewatch.plans.inputs import identity_cells
from tidewatch.plans.queries import request_states

sys.path.insert(0, __file__.rsplit("/", 1)[0])
import scripted  # noqa: E402

cloudpickle.register_pickle_by_value(scripted)

SCHEMA = ("model_id string, model string, axon string, insert_id string, ts timestamp_ntz, "
          "batch_id bigint, data array<array<double>>")


def req(key, batch, minute, rows, axon="ax-1", model="m"):
    ts = dt.datetime(2024, 1, 1) + dt.timedelta(days=batch, minutes=minute)
    return (key, model, axon, f"{key}-{batch}-{minute}", ts, batch, [[float(v)] for v in rows])


def states(spark, reqs, detector=scripted.Scripted, poll="request_end"):
    df = spark.createDataFrame(reqs, SCHEMA)
    out = request_states(df, detector=detector, signal=identity_cells, poll=poll)
    return {(r.model_id, r.batch_id): r for r in out.collect()}


def test_first_batch_alarm_is_suppressed_and_forgotten(spark):
    s = states(spark, [req("a", 1, 0, [2]), req("a", 2, 0, [0])])
    assert (s[("a", 1)].drift_probability, s[("a", 2)].drift_probability) == (0.0, 0.0)


def test_alarm_then_quiet_stays_latched(spark):
    s = states(spark, [req("a", 1, 0, [0]), req("a", 2, 0, [2]), req("a", 3, 0, [0])])
    assert [s[("a", b)].drift_probability for b in (1, 2, 3)] == [0.0, 0.9, 0.9]


def test_warning_then_change(spark):
    s = states(spark, [req("a", 1, 0, [0]), req("a", 2, 0, [1]), req("a", 3, 0, [2]), req("a", 4, 0, [0])])
    assert [s[("a", b)].drift_probability for b in (1, 2, 3, 4)] == [0.0, 0.8, 0.9, 0.9]
    assert s[("a", 3)].warning_detected and s[("a", 3)].change_detected


def test_first_batch_empty_spends_warm_up(spark):
    s = states(spark, [req("c", 1, 0, []), req("c", 2, 0, [2])])
    assert s[("c", 1)].drift_probability == 0.0 and s[("c", 2)].drift_probability == 0.9


def test_metadata_first_request_wins(spark):
    s = states(spark, [req("e", 1, 5, [0], axon="late"), req("e", 1, 1, [0], axon="early")])
    assert s[("e", 1)].axon == "early" and s[("e", 1)].n_requests == 2


def test_poll_at_request_end(spark):
    reqs = [req("a", 1, 0, [0]), req("a", 2, 0, [1, 0])]
    assert states(spark, reqs)[("a", 2)].drift_probability == 0.0
    assert states(spark, reqs, poll="any_row")[("a", 2)].drift_probability == 0.8


def test_idle_key_is_republished(spark):
    df = spark.createDataFrame([req("a", 1, 0, [0]), req("a", 2, 0, [2]), req("a", 3, 0, [0]),
                                req("b", 1, 0, [0]), req("b", 3, 0, [0])], SCHEMA)
    st = request_states(df, detector=scripted.Scripted, signal=identity_cells)
    snap = snapshot_all_keys(st.select("model_id", "batch_id", "axon", "drift_probability"))
    got = {(r.model_id, r.batch_id): (r.drift_probability, r.idle) for r in snap.collect()}
    assert got[("b", 2)] == (0.0, True) and got[("a", 3)] == (0.9, False)
    assert len(got) == 6


def test_real_detector_runs(spark):
    reqs = [req("k", b, m, [0.0]) for b in range(1, 4) for m in range(20)] + [req("k", 4, m, [50.0]) for m in range(5)]
    s = states(spark, reqs, detector=("CUSUM", dict(min_n=30, delta=0.005, lam=5.0)))
    assert s[("k", 3)].drift_probability == 0.0 and s[("k", 4)].drift_probability == 0.9


def test_empty_row_request_does_not_fail(spark):
    # under ANSI mode an out-of-range index raises: a request with an empty row must not
    s = states(spark, [req("a", 1, 0, [0]), ("a", "m", "ax-1", "a-2-0", dt.datetime(2024, 1, 3), 2, [[]]),
                       req("a", 3, 0, [2])])
    assert [s[("a", b)].drift_probability for b in (1, 2, 3)] == [0.0, 0.0, 0.9]
    assert s[("a", 2)].n_requests == 1


def test_rows_of_another_length_are_rejected(spark):
    from tidewatch.operators.state import split_dims
    rows = [("a", 1, []), ("a", 2, [[1.0, 2.0]]), ("a", 3, [[1.0, 2.0], [3.0]]), ("a", 4, [[1.0, 2.0, 3.0]]), ("b", 1, [[1.0]])]
    df = spark.createDataFrame(rows, "model_id string, t int, xs array<array<double>>")
    kept, rejected = split_dims(df, "model_id", ["t"], "xs")
    assert {(r.model_id, r.t) for r in kept.collect()} == {("a", 1), ("a", 2), ("b", 1)}
    assert {(r.model_id, r.t, r.reason) for r in rejected.collect()} == {("a", 3, "dim_mismatch"), ("a", 4, "dim_mismatch")}


def test_vector_kl_states_latch_on_any_feature(spark):
    from tidewatch.plans.queries import kl_states
    rows = []
    for b in range(4):                       # 10 rows a batch; the third feature jumps in batch 2 and returns
        for m in range(10):
            x = [[0.5, 0.5, 4.5 if b == 2 else 0.5]]
            rows.append(("a", "m", "ax", f"{b}-{m}", dt.datetime(2024, 1, 1 + b, 0, m), b, x))
        rows.append(("b", "m", "ax", f"b{b}", dt.datetime(2024, 1, 1 + b), b, [[0.5]]))   # never a full window
    df = spark.createDataFrame(rows, SCHEMA.replace("data", "xs"))
    s = {(r.model_id, r.batch_id): r.drift_probability for r in kl_states(df).collect()}
    assert [s[("a", b)] for b in range(4)] == [0.0, 0.0, 0.9, 0.9]
    assert [s[("b", b)] for b in range(4)] == [0.0] * 4
