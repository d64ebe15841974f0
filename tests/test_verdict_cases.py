"""Text behind a JSON object, lines without an id, ragged detector state, two micro-batches of one day."""

import json

from tidewatch.config import LogFormat
from tidewatch.functions import parse
from tidewatch.operators.kl import KlKmeansRows, kmeans_cells
from tidewatch.plans import reports
from tidewatch.streaming import sinks

FMT = LogFormat()


def _reasons(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    return [r["reason"] for r in parse.parse_lines(df, FMT).collect()]


def test_text_behind_the_object_is_bad_json(spark):
    good = json.dumps({"insertId": "a", "textPayload": "nothing here", "timestamp": "2024-01-01T00:00:00Z"})
    assert _reasons(spark, [good, good + " tail", good + good]) == ["no_request_marker", "bad_json", "bad_json"]


def test_response_lines_need_no_insert_id(spark):
    line = json.dumps({"textPayload": "x", "timestamp": "t"})
    got = parse.parse_responses(spark.createDataFrame([(line,), ("no json",)], "value string"), FMT).collect()
    assert [(r["insert_id"], r["response"]) for r in got] == [(None, "{}")]


def test_kmeans_state_keeps_rows_of_any_length():
    d = KlKmeansRows(window=3)
    for row in ([1, 2, 3], [4, 5], [6, 7, 8], [9], [10, 11]):
        d.step(row)
    e = KlKmeansRows(window=3)
    e.load(d.dump())
    assert (e.prev, e.cur) == (d.prev, d.cur) == ([[1, 2, 3], [4, 5], [6, 7, 8]], [[9], [10, 11]])


def test_kmeans_runs_until_no_row_moves():
    import numpy as np

    x = np.sort(np.random.default_rng(4).normal(size=(4000, 1)) ** 3, axis=0)
    c = kmeans_cells(x, 5)
    lab = ((x[:, None] - c[None]) ** 2).sum(2).argmin(1)
    assert all(abs(c[j] - x[lab == j].mean(0)).max() < 1e-12 for j in range(5))


def test_newer_epoch_of_a_day_wins(spark, tmp_path):
    schema = "model_id string, axon string, batch_id long, drift_probability double"
    out = str(tmp_path)
    old = spark.createDataFrame([(f"m{i}", "a", 5, 0.0) for i in range(50)], schema)
    new = spark.createDataFrame([(f"m{i}", "a", 5, 0.9) for i in range(40)], schema)
    old.write.parquet(f"{out}/latest/epoch=0")
    got = {r["model_id"]: r["drift_probability"] for r in sinks._merge_latest(spark, new, out, 1).collect()}
    assert got == {f"m{i}": 0.9 if i < 40 else 0.0 for i in range(50)}
    rows = [("m", 1, 0, 0.0, "2024-01-01 00:00:00"), ("m", 1, 1, 0.9, "2024-01-01 00:00:00")]
    states = spark.createDataFrame(rows, "model_id string, batch_id long, epoch int, drift_probability double, timestamp string")
    assert reports.latest_per_model(states).first()["drift_probability"] == 0.9


def test_only_detectors_that_restart_have_states_in_the_chunk_table(spark, monkeypatch):
    """Their states are some numbers; a window of exact ADWIN may hold all rows of its stream."""
    from tidewatch.operators.relay import Relay
    from tidewatch.plans import queries
    seen, sent = [], []

    class Watched(Relay):
        def __init__(self, df, keys, order, x, detector, **kw):
            seen.extend(detector.factories)
            super().__init__(df, keys, order, x, detector, **kw)

        def _summaries(self, df):
            got = super()._summaries(df)
            sent.extend(len(d) for s in got for d in s["dumps"])
            return got

    monkeypatch.setattr(queries, "Relay", Watched)
    out = queries.vote_majority_detectors(spark, "/root/testdata/sf0.1").collect()
    assert {r["detector"] for r in out} == set(queries.PANEL)
    assert len(seen) == 9 and all(getattr(f(), "restarts", False) for f in seen)
    assert sent and max(sent) < 100
