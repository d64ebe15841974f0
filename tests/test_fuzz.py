"""Garbage in: the parser and the state fold finish (ANSI mode) and account for every line."""

import json
import random

from tidewatch.config import LogFormat
from tidewatch.functions import parse as P
from tidewatch.operators.state import split_dims
from tidewatch.plans import inputs as I
from tidewatch.plans.queries import request_run

FMT = LogFormat()
ODD = [None, "", "x", 1, -1.5, 1e308, True, [], {}, [[]], [[[]]], [1, 2], [["1", None]], [[1, [2]]],
       [[1e400]], "[[1]]", {"a": 1}, [[1, 2], [3]], [[float("nan")]] if False else [[0.0]]]


def random_line(rng: random.Random) -> str | None:
    """A valid request line with 0-2 random mutations (or plain garbage)."""
    if rng.random() < 0.1:
        return None
    if rng.random() < 0.1:
        return "".join(rng.choice('{}[]":,\\ abcFilterOnRequest:0123') for _ in range(rng.randrange(60)))
    labels = {"app": "m-proxy", "stable-app": "m", "axon": "a", "deployer": rng.choice(["m1", "m2"])}
    nd = [[rng.uniform(-5, 5) for _ in range(3)]]
    request_body = "built below"
    body = {":path": "/predict", "ISTIO_METAJSON_LABELS": labels}
    env = {"insertId": f"i{rng.randrange(10 ** 6)}",
           "timestamp": f"2024-01-0{rng.randrange(1, 4)}T0{rng.randrange(10)}:00:00.000000Z",
           "textPayload": None}
    escape, cut_body, cut_line = rng.random() < 0.5, False, False
    for _ in range(rng.randrange(3)):
        m = rng.randrange(9)
        if m == 0:
            body[":path"] = rng.choice(["/x", None, 3])
        elif m == 1:
            labels[rng.choice(list(labels))] = rng.choice([None, 1, "x"])
        elif m == 2:
            nd = rng.choice(ODD)
        elif m == 3:
            env["timestamp"] = rng.choice(["not a time", "", None, 17, "2024-13-40T99:00:00Z"])
        elif m == 4:
            env["insertId"] = rng.choice([None, 5])
        elif m == 5:
            body["ISTIO_METAJSON_LABELS"] = rng.choice([None, "labels", [1]])
        elif m == 6:
            cut_body = True
        elif m == 7:
            cut_line = True
        else:
            request_body = rng.choice([None, "x", {"data": None}])
    body["requestBody"] = {"data": {"ndarray": nd}} if request_body == "built below" else request_body
    text = json.dumps(body)
    if escape:
        text = text.replace('"', '\\"')
    if cut_body:
        text = text[: rng.randrange(len(text))]
    env["textPayload"] = "pre " + FMT.request_marker + text
    line = json.dumps(env)
    return line[: rng.randrange(len(line))] if cut_line else line


def test_garbage_lines(spark):
    rng = random.Random(20240101)
    lines = [random_line(rng) for _ in range(400)]
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    parsed = P.parse_lines(df).collect()
    assert len(parsed) == len(lines)
    good = [r for r in parsed if r.reason is None]
    assert len(good) > 50 and len({r.reason for r in parsed}) >= 7
    assert all(r.model_id is not None and r.data is not None for r in good)
    assert {r.reason for r in parsed} - {None} <= {"null_line", "bad_json", "missing_field", "no_request_marker",
                                                   "not_predict_or_proxy", "bad_vector", "ragged_vector",
                                                   "bad_timestamp"}
    states, rejects = request_run(I.requests_of(df), detector=("CUSUM", dict(min_n=1, lam=0.1)))
    refused = split_dims(I.with_vector_inputs(I.requests_of(df)), "model_id", ["batch_id", "ts", "insert_id"], "xs")[1]
    assert {(r.model_id, r.insert_id) for r in rejects.collect()} == {(r.model_id, r.insert_id) for r in refused.collect()}
    assert sum(r.n_requests for r in states.collect()) + rejects.count() == len(good) and rejects.count() > 0
