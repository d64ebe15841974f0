"""Parser fixtures (F1): every way a log line can fail, and the good cases."""

import json

from tidewatch.config import LogFormat
from tidewatch.functions import parse as P

FMT = LogFormat()


def envelope(body, escape=True, insert_id="i1", marker=FMT.request_marker, drop=None):
    b = json.dumps(body) if not isinstance(body, str) else body
    if escape:
        b = b.replace('"', '\\"')
    env = {"insertId": insert_id, "timestamp": "2024-01-01T00:00:00.000000Z", "textPayload": "x " + marker + b}
    for k in drop or []:
        env.pop(k)
    return json.dumps(env)


def body(ndarray, path="/predict", app="m-proxy", labels=None):
    lab = {"app": app, "stable-app": "m", "axon": "ax-1", "deployer": "m1"}
    lab.update(labels or {})
    lab = {k: v for k, v in lab.items() if v is not None}
    return {":path": path, "ISTIO_METAJSON_LABELS": lab, "requestBody": {"data": {"ndarray": ndarray}}}


CASES = [
    ("good", envelope(body([[1, 2, 3]])), None),
    ("good_unescaped", envelope(body([[1.5, 2, 3]]), escape=False), None),
    ("numeric_strings", envelope(body([["1", "2.5", "3"]])), None),
    ("booleans", envelope(body([[True, False, 1]])), None),
    ("empty_ndarray", envelope(body([])), None),
    ("null_line", None, "null_line"),
    ("bad_envelope", '{"insertId": "i1", "textPa', "bad_json"),
    ("missing_insert_id", envelope(body([[1]]), drop=["insertId"]), "missing_field"),
    ("no_marker", json.dumps({"insertId": "i1", "timestamp": "t", "textPayload": "GET /"}), "no_request_marker"),
    ("response_only", envelope({"a": 1}, marker=FMT.response_marker), "no_request_marker"),
    ("bad_body", envelope('{"a": [1, 2', escape=False), "bad_json"),
    ("other_path", envelope(body([[1]], path="/health")), "not_predict_or_proxy"),
    ("not_proxy", envelope(body([[1]], app="m-svc")), "not_predict_or_proxy"),
    ("missing_app_label", envelope(body([[1]], labels={"app": None})), "missing_field"),
    ("missing_deployer", envelope(body([[1]], labels={"deployer": None})), "missing_field"),
    ("json_null_cell", envelope(body([[1, None, 3]])), "bad_vector"),
    ("text_cell", envelope(body([[1, "abc", 3]])), "bad_vector"),
    ("longer_second_row", envelope(body([[1, 2], [1, 2, 3]])), "ragged_vector"),
    ("rank_one", envelope(body([1, 2, 3])), "bad_vector"),
    ("rank_four", envelope(body([[[[1]]]])), "bad_vector"),
    ("null_ndarray", envelope(body(None)), "missing_field"),
    ("bad_timestamp", envelope(body([[1]])).replace("2024-01-01T00:00:00.000000Z", "yesterday"), "bad_timestamp"),
]


def test_reasons(spark):
    df = spark.createDataFrame([(c[1],) for c in CASES], "value string")
    got = [r.reason for r in P.parse_lines(df).collect()]
    assert got == [c[2] for c in CASES]


def test_values(spark):
    df = spark.createDataFrame([(c[1],) for c in CASES[:5]], "value string")
    rows = P.parse_requests(df).collect()
    assert [r.data for r in rows] == [[[1.0, 2.0, 3.0]], [[1.5, 2.0, 3.0]], [[1.0, 2.5, 3.0]], [[1.0, 0.0, 1.0]], []]
    assert {(r.model_id, r.model, r.axon) for r in rows} == {("m1", "m", "ax-1")}


def test_requests_are_the_lines_without_a_reason(spark):
    odd = [envelope(body([[[1, 2], [3, 4]]])), envelope(body([[1], [None]])), envelope(body([[]])), envelope(body([None])), "[null]", "{}",
           envelope(body([[1]])) + " {}", envelope(json.dumps(body([[2]])) + " 1"), envelope("null"), envelope(body([[1]]), drop=["timestamp"]),
           envelope(body([["[1]"]])), envelope({**body([[1]]), "ISTIO_METAJSON_LABELS": [1]}), envelope(body([[1]], path=None)), envelope(body(7))]
    df = spark.createDataFrame([(c[1],) for c in CASES] + [(v,) for v in odd], "value string")
    lines = P.parse_lines(df).where("reason IS NULL")
    got = P.parse_requests(df)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, lines.select(got.columns).collect()))
    assert got.count() >= 6


def test_requests_are_decoded_in_steps(spark, tmp_path):
    """Rejects are dropped before the next decode, and the vector's text is decoded once."""
    spark.createDataFrame([(c[1],) for c in CASES], "value string").write.text(str(tmp_path / "lines"))
    plan = P.parse_requests(spark.read.text(str(tmp_path / "lines")))._jdf.queryExecution().executedPlan().toString().splitlines()
    assert sum(p.count("from_json(ArrayType(ArrayType(StringType") for p in plan) == 1
    steps = [kind for p in plan for kind in ("Filter", "from_json") if f"{kind} " in p.split("[")[0] or f"{kind}(" in p]
    order = [s for i, s in enumerate(steps) if not i or steps[i - 1] != s]
    # from the rows up: marker, envelope, its fields, body, gate, vector, reason
    assert order == ["Filter", "from_json", "Filter", "from_json", "Filter", "from_json", "Filter"]


def test_responses_and_prefilter(spark):
    lines = [envelope({"score": 1}, marker=FMT.response_marker, escape=False),
             envelope(body([[1]]), escape=False), envelope(body([[1]]))]
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    assert [r.response for r in P.parse_responses(df).collect()] == ['{"score": 1}', "{}", "{}"]
    # the raw (escaped) remainder of the third line does not contain "/predict" in quotes
    assert P.prefilter_predict(df).count() == 1


def test_file_mode(spark):
    b = body([[4, 5]])
    b[":authority"] = "model-a:8000"
    lines = ["x " + FMT.request_marker + json.dumps(b).replace('"', '\\"'), "plain text",
             "x " + FMT.request_marker + '{"bad'] 
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    rows = P.parse_file_lines(df).collect()
    assert [(r.model, r.data, r.reason) for r in rows] == [("model-a", [[4.0, 5.0]], None), (None, None, "bad_json")]


def test_severity_filter(spark):
    rows = [("k8s_container", "c1", "ERROR", "a " + FMT.request_marker),
            ("k8s_container", "c1", "INFO", "a " + FMT.request_marker),
            ("k8s_container", "c2", "ERROR", "a " + FMT.request_marker),
            ("gce_instance", "c1", "ERROR", "a " + FMT.request_marker),
            ("k8s_container", "c1", "WARNING", "a " + FMT.response_marker),
            ("k8s_container", "c1", "EMERGENCY", "no marker")]
    df = spark.createDataFrame(rows, "resource_type string, cluster_name string, severity string, text_payload string")
    out = P.severity_filter(df, cluster="c1").collect()
    assert [r.severity for r in out] == ["ERROR", "WARNING"]


def test_severity_filter_pushes_down(spark):
    from tidewatch.session import scratch_path
    rows = [("k8s_container", "c1", "ERROR", "a " + FMT.request_marker)] * 3
    path = scratch_path(spark, "t-sev")
    spark.createDataFrame(rows, "resource_type string, cluster_name string, severity string, text_payload string") \
        .write.parquet(path)
    q = P.severity_filter(spark.read.parquet(path), cluster="c1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = q._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PushedFilters" in plan and "In(severity" in plan and "EqualTo(cluster_name,c1)" in plan
    assert q.count() == 3


def test_rank_three_rows_are_flattened(spark):
    from pyspark.sql import functions as F

    from tidewatch.functions.vectors import vector_dim
    df = spark.createDataFrame([(envelope(body([[[1, 2], [3, 4]], [[5, 6], [7, 8]]])),)], "value string")
    r = P.parse_requests(df).select("data", vector_dim(F.col("data")).alias("dim")).first()
    assert r.data == [[1.0, 2.0, 3.0, 4.0], [5.0, 6.0, 7.0, 8.0]] and r.dim == 4


def test_message_sources(spark):
    from tidewatch.sources.messages import lines_from
    good = envelope(body([[1, 2]]))
    binary = spark.createDataFrame([(bytearray(good.encode()),), (None,)], "value binary")
    got = [r.reason for r in P.parse_lines(lines_from(binary)).collect()]
    assert got == [None, "null_line"]
    multi = spark.createDataFrame([([good, good],), (None,)], "value array<string>")
    assert [r.reason for r in P.parse_lines(lines_from(multi)).collect()] == [None, None, "null_line"]
