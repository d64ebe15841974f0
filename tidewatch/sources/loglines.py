"""Request-log lines derived from the `events` table.

Each event becomes one log line of the serving proxy (a JSON envelope whose
``textPayload`` carries the escaped request body after a marker). Cases are
planted by ``event_id % 10``: 9 truncated body JSON, 8 other path, 7 app
label without the proxy suffix, 6 no marker, 5 response line, 4 bad vector
cell, others good. Bodies are escaped (``\\"``) unless ``event_id % 3 = 0``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.config import SEVERITY_ORDER, LogFormat
from tidewatch.functions.signals import props_k


def _case() -> Column:
    return F.col("event_id") % 10


def _body(fmt: LogFormat, with_authority: bool) -> Column:
    c = _case()
    model = F.concat(F.lit("model-"), F.col("event_type"))
    labels = F.create_map(
        F.lit(fmt.app_label), F.concat(F.col("event_type"), F.when(c == 7, F.lit("-svc")).otherwise(F.lit(fmt.proxy_suffix))),
        F.lit(fmt.model_label), model,
        F.lit(fmt.axon_label), F.concat(F.lit("ax-"), (F.col("user_id") % 3).cast("string")),
        F.lit(fmt.model_id_label), F.col("event_type"))
    vec = F.array(F.array(F.col("value"), F.col("user_id").cast("double"), props_k().cast("double")))
    fields = [F.when(c == 8, F.lit("/health")).otherwise(F.lit(fmt.predict_path)).alias(":path")]
    if with_authority:
        fields.append(F.concat(model, F.lit(":8000")).alias(":authority"))
    fields += [labels.alias(fmt.labels_field),
               F.struct(F.struct(vec.alias("ndarray")).alias("data")).alias("requestBody")]
    body = F.to_json(F.struct(*fields))
    # case 4: first cell of the vector is not a number
    body = F.when(c == 4, F.regexp_replace(body, r'"ndarray":\[\[[^,\]]*', '"ndarray":[["n/a"')).otherwise(body)
    return body


def _with_body(events: DataFrame, fmt: LogFormat, with_authority: bool) -> DataFrame:
    pre = events.select("event_id", "ts", "event_type", "user_id", "value", "props")
    out = pre.withColumn("_b", _body(fmt, with_authority))
    # case 9: body cut short
    return out.withColumn("_b", F.when(_case() == 9, F.expr("substring(_b, 1, length(_b) - 5)")).otherwise(F.col("_b")))


def _payload(fmt: LogFormat, body_col: str) -> Column:
    c = _case()
    escaped = F.when(F.col("event_id") % 3 == 0, F.col(body_col)).otherwise(
        F.replace(F.col(body_col), F.lit('"'), F.lit('\\"')))
    response = F.concat(F.lit('{\\"score\\": '), F.col("event_id").cast("string"), F.lit("}"))
    return (F.when(c == 6, F.lit("GET /healthz 200"))
            .when(c == 5, F.concat(F.lit("proxy response "), F.lit(fmt.response_marker), response))
            .otherwise(F.concat(F.lit("proxy request "), F.lit(fmt.request_marker), escaped)))


def _iso(ts: str = "ts") -> Column:
    return F.date_format(F.col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def request_log_lines(events: DataFrame, fmt: LogFormat = LogFormat(), keep_ids: bool = False) -> DataFrame:
    """One JSON envelope line per event: ``value STRING`` (+ ids if asked)."""
    with_body = _with_body(events, fmt, False)
    env = F.to_json(F.struct(
        F.concat(F.lit("ins-"), F.col("event_id").cast("string")).alias("insertId"),
        _iso().alias("timestamp"),
        _payload(fmt, "_b").alias("textPayload")))
    cols = [F.col("event_id"), F.col("ts"), env.alias("value")] if keep_ids else [env.alias("value")]
    # a source boundary: filters on the line (a marker prefilter) run on the
    # built line instead of being inlined into the scan and built twice
    return with_body.select(F.inline(F.array(F.struct(*cols))))


def file_log_lines(events: DataFrame, fmt: LogFormat = LogFormat()) -> DataFrame:
    """Raw proxy lines without the envelope (the offline file mode)."""
    with_body = _with_body(events, fmt, True)
    return with_body.select(_payload(fmt, "_b").alias("value"))


def severity_log_rows(events: DataFrame, fmt: LogFormat = LogFormat()) -> DataFrame:
    """Rows of the upstream log store: resource type, cluster, severity, payload."""
    with_body = _with_body(events, fmt, False)
    sev = F.element_at(F.array(*[F.lit(s) for s in SEVERITY_ORDER]), (F.col("event_id") % len(SEVERITY_ORDER) + 1).cast("int"))
    return with_body.select(
        F.concat(F.lit("ins-"), F.col("event_id").cast("string")).alias("insert_id"),
        F.when(F.col("event_id") % 7 == 0, F.lit("gce_instance")).otherwise(F.lit("k8s_container")).alias("resource_type"),
        F.when(F.col("event_id") % 11 == 0, F.lit("other-cluster")).otherwise(F.lit("prod-cluster")).alias("cluster_name"),
        sev.alias("severity"),
        _payload(fmt, "_b").alias("text_payload"))
