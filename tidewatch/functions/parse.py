"""Request-log parsing as Spark SQL expressions (no UDF).

``parse_lines`` keeps every input line and adds the parsed fields plus a
``reason`` column (null for a good request). ``parse_requests`` keeps the
good ones, ``reject_lines`` the others. The decode order follows the log
model: envelope JSON -> request marker -> unescape -> body JSON -> labels ->
path/proxy gate -> fields -> vector cast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.config import SEVERITY_ORDER, LogFormat

ENVELOPE = T.StructType([
    T.StructField("insertId", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("textPayload", T.StringType()),
])

NDARRAY_TEXT = T.ArrayType(T.ArrayType(T.StringType()))


def body_schema(fmt: LogFormat) -> T.StructType:
    return T.StructType([
        T.StructField(":path", T.StringType()),
        T.StructField(":authority", T.StringType()),
        T.StructField(fmt.labels_field, T.MapType(T.StringType(), T.StringType())),
        T.StructField("requestBody", T.StructType([
            T.StructField("data", T.StructType([T.StructField("ndarray", T.StringType())]))])),
    ])


def after_marker(text: Column, marker: str) -> Column:
    """Text after the first occurrence of ``marker``; null when absent (split once)."""
    pos = F.locate(marker, text)
    return F.when(pos > 0, text.substr(pos + len(marker), F.length(text) + 1))


def unescape(col: Column) -> Column:
    """Literal replace of backslash-quote by quote."""
    return F.replace(col, F.lit('\\"'), F.lit('"'))


NDARRAY_RANK3 = T.ArrayType(T.ArrayType(T.ArrayType(T.StringType())))


ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]'Z'"


def parse_ts(text: Column) -> Column:
    """Event time of a request as TIMESTAMP_NTZ (UTC wall clock); null when
    unparseable (``try_``: no failure under ANSI mode). A ``...Z`` text is
    read as a wall clock and cast back in the same session zone, so the
    result does not depend on the session time zone; other ISO forms go
    through the general cast."""
    wall = F.try_to_timestamp(text, F.lit(ISO_UTC)).cast("timestamp_ntz")
    return F.coalesce(wall, F.try_to_timestamp(text).cast("timestamp_ntz"))


def ndarray_rows(raw: Column, r2: Column | None = None) -> Column:
    """Rows of a request's ``ndarray`` (its raw JSON text) as arrays of cell
    texts. Rank 2 is read as is; for rank 3 every row is flattened, so a row
    has the product of its shape as dimension. Anything else (rank 1, a cell
    nested deeper) leaves null rows or non-numeric cells: a ``bad_vector``.
    ``r2``: a column that holds the rank 2 reading, which is used twice."""
    r2 = F.from_json(raw, NDARRAY_TEXT) if r2 is None else r2
    nested = F.exists(r2, lambda r: F.exists(r, lambda c: c.startswith("[")))
    r3 = F.transform(F.from_json(raw, NDARRAY_RANK3), lambda r: F.flatten(r))
    return F.when(nested, r3).otherwise(r2)


def cast_cells(ndarray: Column) -> Column:
    """array<array<string>> -> array<array<double>>; numeric strings and
    booleans cast, anything else (JSON null included) becomes null."""
    def cell(c):
        return (F.when(c == "true", F.lit(1.0)).when(c == "false", F.lit(0.0))
                .otherwise(c.try_cast("double")))
    return F.transform(ndarray, lambda r: F.transform(r, cell))


def has_null_cell(data: Column) -> Column:
    return F.exists(data, lambda r: F.exists(r, lambda c: c.isNull()))


def is_ragged(data: Column) -> Column:
    return F.exists(data, lambda r: F.size(r) != F.size(F.get(data, 0)))


def vector_reason() -> Column:
    """Why a request with all fields is dropped, from ``_rows``, ``data`` and ``_ts``; null for a good one."""
    return (F.when(F.col("_rows").isNull() | has_null_cell(F.col("data")), "bad_vector")
            .when(is_ragged(F.col("data")), "ragged_vector")
            .when(F.col("_ts").isNull(), "bad_timestamp"))


def with_object(df: DataFrame, name: str, text: Column, schema: T.StructType) -> DataFrame:
    """Add ``name``: the text's single JSON object, or null.

    ``from_json`` reads the first value and ignores what follows it. Read as
    the one element of an array, text with more than that (or less) is no
    array of one, so a text is decoded once. A field of another type is null.
    """
    df = df.withColumn("_read", read_object(text, schema))
    return df.withColumn(name, F.when(F.size("_read") == 1, F.get(F.col("_read"), 0))).drop("_read")


def read_object(text: Column, schema: T.StructType) -> Column:
    """The text's JSON values as an array: of one element if the text is a single object."""
    return F.from_json(F.concat(F.lit("["), text, F.lit("]")), T.ArrayType(schema), {"mode": "PERMISSIVE"})


def with_body(df: DataFrame, name: str, body: Column, fmt: LogFormat) -> DataFrame:
    return with_object(df, name, unescape(body), body_schema(fmt))


def _fence(df: DataFrame, cols: list[Column]) -> DataFrame:
    """Project ``cols`` through a one-row ``inline`` generator.

    Filters on the parsed columns (``reason IS NULL``) then stay above the
    decode: without it Catalyst pushes them below the projections and inlines
    every ``from_json`` reference into an interpreted filter.
    """
    return df.select(F.inline(F.array(F.struct(*cols))))


def parse_lines(lines: DataFrame, fmt: LogFormat = LogFormat(), value_col: str = "value") -> DataFrame:
    """Every line with parsed columns and a ``reason`` (null = good request)."""
    v = F.col(value_col)
    df = with_object(lines, "_env", v, ENVELOPE)
    raw_body = after_marker(F.col("_env.textPayload"), fmt.request_marker)
    df = with_body(df.withColumn("_raw", raw_body), "_body", F.col("_raw"), fmt)
    labels = F.col("_body").getField(fmt.labels_field)
    app = labels.getItem(fmt.app_label)
    path = F.col("_body").getField(":path")
    nd = F.col("_body.requestBody.data.ndarray")          # raw JSON text of the array
    df = df.withColumn("_rows", ndarray_rows(nd)).withColumn("data", cast_cells(F.col("_rows")))
    df = df.withColumn("_ts", parse_ts(F.col("_env.timestamp")))
    model_id, model, axon = (labels.getItem(fmt.model_id_label), labels.getItem(fmt.model_label),
                             labels.getItem(fmt.axon_label))
    reason = (F.when(v.isNull(), "null_line")
              .when(F.col("_env").isNull(), "bad_json")
              .when(F.col("_env.insertId").isNull() | F.col("_env.textPayload").isNull(), "missing_field")
              .when(F.col("_raw").isNull(), "no_request_marker")
              .when(F.col("_body").isNull(), "bad_json")
              .when(labels.isNull() | app.isNull() | path.isNull(), "missing_field")
              .when(~((path == fmt.predict_path) & app.endswith(fmt.proxy_suffix)), "not_predict_or_proxy")
              .when(model_id.isNull() | model.isNull() | axon.isNull() | F.col("_env.timestamp").isNull()
                    | nd.isNull(), "missing_field")
              .otherwise(vector_reason()))
    return _fence(df, [
        F.col("_env.insertId").alias("insert_id"),
        model_id.alias("model_id"), model.alias("model"), axon.alias("axon"),
        F.col("_env.timestamp").alias("timestamp"), F.col("_ts").alias("ts"),
        F.col("data"), reason.alias("reason"), v.alias("value")])


def parse_requests(lines: DataFrame, fmt: LogFormat = LogFormat(), value_col: str = "value") -> DataFrame:
    """Good requests: ``model_id, model, axon, insert_id, timestamp, ts, data``.

    The rows of ``parse_lines`` without a reason, in steps: a line is dropped at
    its first one, so the body is decoded only of envelopes with a request and
    the vector only of requests that pass the gate. A cheap ``contains(marker)``
    filter runs first. Every step is fenced: its filter stays above its decode.
    """
    v, read = F.col(value_col), F.get(F.col("_read"), 0)
    one = F.size("_read") == 1
    df = lines.filter(v.contains(fmt.request_marker)).select(read_object(v, ENVELOPE).alias("_read"))
    raw = after_marker(read.getField("textPayload"), fmt.request_marker)
    df = _fence(df, [one.alias("_one"), read.getField("insertId").alias("insert_id"), read.getField("timestamp").alias("timestamp"),
                     raw.alias("_raw")])
    df = df.filter(F.col("_one") & F.col("insert_id").isNotNull() & F.col("_raw").isNotNull() & F.col("timestamp").isNotNull())
    kept = ["insert_id", "timestamp"]
    df = df.select(*kept, read_object(unescape(F.col("_raw")), body_schema(fmt)).alias("_read"))
    labels = read.getField(fmt.labels_field)
    fields = {"model_id": labels.getItem(fmt.model_id_label), "model": labels.getItem(fmt.model_label), "axon": labels.getItem(fmt.axon_label),
              "_nd": read.getField("requestBody").getField("data").getField("ndarray")}
    df = _fence(df, [*map(F.col, kept), one.alias("_one"), labels.getItem(fmt.app_label).alias("_app"), read.getField(":path").alias("_path"),
                     *[c.alias(name) for name, c in fields.items()]])
    passes = F.col("_one") & (F.col("_path") == fmt.predict_path) & F.col("_app").endswith(fmt.proxy_suffix)
    for name in fields:
        passes = passes & F.col(name).isNotNull()
    df = df.filter(passes).withColumn("_r2", F.from_json(F.col("_nd"), NDARRAY_TEXT))
    df = df.withColumn("_rows", ndarray_rows(F.col("_nd"), F.col("_r2"))).drop("_r2")
    df = df.withColumn("data", cast_cells(F.col("_rows"))).withColumn("_ts", parse_ts(F.col("timestamp")))
    # the reason is projected first: the fence of plain columns is compiled
    df = df.withColumn("_reason", vector_reason())
    names = ["model_id", "model", "axon", "insert_id", "timestamp"]
    df = _fence(df, [*map(F.col, names), F.col("_ts").alias("ts"), F.col("data"), F.col("_reason").alias("reason")])
    return df.filter(F.col("reason").isNull()).drop("reason")


def reject_lines(lines: DataFrame, fmt: LogFormat = LogFormat(), value_col: str = "value") -> DataFrame:
    """Dropped lines with their reason: ``insert_id, reason, value``."""
    return (parse_lines(lines, fmt, value_col).filter(F.col("reason").isNotNull())
            .select("insert_id", "reason", "value"))


def reject_report(lines: DataFrame, fmt: LogFormat = LogFormat(), value_col: str = "value") -> DataFrame:
    return reject_lines(lines, fmt, value_col).groupBy("reason").agg(F.count("*").alias("n"))


def parse_file_lines(lines: DataFrame, fmt: LogFormat = LogFormat(), value_col: str = "value") -> DataFrame:
    """Raw proxy lines (no envelope): model = authority host, timestamp 0, no
    proxy check. Lines that fail to decode get a reason instead of failing."""
    v = F.col(value_col)
    raw = after_marker(v, fmt.request_marker)
    df = with_body(lines.filter(v.contains(fmt.request_marker)), "_body", raw, fmt)
    nd = F.col("_body.requestBody.data.ndarray")
    df = df.withColumn("_rows", ndarray_rows(nd)).withColumn("data", cast_cells(F.col("_rows")))
    authority = F.col("_body").getField(":authority")
    path = F.col("_body").getField(":path")
    reason = (F.when(F.col("_body").isNull(), "bad_json")
              .when(path.isNull(), "missing_field")
              .when(path != fmt.predict_path, "not_predict")
              .when(authority.isNull() | nd.isNull(), "missing_field")
              .when(F.col("_rows").isNull() | has_null_cell(F.col("data")), "bad_vector")
              .when(is_ragged(F.col("data")), "ragged_vector"))
    return _fence(df, [F.substring_index(authority, ":", 1).alias("model"),
                       F.lit(0).cast("bigint").alias("timestamp"), F.col("data"), reason.alias("reason")])


def parse_responses(lines: DataFrame, fmt: LogFormat = LogFormat(), value_col: str = "value") -> DataFrame:
    """Text after the response marker, else the literal ``{}``; a line without an insert id keeps a null one."""
    df = with_object(lines, "_env", F.col(value_col), ENVELOPE).filter(F.col("_env").isNotNull())
    resp = after_marker(F.col("_env.textPayload"), fmt.response_marker)
    return df.select(F.col("_env.insertId").alias("insert_id"), F.coalesce(resp, F.lit("{}")).alias("response"))


def prefilter_predict(lines: DataFrame, fmt: LogFormat = LogFormat(), value_col: str = "value") -> DataFrame:
    """Lines whose raw (still escaped) request body contains ``"<predict path>"``
    with quotes; an escaped body does not match, as in the log model."""
    df = with_object(lines, "_env", F.col(value_col), ENVELOPE)
    raw = after_marker(F.col("_env.textPayload"), fmt.request_marker)
    return (df.filter(raw.isNotNull() & raw.contains(f'"{fmt.predict_path}"'))
            .select(F.col("_env.insertId").alias("insert_id")))


def severity_filter(rows: DataFrame, cluster: str, min_severity: str = "WARNING",
                    resource_type: str = "k8s_container", fmt: LogFormat = LogFormat()) -> DataFrame:
    """Upstream log filter: resource type, cluster, severity >= min, and a
    request or response marker in the payload."""
    rank = SEVERITY_ORDER.index(min_severity)
    text = F.col("text_payload")
    # severity >= min as an IN list of names: pushed down to the scan like the equalities
    return rows.filter((F.col("resource_type") == resource_type) & (F.col("cluster_name") == cluster)
                       & F.col("severity").isin(SEVERITY_ORDER[rank:])
                       & (text.contains(fmt.request_marker) | text.contains(fmt.response_marker)))
