"""Registered queries: ``(spark, sf_dir) -> DataFrame``, one per operator.

Every query reads the driver tables (``events``) and derives its input with
Spark; the matching DuckDB text lives in ``tidewatch.plans.oracles``.
Outputs carry only stable types (strings, BIGINT, DOUBLE rounded where a
sum order could differ, BOOLEAN); times are rendered as text.
"""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import config as C
from tidewatch.functions import metrics as M
from tidewatch.functions import parse as P
from tidewatch.functions.vectors import explode_vectors, vector_dim
from tidewatch.operators import detectors as D
from tidewatch.operators.fold import alarms_by, fold_alarms
from tidewatch.operators.state import batch_grid, latch, snapshot_all_keys, split_dims
from tidewatch.operators.blocks import block_alarms
from tidewatch.operators.keyed import OUTPUT_COLUMNS, fold_batch_states
from tidewatch.operators.kl import kl_kmeans_windows, kl_vector_windows, kl_windows
from tidewatch.operators.ordering import row_index
from tidewatch.operators.relay import Relay
from tidewatch.operators.vector import any_feature
from tidewatch.operators.votes import Panel, cells, decay, majority, sampled
from tidewatch.operators.windows import cusum_first_alarm, ddm_first_alarm
from tidewatch.plans import inputs as I
from tidewatch.plans import reports as R
from tidewatch.sources.loglines import file_log_lines, request_log_lines, severity_log_rows
from tidewatch.session import stored
from tidewatch.sources.messages import lines_from

KEY = "model_id"
ORDER = ["ts", "event_id"]

# Detector settings of the registered queries.
FLAGSHIP = ("CUSUM", dict(min_n=30, delta=0.005, lam=50.0))
DETECTOR_QUERIES = {
    "det_cusum": ("CUSUM", "s", dict(min_n=30, delta=0.005, lam=50.0)),
    "det_page_hinkley": ("PAGE_HINKLEY", "s", dict(min_n=30, delta=0.005, lam=20.0, alpha=0.9999)),
    "det_gma": ("GEOMETRIC_MOVING_AVERAGE", "s", dict(min_n=30, lam=0.2, alpha=0.99)),
    "det_ddm": ("DDM", "b", {}),
    "det_eddm": ("EDDM", "b", {}),
    "det_ewma": ("EWMA", "b", {}),
    "det_hddm_a": ("HDDM_A", "u", dict(two_sided=True)),
    "det_hddm_w": ("HDDM_W", "u", dict(two_sided=False)),
    "det_adwin": ("ADWIN", "s", dict(delta=0.002, exact=True)),
}
FEATURE_QUERIES = {
    "feat_eddm": ("EDDM", True, {}),
    "feat_page_hinkley": ("PAGE_HINKLEY", False, dict(min_n=30, delta=0.005, lam=20.0, alpha=0.9999)),
    "feat_ddm": ("DDM", True, {}),
    "feat_adwin": ("ADWIN", False, dict(delta=0.002, exact=True)),
}
BLOCK_QUERIES = {
    "det_seqdrift1": ("SEQ1", "s", dict(delta=0.01, warn_delta=0.1, block=200)),
    "det_adwin_histogram": ("ADWIN", "s", dict(delta=0.002)),
    "det_seed": ("SEED", "s", dict(delta=0.05, block=32, eps_prime=0.01, alpha=0.8, compress=75)),
}
KL_QUERIES = {
    "kl_10_5": dict(window=10, bins=5, lo=0.0, hi=5.0),
    "kl_100_1": dict(window=100, bins=1, lo=0.0, hi=5.0),
}
VOTE_DETECTOR = ("PAGE_HINKLEY", dict(min_n=30, delta=0.005, lam=20.0, alpha=0.9999))
VOTE_THRESHOLD = 0.01
ROWS_PER_REQUEST = 3
N_FEATURES = 3
SAMPLE = 16               # sampled features of wide vectors
MAJORITY = 0.3            # above one feature's share of the sample, below that of the features that move together
DECAY_THRESHOLD = 0.05
PANEL = {
    "CUSUM": dict(min_n=20, delta=0.005, lam=3.0), "ADWIN": dict(delta=0.002, exact=True),
    "GEOMETRIC_MOVING_AVERAGE": dict(min_n=20, lam=0.2, alpha=0.9), "DDM": {}, "EDDM": {}, "EWMA": {},
    "PAGE_HINKLEY": dict(min_n=20, delta=0.005, lam=3.0, alpha=0.9999), "HDDM_A": dict(two_sided=True), "HDDM_W": dict(two_sided=False),
    "SEED": dict(delta=0.05, block=32, eps_prime=0.01, alpha=0.8, compress=75), "SEQ1": dict(delta=0.01, warn_delta=0.1, block=100),
}
GATEWAY = dict(gateway="pushgateway", namespace="monitoring", port=9091)
METRIC = "input_drift_probability"
RETENTION_AXON = "ax-0"
RETENTION_ASOF = "2024-01-20 00:00:00"
EXPIRY_SECONDS = 7 * 86_400
STREAM_DAYS = 10          # days of one run of the stream that publishes idle models


def _det(name: str, opts: dict):
    return partial(D.make_detector, name, **opts)


# ---------------------------------------------------------------- ingest


def log_parse_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = P.parse_requests(I.log_lines(spark, sf_dir))
    return r.select("model_id", "model", "axon", "insert_id", "timestamp",
                    F.size("data").cast("bigint").alias("n_rows"),
                    *[F.get(F.get(F.col("data"), 0), i).alias(f"f{i}") for i in range(3)])


def log_reject_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.reject_report(I.log_lines(spark, sf_dir))


def log_message_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects of binary messages: two lines in a message, no message at all for every
    fifth event (its line is null), a null second line where the event id divides by 3."""
    line = F.encode(F.col("value"), "UTF-8")
    second = F.when(F.col("event_id") % 3 != 0, line)
    messages = request_log_lines(I.events(spark, sf_dir), keep_ids=True).select(
        F.when(F.col("event_id") % 5 != 0, F.array(line, second)).alias("message"))
    return P.reject_report(lines_from(messages, "message"))


def log_parse_file_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = P.parse_file_lines(file_log_lines(I.events(spark, sf_dir))).filter(F.col("reason").isNull())
    return r.select("model", "timestamp", *[F.get(F.get(F.col("data"), 0), i).alias(f"f{i}") for i in range(3)])


def log_parse_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.parse_responses(I.log_lines(spark, sf_dir))


def log_prefilter_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.prefilter_predict(I.log_lines(spark, sf_dir))


def log_severity_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = severity_log_rows(I.events(spark, sf_dir))
    return P.severity_filter(rows, cluster="prod-cluster").select("insert_id", "severity")


def vector_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = P.parse_requests(I.log_lines(spark, sf_dir))
    return r.select("insert_id", vector_dim(F.col("data")).cast("bigint").alias("dim"))


def vector_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = P.parse_requests(I.log_lines(spark, sf_dir))
    e = explode_vectors(r, ["insert_id"])
    return e.select("insert_id", F.col("row_idx").cast("bigint"), F.col("feature_idx").cast("bigint"), "x")


# ---------------------------------------------------------------- state


def request_run(reqs: DataFrame, detector=FLAGSHIP, signal=None, poll: str = "request_end") -> tuple[DataFrame, DataFrame]:
    """(states, rejects) of parsed requests over whole vectors, in table mode.

    States per (model, batch): a detector per feature, any feature's flag polled
    at request end, warm-up and latch (the states of the stream mode). Rejects:
    ``model_id, insert_id, reason`` of the requests with another dimension.

    ``detector`` is ``(name, options)`` or a factory of objects with ``step(x)
    -> (warning, change)``, or of vector detectors. Detectors that restart
    after a change run in chunks (``operators.relay``), others in one task a
    model. A model's first row of numbers fixes its dimension; a request with a
    row of another length is not fitted nor counted.
    """
    if poll not in ("request_end", "any_row"):
        raise ValueError("poll must be 'request_end' or 'any_row'")
    det = detector if callable(detector) else _det(*detector)
    inputs = stored(I.with_vector_inputs(reqs, signal))         # parsed once: what follows reads it twice
    if not getattr(det(), "restarts", False):
        kept, rejects = split_dims(inputs, KEY, ["batch_id", "ts", "insert_id"], "xs")
        vector = det if getattr(det(), "vector", False) else any_feature(det)
        return fold_batch_states(kept, vector, KEY, any_row=poll == "any_row"), rejects.select(KEY, "insert_id", "reason")
    run = Relay(inputs, [KEY], ["batch_id", "ts", "insert_id"], "xs", det, carry=["model", "axon"],
                any_row=poll == "any_row", heads="batch_id")
    first = F.struct("ts", "insert_id")
    grid = run.heads().groupBy(KEY, "batch_id").agg(F.min_by("model", first).alias("model"), F.min_by("axon", first).alias("axon"),
                                                    F.sum("n").alias("n_requests"))
    states = latch(grid, alarms_by(run.alarms(), [KEY, "batch_id"]), KEY, "batch_id").select(*OUTPUT_COLUMNS)
    return states, run.rejects().select(KEY, "insert_id", F.lit("dim_mismatch").alias("reason"))


def request_states(reqs: DataFrame, detector=FLAGSHIP, signal=None, poll: str = "request_end") -> DataFrame:
    """The states of ``request_run``."""
    return request_run(reqs, detector, signal, poll)[0]


def state_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = request_states(I.requests(spark, sf_dir))
    return st.select(KEY, "batch_id", "warning_detected", "change_detected", "drift_probability")


def _batch_time(batch: str = "batch_id"):
    return F.date_format(F.date_from_unix_date(F.col(batch).cast("int")).cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss")


def state_rows_of(states: DataFrame) -> DataFrame:
    """Rows of the state table: ``model_id, axon, drift_probability, timestamp``
    (the batch time, so reruns give the same rows)."""
    return states.select(KEY, "axon", "drift_probability", _batch_time().alias("timestamp"))


def state_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state_rows_of(request_states(I.requests(spark, sf_dir)))


def metric_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = request_states(I.requests(spark, sf_dir))
    return st.select(M.push_url(F.col(KEY), **GATEWAY).alias("url"),
                     M.metric_line(F.col("axon"), F.col("drift_probability"), METRIC).alias("line"))


def state_snapshot_all_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    reqs = I.requests(spark, sf_dir).filter(~((F.col(KEY) == "error") & (F.col("batch_id") % 2 == 0)))
    # the state history is stored once (models x batches rows); the spine reads it three times
    st = stored(request_states(reqs).select(KEY, "batch_id", "axon", "drift_probability"))
    return snapshot_all_keys(st, KEY, "batch_id")


def kl_states(reqs: DataFrame, o: C.KlOptions = C.KlOptions(**KL_QUERIES["kl_10_5"])) -> DataFrame:
    """State per (model, batch) of requests ``xs ARRAY<ARRAY<DOUBLE>>`` under the KL
    detector over all features, without a sequential fold: windows, alarms and
    the latch are set operations. A window's alarm belongs to the batch of its
    last row; its warning answers the change flag. Requests with another
    dimension than the model's first are left to ``split_dims``' rejects."""
    reqs = stored(reqs)                                      # parsed once; grid, dimensions and windows read it
    kept, _ = split_dims(reqs, KEY, ["ts", "insert_id"], "xs")
    rows = kept.select(KEY, "ts", "insert_id", "batch_id", F.posexplode("xs").alias("row_idx", "vec")).filter(F.size("vec") > 0)
    windows = kl_vector_windows(rows, KEY, ["ts", "insert_id", "row_idx"], "vec", "batch_id", o)
    alarms = windows.filter("change").groupBy(KEY, "batch_id").agg(
        F.bool_or("change").alias("warning"), F.bool_or("change").alias("change"))
    grid = batch_grid(kept, KEY, "batch_id", order=["ts", "insert_id"], meta=["axon"])
    return latch(grid, alarms, KEY, "batch_id")


def job_kl_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deployed job: log lines -> whole vectors -> KL(10, 5) -> latch -> state rows."""
    return state_rows_of(kl_states(I.with_vector_inputs(I.requests(spark, sf_dir))))


def kl_vector_10_5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of the whole-vector KL detector with the number of changed features."""
    sig = I.signals(spark, sf_dir)
    vec = F.array(F.col("s"), F.col("user_id") / 100.0, F.col("k") / 100.0)
    return kl_vector_windows(sig.withColumn("vec", vec), KEY, ORDER, "vec", "batch_id",
                             C.KlOptions(**KL_QUERIES["kl_10_5"]))


def log_dim_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected requests of models whose row length varies (one more cell where the event id ends in 3)."""
    reqs = I.with_vector_inputs(I.requests(spark, sf_dir), I.identity_cells)
    longer = F.transform("xs", lambda r: F.concat(r, F.array(F.lit(0.0))))
    reqs = stored(reqs.withColumn("xs", F.when(F.col("insert_id").endswith("3"), longer).otherwise(F.col("xs"))))
    _, rejected = split_dims(reqs, KEY, ["ts", "insert_id"], "xs")
    return rejected.select(KEY, "insert_id", "reason")


def state_metadata_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = batch_grid(I.requests(spark, sf_dir), KEY, "batch_id", order=["ts", "insert_id"], meta=["model", "axon"])
    return g.select(KEY, "batch_id", "model", "axon", "n_requests")


def _signal_states(spark: SparkSession, sf_dir: str, detector: str, signal: str, opts: dict) -> DataFrame:
    sig = I.signals(spark, sf_dir)
    alarms = fold_alarms(sig, [KEY], ORDER, signal, _det(detector, opts), carry=["batch_id"])
    grid = batch_grid(sig, KEY, "batch_id")
    return latch(grid, alarms_by(alarms, [KEY, "batch_id"]), KEY, "batch_id")


def state_latch(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = _signal_states(spark, sf_dir, "EDDM", "b", {})
    return st.select(KEY, "batch_id", "warning_detected", "change_detected")


def score_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = _signal_states(spark, sf_dir, "EDDM", "b", {})
    return st.select(KEY, "batch_id", "drift_probability")


# ---------------------------------------------------------------- detectors


def _detector_query(name: str):
    det, signal, opts = DETECTOR_QUERIES[name]

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fold_alarms(I.signals(spark, sf_dir), [KEY], ORDER, signal, _det(det, opts))
    q.__name__ = name
    return q


def _block_query(name: str):
    det, signal, opts = BLOCK_QUERIES[name]

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return block_alarms(I.signals(spark, sf_dir), KEY, ORDER, signal, det, **opts)
    q.__name__ = name
    return q


def _kl_query(name: str):
    opts = KL_QUERIES[name]

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return kl_windows(I.signals(spark, sf_dir), KEY, ORDER, "s", C.KlOptions(**opts))
    q.__name__ = name
    return q


def kl_kmeans_10_5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KL over k-means cells (10-row windows, 5 cells) of the feature vector
    ``[value/100 + d, user_id/100, k/100]``."""
    sig = I.signals(spark, sf_dir)
    vec = F.array(F.col("s"), F.col("user_id") / 100.0, F.col("k") / 100.0)
    return kl_kmeans_windows(sig.withColumn("vec", vec), KEY, ORDER, "vec", C.KlOptions(window=10, bins=5))


def vote_warning_equals_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vector detector whose warning query answers its change flag: the
    warning level (0.8) is unreachable, every alarm is a change."""
    k = _kl_query("kl_10_5")(spark, sf_dir)
    return k.filter("change").select(KEY, "win", F.col("change").alias("warning"), "change")


def cusum_first_alarm_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cusum_first_alarm(I.signals(spark, sf_dir), KEY, ORDER, "s",
                             C.CusumOptions(min_n=30, delta=0.005, lam=50.0))


def ddm_first_alarm_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ddm_first_alarm(I.signals(spark, sf_dir), KEY, ORDER, "b")


def _requests_of_rows(sig: DataFrame) -> DataFrame:
    """Group every ROWS_PER_REQUEST consecutive rows of a key into one request."""
    d = row_index(sig, KEY, ORDER)
    return d.withColumn("req_id", F.floor((F.col("rn") - 1) / ROWS_PER_REQUEST).cast("bigint"))


def poll_request_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _requests_of_rows(I.signals(spark, sf_dir))
    a = fold_alarms(d, [KEY], ORDER, "b", _det("EWMA", {}), req="req_id")
    return a.select(KEY, "req_id", "warning", "change")


def feature_long(spark: SparkSession, sf_dir: str, binary: bool = False) -> DataFrame:
    """``model_id, feature_idx, ts, event_id, req_id, x`` for the 3 features."""
    d = _requests_of_rows(I.signals(spark, sf_dir))
    feats = F.array(F.col("s"), F.col("user_id") / 100.0, F.col("k") / 100.0)
    long = d.select(KEY, "ts", "event_id", "req_id", F.posexplode(feats).alias("feature_idx", "x"))
    long = long.withColumn("feature_idx", F.col("feature_idx").cast("bigint"))
    if binary:
        long = long.withColumn("x", F.when(F.col("x") > 1.0, 1.0).otherwise(0.0))
    return long


def _feature_query(name: str):
    det, binary, opts = FEATURE_QUERIES[name]

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fold_alarms(feature_long(spark, sf_dir, binary), [KEY, "feature_idx"], ORDER, "x", _det(det, opts))
    q.__name__ = name
    return q


def feature_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    det, opts = VOTE_DETECTOR
    return fold_alarms(feature_long(spark, sf_dir), [KEY, "feature_idx"], ORDER, "x", _det(det, opts), req="req_id")


def vote_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alarms_by(feature_flags(spark, sf_dir), [KEY, "req_id"])


def vote_majority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Majority vote of the three features: share of those whose detector changed
    at the request's end; alarm when it exceeds the threshold."""
    changes = feature_flags(spark, sf_dir).where("change").withColumn("n_features", F.lit(N_FEATURES))
    return majority(changes, [KEY, "req_id"], "n_features", VOTE_THRESHOLD).select(KEY, "req_id", F.round("vote", 6).alias("vote"))


def vote_majority_detectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Majority votes of each of the eleven detectors over sampled features of wide
    vectors, latched per batch: the detectors that restart on all sampled features in one
    chunked fold, each of the others on one stream a feature (its state, a window that
    may hold all rows, stays in its task)."""
    reqs = stored(sampled(I.wide_requests(spark, sf_dir), KEY, ["event_id"], "xs", SAMPLE))
    order = ["batch_id", "event_id"]
    reqs = reqs.select(KEY, *order, F.size("features").alias("n_features"), "xs")
    names = [n for n in PANEL if getattr(_det(n, PANEL[n])(), "restarts", False)]
    panel = Panel([_det(n, PANEL[n]) for n in names])
    run = Relay(reqs.withColumn("xs", panel.spread("xs")), [KEY], order, "xs", panel, carry=["n_features"], heads="batch_id")
    detector = F.get(F.array(*[F.lit(n) for n in names]), F.col("feature") % len(names))
    found = [run.alarms().withColumn("detector", detector)]
    whole = cells(split_dims(reqs, KEY, order, "xs")[0], KEY, order, "xs")
    for n in PANEL:
        if n not in names:
            a = fold_alarms(whole, [KEY, "feature"], ["request", "row"], "x", _det(n, PANEL[n]), req="request", carry=["batch_id", "n_features"])
            found.append(a.withColumn("rn", F.col("request")).withColumn("detector", F.lit(n)))
    columns = [KEY, "batch_id", "rn", "n_features", F.struct("detector", KEY).alias("stream")]
    changes = reduce(DataFrame.unionByName, [a.where("change").select(*columns) for a in found])
    votes = majority(changes, ["stream", "batch_id", "rn"], "n_features", MAJORITY)
    alarms = votes.select("stream", "batch_id", F.lit(True).alias("warning"), F.lit(True).alias("change")).distinct()
    grid = run.heads().select(KEY, "batch_id").distinct().select("batch_id", F.explode(F.transform(
        F.array(*[F.lit(n) for n in PANEL]), lambda d: F.struct(d.alias("detector"), F.col(KEY)))).alias("stream"))
    states = latch(grid, alarms, "stream", "batch_id")
    return states.select("stream.detector", f"stream.{KEY}", "batch_id", "change_detected", "drift_probability")


def vote_decay_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logistic-decay vote of sampled features of wide vectors (CUSUM per feature), from its changes."""
    reqs = stored(sampled(I.wide_requests(spark, sf_dir), KEY, ["event_id"], "xs", SAMPLE))
    run = Relay(reqs, [KEY], ["batch_id", "event_id"], "xs", _det("CUSUM", PANEL["CUSUM"]))
    sizes = reqs.groupBy(KEY).agg(F.max(F.size("features")).alias("n_features"), F.count("*").alias("last"))
    votes = decay(run.alarms().where("change"), sizes, KEY, "feature", "rn", DECAY_THRESHOLD)
    return votes.select(KEY, F.col("rn").alias("req_id"), F.round("score", 6).alias("score"))


def vote_logistic_decay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each of the three features votes ``1/(1+exp(age-5))``, age = requests since
    its last change (none yet: 0); alarm when the mean vote exceeds the threshold."""
    rows = feature_long(spark, sf_dir)
    sizes = rows.groupBy(KEY).agg(F.lit(N_FEATURES).alias("n_features"), F.max("req_id").alias("last"))
    votes = decay(feature_flags(spark, sf_dir).where("change"), sizes, KEY, "feature_idx", "req_id", VOTE_THRESHOLD)
    return votes.select(KEY, "req_id", F.round("score", 6).alias("score"))


# ---------------------------------------------------------------- streaming


def stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streaming job end to end: log lines land as files (one folder per
    day), a Structured Streaming query folds them per model with keyed state
    and writes states per epoch; the result is the last state per (model,
    batch), which must equal the table mode (``state_batches``)."""
    from tidewatch.session import scratch_path
    from tidewatch.sources.loglines import request_log_lines
    from tidewatch.streaming import job
    from tidewatch.streaming.sinks import read_final_states

    root = scratch_path(spark, "stream_state")
    job.write_landing(request_log_lines(I.events(spark, sf_dir), keep_ids=True), f"{root}/landing")
    q = job.start(spark, f"{root}/landing", f"{root}/out", f"{root}/checkpoint", detector=FLAGSHIP)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream failed: {q.exception()}")
    st = read_final_states(spark, f"{root}/out")
    return st.select(KEY, "batch_id", "warning_detected", "change_detected", "drift_probability")


def stream_state_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``stream_state`` by chunked folds of three micro-batches of ten days each, from stored model states."""
    from tidewatch.session import scratch_path
    from tidewatch.sources.loglines import request_log_lines
    from tidewatch.streaming import job
    from tidewatch.streaming.chunked import start_chunked
    from tidewatch.streaming.sinks import read_final_states

    root = scratch_path(spark, "stream_chunked")
    for k, events in enumerate(_thirds(I.events(spark, sf_dir))):
        job.write_landing(request_log_lines(events, keep_ids=True), f"{root}/landing/run={k}")
        q = start_chunked(spark, f"{root}/landing", f"{root}/out", f"{root}/checkpoint", detector=FLAGSHIP)
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(f"stream failed: {q.exception()}")
    st = read_final_states(spark, f"{root}/out")
    return st.select(KEY, "batch_id", "warning_detected", "change_detected", "drift_probability")


def _thirds(events: DataFrame) -> list[DataFrame]:
    """Events of the first ``STREAM_DAYS`` days, the next, and all after these."""
    first = events.agg(F.min(F.to_date("ts"))).first()[0]
    part = F.least(F.floor(F.datediff(F.to_date("ts"), F.lit(first)) / STREAM_DAYS), F.lit(2))
    return [events.where(part == k) for k in range(3)]


def stream_snapshot_all_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state table of a stream that publishes idle models: three runs over ten days
    each from one checkpoint, ``error`` sending nothing in the second; each run
    appends the models it saw and the last row of those it did not."""
    from tidewatch.session import scratch_path
    from tidewatch.sources.loglines import request_log_lines
    from tidewatch.streaming import job

    root = scratch_path(spark, "stream_snapshot")
    for k, events in enumerate(_thirds(I.events(spark, sf_dir))):
        some = events.where((F.col("event_type") != "error") | F.lit(k != 1))
        job.write_landing(request_log_lines(some, keep_ids=True), f"{root}/landing/run={k}")
        q = job.start(spark, f"{root}/landing", f"{root}/out", f"{root}/checkpoint", detector=FLAGSHIP, publish_all_keys=True)
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(f"stream failed: {q.exception()}")
    table = spark.read.parquet(f"{root}/out/state_table")
    return table.select(F.col("epoch").cast("bigint").alias("epoch"), KEY, "batch_id", "axon", "drift_probability")


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects of the streaming job by reason; equal to the table mode (``log_reject_report``)."""
    from tidewatch.session import scratch_path
    from tidewatch.sources.loglines import request_log_lines
    from tidewatch.streaming import job

    root = scratch_path(spark, "stream_rejects")
    job.write_landing(request_log_lines(I.events(spark, sf_dir), keep_ids=True), f"{root}/landing")
    q = job.start_rejects(spark, f"{root}/landing", f"{root}/out", f"{root}/checkpoint")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream failed: {q.exception()}")
    return spark.read.parquet(f"{root}/out/rejects").groupBy("reason").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- reports


def _state_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state_rows(spark, sf_dir)


def state_recent_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.recent_first(_state_table(spark, sf_dir))


def state_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.drop_axon_older_than(_state_table(spark, sf_dir), RETENTION_AXON, RETENTION_ASOF, minutes=10)


def state_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.row_count(_state_table(spark, sf_dir))


def state_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.latest_per_model(_state_table(spark, sf_dir))


def state_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State rows that table expiry keeps: at most a week old at the as-of time."""
    return R.expire(state_rows_of(kl_states(I.with_vector_inputs(I.requests(spark, sf_dir)))),
                    RETENTION_ASOF, EXPIRY_SECONDS)


def registry() -> dict:
    q = {
        "log_parse_requests": log_parse_requests,
        "log_reject_report": log_reject_report,
        "log_parse_file_lines": log_parse_file_lines,
        "log_parse_responses": log_parse_responses,
        "log_prefilter_predict": log_prefilter_predict,
        "log_severity_filter": log_severity_filter,
        "vector_dims": vector_dims,
        "vector_explode": vector_explode,
        "state_batches": state_batches,
        "stream_state": stream_state,
        "stream_rejects": stream_rejects,
        "stream_snapshot_all_keys": stream_snapshot_all_keys,
        "stream_state_chunked": stream_state_chunked,
        "log_message_rejects": log_message_rejects,
        "state_expired": state_expired,
        "state_rows": state_rows,
        "metric_lines": metric_lines,
        "state_snapshot_all_keys": state_snapshot_all_keys,
        "job_kl_states": job_kl_states,
        "kl_vector_10_5": kl_vector_10_5,
        "log_dim_mismatch": log_dim_mismatch,
        "state_metadata_first": state_metadata_first,
        "state_latch": state_latch,
        "score_map": score_map,
        "cusum_first_alarm": cusum_first_alarm_q,
        "ddm_first_alarm": ddm_first_alarm_q,
        "poll_request_end": poll_request_end,
        "vote_any": vote_any,
        "vote_warning_equals_change": vote_warning_equals_change,
        "kl_kmeans_10_5": kl_kmeans_10_5,
        "vote_majority": vote_majority,
        "vote_majority_detectors": vote_majority_detectors,
        "vote_decay_wide": vote_decay_wide,
        "vote_logistic_decay": vote_logistic_decay,
        "state_recent_first": state_recent_first,
        "state_retention": state_retention,
        "state_count": state_count,
        "state_latest": state_latest,
    }
    for name in DETECTOR_QUERIES:
        q[name] = _detector_query(name)
    for name in FEATURE_QUERIES:
        q[name] = _feature_query(name)
    for name in BLOCK_QUERIES:
        q[name] = _block_query(name)
    for name in KL_QUERIES:
        q[name] = _kl_query(name)
    return q
