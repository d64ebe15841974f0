"""Chunked streams = table mode, over restarts, retried epochs and micro-batches of any cut."""

from functools import partial

from pyspark.sql import functions as F

from tidewatch.operators.detectors import make_detector
from tidewatch.plans import inputs as I
from tidewatch.plans.queries import FLAGSHIP, request_run
from tidewatch.session import scratch_path
from tidewatch.streaming.chunked import make_chunked_writer
from tidewatch.streaming.sinks import read_final_states

SF = "/root/testdata/sf0.001"


def _rows(df):
    return {(r.model_id, r.batch_id): (r.axon, r.n_requests, r.warning_detected, r.change_detected, r.drift_probability) for r in df.collect()}


def test_epochs_equal_the_table_and_can_be_retried(spark):
    """Batches of an uneven cut; one epoch runs twice, as after a failure; a longer row is refused in a later epoch."""
    inputs = I.with_vector_inputs(I.requests(spark, SF))
    longer = F.transform("xs", lambda r: F.concat(r, F.array(F.lit(0.0))))
    inputs = inputs.withColumn("xs", F.when(F.col("insert_id").endswith("33"), longer).otherwise(F.col("xs"))).checkpoint()
    days = sorted(r[0] for r in inputs.select("batch_id").distinct().collect())
    cuts = [days[:1], days[1:9], days[9:10], days[10:]]
    root = scratch_path(spark, "t-chunked")
    write = make_chunked_writer(root, partial(make_detector, FLAGSHIP[0], **FLAGSHIP[1]))
    for epoch, some in enumerate(cuts):
        batch = inputs.where(F.col("batch_id").isin(some))
        write(batch, epoch)
        if epoch == 1:
            write(batch, epoch)
    states, rejects = request_run_of(inputs)
    assert _rows(read_final_states(spark, root)) == _rows(states)
    refused = {r.insert_id for r in spark.read.parquet(f"{root}/dim_rejects").collect()}
    assert refused == {r.insert_id for r in rejects.collect()} and refused
    models = spark.read.parquet(f"{root}/models/epoch=3")
    assert models.count() == models.select("model_id").distinct().count() == states.select("model_id").distinct().count()


def request_run_of(inputs):
    return request_run(inputs.withColumnRenamed("xs", "data"), signal=I.identity_cells)


def test_keyed_states_tag_requests_of_another_dimension():
    """The keyed stream's state function gives states and refused requests in one pass, over two micro-batches."""
    import datetime as dt

    import pandas as pd

    from tidewatch.operators.vector import any_feature
    from tidewatch.streaming.stateful import _update

    class State:
        exists, get = False, None

        def update(self, value):
            self.exists, self.get = True, value

    def batch(*rows):
        return pd.DataFrame([("k", b, dt.datetime(2024, 1, b, i), f"r{b}-{i}", "m", "ax", xs) for b, i, xs in rows],
                            columns=["model_id", "batch_id", "ts", "insert_id", "model", "axon", "xs"])

    state, factory = State(), any_feature(partial(make_detector, "CUSUM", min_n=1, delta=0.0, lam=1.0))
    first = next(_update(factory, False, ("k",), iter([batch((1, 1, [[0.0, 0.0]]), (1, 0, [[]]), (1, 2, [[0.0]]))]), state))
    later = next(_update(factory, False, ("k",), iter([batch((2, 0, [[9.0, 0.0, 0.0]])), batch((3, 0, [[0.0, 9.0]]))]), state))
    rows = [(r.batch_id, r.n_requests, r.drift_probability, r.reject) for out in (first, later) for r in out.itertuples()]
    states = [r[:3] for r in rows if r[3] is None or r[3] != r[3]]
    assert states == [(1, 2, 0.0), (3, 1, 0.9)] and [r[3] for r in rows if isinstance(r[3], str)] == ["r1-2", "r2-0"]


def test_rejects_of_both_stages_are_read_together(spark):
    from tidewatch.streaming.sinks import read_rejects
    root = scratch_path(spark, "t-rejects")
    spark.createDataFrame([("a", "bad_json", "x")], "insert_id string, reason string, value string").write.parquet(f"{root}/rejects")
    assert {tuple(r) for r in read_rejects(spark, root).collect()} == {("a", "bad_json")}
    spark.createDataFrame([("m", "b", "dim_mismatch")], "model_id string, insert_id string, reason string").write.parquet(f"{root}/dim_rejects/epoch=0")
    assert {tuple(r) for r in read_rejects(spark, root).collect()} == {("a", "bad_json"), ("b", "dim_mismatch")}
