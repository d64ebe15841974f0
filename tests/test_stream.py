"""Streaming form: stream = table, micro-batch by micro-batch, and replay."""

import os

from tidewatch.plans import inputs as I
from tidewatch.plans.queries import FLAGSHIP, request_states
from tidewatch.session import scratch_path
from tidewatch.sources.loglines import request_log_lines
from tidewatch.streaming import job
from tidewatch.streaming.sinks import make_batch_writer, read_final_states

SF = "/root/testdata/sf0.001"


def _days(spark):
    lines = request_log_lines(I.events(spark, SF), keep_ids=True)
    from pyspark.sql import functions as F
    return lines.withColumn("day", F.date_format("ts", "yyyyMMdd")), sorted(
        r.day for r in lines.select(F.date_format("ts", "yyyyMMdd").alias("day")).distinct().collect())


def _table(spark):
    st = request_states(I.requests(spark, SF))
    return {(r.model_id, r.batch_id): (r.warning_detected, r.change_detected, r.drift_probability, r.axon)
            for r in st.collect()}


def _stream(spark, out):
    st = read_final_states(spark, out)
    return {(r.model_id, r.batch_id): (r.warning_detected, r.change_detected, r.drift_probability, r.axon)
            for r in st.collect()}


def _feed(lines, days, landing):
    # one folder per day, written in day order (file order = arrival order)
    for d in days:
        lines.filter(lines.day == d).select("value").coalesce(1).write.mode("overwrite").text(
            os.path.join(landing, f"day={d}"))


def test_stream_equals_table_one_file_per_micro_batch(spark):
    root = scratch_path(spark, "t-stream")
    lines, days = _days(spark)
    _feed(lines, days[:8], f"{root}/landing")
    q = job.start(spark, f"{root}/landing", f"{root}/out", f"{root}/ckpt", detector=FLAGSHIP, max_files_per_trigger=1)
    q.awaitTermination()
    assert q.exception() is None
    assert len(q.recentProgress) >= 8
    table = _table(spark)
    got = _stream(spark, f"{root}/out")
    assert got == {k: v for k, v in table.items() if k in got} and len(got) > 0


def test_restart_from_checkpoint_resumes(spark):
    root = scratch_path(spark, "t-replay")
    lines, days = _days(spark)
    _feed(lines, days[:10], f"{root}/landing")
    q = job.start(spark, f"{root}/landing", f"{root}/out", f"{root}/ckpt", detector=FLAGSHIP, max_files_per_trigger=4)
    q.awaitTermination()
    _feed(lines, days[10:], f"{root}/landing")       # more data arrives; the job restarts
    q = job.start(spark, f"{root}/landing", f"{root}/out", f"{root}/ckpt", detector=FLAGSHIP, max_files_per_trigger=4)
    q.awaitTermination()
    assert q.exception() is None
    assert _stream(spark, f"{root}/out") == _table(spark)


def test_all_keys_latest_table(spark):
    root = scratch_path(spark, "t-latest")
    lines, days = _days(spark)
    _feed(lines, days[:6], f"{root}/landing")
    q = job.start(spark, f"{root}/landing", f"{root}/out", f"{root}/ckpt", detector=FLAGSHIP,
                  max_files_per_trigger=2, publish_all_keys=True)
    q.awaitTermination()
    latest = spark.read.parquet(f"{root}/out/latest")
    last_epoch = latest.agg({"epoch": "max"}).first()[0]
    keys = latest.filter(latest.epoch == last_epoch).select("model_id").distinct().count()
    assert keys == 5


def test_state_table_gets_idle_keys_of_every_micro_batch(spark):
    from tidewatch.operators.keyed import OUTPUT_SCHEMA
    root = scratch_path(spark, "t-idle")
    row = lambda m, b, p: (m, b, "m", f"axon-{m}", 1, p > 0, p > 0.8, p)
    batches = [[row("a", 1, 0.0), row("a", 2, 0.8), row("b", 1, 0.0)], [row("b", 3, 0.9)], []]
    write = make_batch_writer(f"{root}/all", publish_all_keys=True)
    plain = make_batch_writer(f"{root}/plain")
    for epoch, rows in enumerate(batches):
        df = spark.createDataFrame(rows, OUTPUT_SCHEMA)
        write(df, epoch)
        plain(df, epoch)
    write(spark.createDataFrame(batches[1], OUTPUT_SCHEMA), 1)     # a retried micro-batch
    read = lambda out: sorted((r.epoch, r.model_id, r.batch_id, r.drift_probability)
                              for r in spark.read.parquet(f"{root}/{out}/state_table").collect())
    assert read("all") == [(0, "a", 1, 0.0), (0, "a", 2, 0.8), (0, "b", 1, 0.0), (1, "a", 2, 0.8), (1, "b", 3, 0.9),
                           (2, "a", 2, 0.8), (2, "b", 3, 0.9)]
    assert read("plain") == [(0, "a", 1, 0.0), (0, "a", 2, 0.8), (0, "b", 1, 0.0), (1, "b", 3, 0.9)]


def test_arrival_batches_follow_micro_batches(spark):
    root = scratch_path(spark, "t-arrival")
    lines, days = _days(spark)
    _feed(lines, days[:12], f"{root}/landing")
    q = job.start(spark, f"{root}/landing", f"{root}/out", f"{root}/ckpt", detector=FLAGSHIP,
                  max_files_per_trigger=1, batch_by="arrival")
    q.awaitTermination()
    assert q.exception() is None
    got = read_final_states(spark, f"{root}/out")
    seq = {}
    for r in got.orderBy("model_id", "batch_id").collect():
        seq.setdefault(r.model_id, []).append(r.drift_probability)
    table = _table(spark)
    day_batches = sorted({b for (_, b) in table})[:12]
    exp = {}
    for (k, b), v in sorted(table.items()):
        if b in day_batches:
            exp.setdefault(k, []).append(v[2])
    assert seq == exp
    rows = spark.read.parquet(f"{root}/out/state_table").select("timestamp").distinct().count()
    assert rows == 12                               # one trigger time per micro-batch


def test_rocksdb_state_store(spark):
    root = scratch_path(spark, "t-rocks")
    lines, days = _days(spark)
    _feed(lines, days[:5], f"{root}/landing")
    try:
        q = job.start(spark, f"{root}/landing", f"{root}/out", f"{root}/ckpt", detector=FLAGSHIP,
                      max_files_per_trigger=2, rocksdb=True)
        q.awaitTermination()
        assert q.exception() is None
        got = _stream(spark, f"{root}/out")
        table = _table(spark)
        assert got and got == {k: v for k, v in table.items() if k in got}
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def test_any_streaming_source(spark):
    root = scratch_path(spark, "t-source")
    lines, days = _days(spark)
    _feed(lines, days, f"{root}/landing")
    src = spark.readStream.format("text").load(f"{root}/landing").selectExpr("CAST(value AS BINARY) AS payload")
    q = job.start(spark, None, f"{root}/out", f"{root}/ckpt", detector=FLAGSHIP, source=src, source_col="payload")
    q.awaitTermination()
    assert q.exception() is None
    assert _stream(spark, f"{root}/out") == _table(spark)
