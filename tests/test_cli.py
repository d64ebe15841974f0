"""The command line runs the table and stream jobs end to end."""

import json

from tidewatch import cli
from tidewatch.plans import inputs as I
from tidewatch.session import scratch_path
from tidewatch.sources.loglines import request_log_lines
from tidewatch.streaming import job
from tidewatch.streaming.sinks import read_final_states

SF = "/root/testdata/sf0.001"


def test_table_and_stream_agree(spark, tmp_path):
    root = scratch_path(spark, "t-cli")
    lines = request_log_lines(I.events(spark, SF), keep_ids=True)
    lines.select("value").write.text(f"{root}/lines")
    job.write_landing(lines, f"{root}/landing")
    conf = tmp_path / "conf.json"
    conf.write_text(json.dumps({"drift_detector_type": "SKMULTIFLOW_PageHinkley"}))
    cli.main(["table", "--lines", f"{root}/lines", "--out", f"{root}/table", "--job-conf", str(conf)], spark)
    q = cli.main(["stream", "--landing", f"{root}/landing", "--out", f"{root}/stream",
                  "--checkpoint", f"{root}/ckpt", "--job-conf", str(conf)], spark)
    assert q.exception() is None
    t = {(r.model_id, r.batch_id): r.drift_probability for r in spark.read.parquet(f"{root}/table/states").collect()}
    s = {(r.model_id, r.batch_id): r.drift_probability for r in read_final_states(spark, f"{root}/stream").collect()}
    assert t == s and len(t) > 0
    assert spark.read.parquet(f"{root}/table/rejects").count() == 600
    assert spark.read.parquet(f"{root}/stream/rejects").count() == 600
    assert spark.read.parquet(f"{root}/table/metrics").count() == len(t)


def test_univariate_flags(spark):
    root = scratch_path(spark, "t-cli2")
    request_log_lines(I.events(spark, SF)).write.text(f"{root}/lines")
    cli.main(["table", "--lines", f"{root}/lines", "--out", f"{root}/out", "--detector", "PAGE_HINKLEY",
              "--options", json.dumps({"lam": 5.0})], spark)
    assert spark.read.parquet(f"{root}/out/state_table").count() > 0

