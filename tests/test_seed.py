"""SEED has no SQL oracle: check the Spark plan (block pre-aggregation +
ordered fold) against a brute-force loop over the raw rows."""

import duckdb

from tidewatch import config as C
from tidewatch.operators.blocks import Seed
from tidewatch.plans.queries import BLOCK_QUERIES, registry


def brute_force(sf_dir):
    _, signal, opts = BLOCK_QUERIES["det_seed"]
    o = C.SeedOptions(**opts)
    rows = duckdb.sql(f"""SELECT event_type, value / 100.0::DOUBLE + CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS s
        FROM read_parquet('{sf_dir}/events.parquet') ORDER BY event_type, ts, event_id""").fetchall()
    out, cur, det, buf, rn = set(), None, None, [], 0
    for key, s in rows:
        if key != cur:
            cur, det, buf, rn = key, Seed(o), [], 0
        rn += 1
        buf.append(s)
        if len(buf) == o.block:
            n, sx, sxx = len(buf), 0.0, 0.0
            for v in buf:
                sx += v
                sxx += v * v
            if det.step(n, sx, sxx)[1]:
                out.add((key, rn))
            buf = []
    if buf and det is not None:
        pass
    return out


def test_seed_matches_brute_force(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        got = {(r.model_id, r.rn) for r in registry()["det_seed"](spark, sf).filter("change").collect()}
        assert got == brute_force(sf)
