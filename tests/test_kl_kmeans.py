"""KL over k-means cells has no SQL oracle: brute force over the raw rows."""

import duckdb
import numpy as np

from tidewatch.operators.kl import kl_cells
from tidewatch.plans.queries import registry


def brute_force(sf_dir, W=10, K=5):
    rows = duckdb.sql(f"""SELECT event_type, value / 100.0::DOUBLE + CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END,
        user_id / 100.0::DOUBLE, CAST(json_extract_string(props, '$.k') AS BIGINT) / 100.0::DOUBLE
        FROM read_parquet('{sf_dir}/events.parquet') ORDER BY event_type, ts, event_id""").fetchall()
    by = {}
    for k, a, b, c in rows:
        by.setdefault(k, []).append((a, b, c))
    out = {}
    for k, xs in by.items():
        x = np.array(xs)
        wins = [x[i:i + W] for i in range(0, len(x), W)]
        for g in range(1, len(wins)):
            kl, chg = kl_cells(wins[g - 1], wins[g], K, W)
            out[(k, g)] = (round(kl, 6), chg)
    return out


def test_kl_kmeans_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    got = {(r.model_id, r.win): (r.kl, r.change) for r in registry()["kl_kmeans_10_5"](spark, sf).collect()}
    exp = brute_force(sf)
    assert got.keys() == exp.keys()
    for k in exp:
        assert abs(got[k][0] - exp[k][0]) < 1e-6 and got[k][1] == exp[k][1]
    assert any(v[1] for v in exp.values())


def test_many_windows_at_once_equal_one_at_a_time():
    """Batched Lloyd = window by window, bit for bit: ties, repeated rows, fewer distinct rows than cells, a short last window."""
    import numpy as np

    from tidewatch.operators.kl import kl_cells, kmeans_pairs
    rng = np.random.default_rng(6)
    ref = np.round(rng.normal(size=(400, 10, 3)) * rng.choice([0.3, 1.0, 5.0], size=(400, 1, 1)), 1)
    ref[:40, 3:] = ref[:40, :1]                          # three or four distinct rows
    ref[40:50] = 2.0                                     # one
    cur = np.round(rng.normal(size=(400, 10, 3)), 1)
    n = np.full(400, 10)
    n[-1] = 4
    kl, change = kmeans_pairs(ref, cur, n, 5, 10)
    for w in range(400):
        want = kl_cells(ref[w], cur[w, :n[w]], 5, 10)
        assert (float(kl[w]), bool(change[w])) == want


def test_windows_over_group_borders(spark, monkeypatch):
    import numpy as np

    from tidewatch import config as C
    from tidewatch.operators import kl
    monkeypatch.setattr(kl, "GROUP", 4)
    rng = np.random.default_rng(2)
    rows = [(k, i, rng.normal(size=2).round(2).tolist()) for k, m in (("a", 203), ("b", 40), ("c", 7)) for i in range(m)]
    df = spark.createDataFrame(rows, "k string, i long, v array<double>")
    got = {(r.k, r.win): (r.kl, r.change) for r in kl.kl_kmeans_windows(df, "k", ["i"], "v", C.KlOptions(window=10, bins=3)).collect()}
    want = {}
    for key in "abc":
        x = np.array([r[2] for r in rows if r[0] == key])
        for w in range(1, -(-len(x) // 10)):
            value, change = kl.kl_cells(x[10 * w - 10:10 * w], x[10 * w:10 * w + 10], 3, 10)
            want[key, w] = (round(value, 6), change)
    assert got == want
