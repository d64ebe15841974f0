"""Chunked folds = the sequential fold, value by value."""

import random
from functools import partial

import pytest
from pyspark.sql import functions as F

from tidewatch.operators.blocks import SeqDrift1
from tidewatch.operators.detectors import make_detector
from tidewatch.operators.fold import fold_alarms
from tidewatch.operators.relay import Relay, end_state, entry_state
from tidewatch.operators.vector import VectorDetector

DETECTORS = [
    ("CUSUM", "x", dict(min_n=10, delta=0.005, lam=20.0)), ("PAGE_HINKLEY", "x", dict(min_n=10, delta=0.005, lam=20.0, alpha=0.9999)),
    ("GEOMETRIC_MOVING_AVERAGE", "x", dict(min_n=10, lam=0.3, alpha=0.95)), ("DDM", "b", {}), ("EDDM", "b", {}), ("EWMA", "b", {}),
    ("HDDM_A", "u", dict(two_sided=True)), ("HDDM_W", "u", dict(two_sided=True)),
]


@pytest.fixture
def chunks(spark):
    """As many chunks as the session has shuffle partitions, however small."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.fixture(scope="module")
def rows():
    """80 % of the rows in one key, a shift every 150 rows, some nulls and NaN, requests of three rows."""
    rnd = random.Random(1)
    out = []
    for i in range(6000):
        level = (i // 150) % 2
        x = rnd.gauss(3.0 * level, 1.0)
        b = 1.0 if rnd.random() < 0.2 + 0.6 * level else 0.0
        value = None if rnd.random() < 0.02 else float("nan") if rnd.random() < 0.01 else x
        out.append(("a" if rnd.random() < 0.8 else rnd.choice("bcd"), i, value, b, min(max(x / 8 + 0.3, 0.0), 1.0), i // 3))
    return out


def sequential(rows, column, detector, req=False, any_row=False):
    """One key after the other, one value after the other."""
    out = set()
    for key in {r[0] for r in rows}:
        det, n, pending = detector(), 0, None
        for r in sorted(r for r in rows if r[0] == key):
            x = r["kixbu".index(column)]
            if x is None or x != x:
                continue
            n += 1
            w, c = det.step(x)
            if not req:
                pending = (key, n, r[4], w, c)
                out.add(pending)
                continue
            if pending and pending[2] == r[5]:
                out.discard(pending)
                if any_row:
                    w, c = w or pending[4], c or pending[5]
            pending = (key, n, r[5], r[4], w, c)
            out.add(pending)
    return {r for r in out if r[-1] or r[-2]}


@pytest.mark.parametrize("name, column, options", DETECTORS, ids=[d[0] for d in DETECTORS])
def test_chunks_equal_the_sequential_fold(chunks, rows, name, column, options):
    df = chunks.createDataFrame(rows, "k string, i long, x double, b double, u double, req long")
    detector = partial(make_detector, name, **options)
    for req, poll in ((None, "request_end"), ("req", "request_end"), ("req", "any_row")):
        got = fold_alarms(df, ["k"], ["i"], column, detector, req=req, carry=["u"], poll=poll).collect()
        want = sequential(rows, column, detector, req is not None, poll == "any_row")
        assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_one_key_with_many_changes_over_many_tasks(chunks):
    """Over a hundred changes in one key: its rows are dealt evenly, and most chunks join at a restart in the second pass."""
    rnd = random.Random(7)
    rows = [("hot", i, rnd.gauss(4.0 * ((i // 100) % 2), 1.0)) for i in range(24_000)]
    df = chunks.createDataFrame(rows, "k string, i long, x double")
    detector = partial(make_detector, "CUSUM", min_n=10, delta=0.005, lam=20.0)
    run = Relay(df, ["k"], ["i"], "x", detector)
    det, want = detector(), set()
    for n, (_, _, x) in enumerate(rows, 1):
        if det.step(x)[1]:
            want.add(n)
    assert len(want) > 100 and {r.rn for r in run.alarms().collect()} == want
    sizes = [r["count"] for r in run.stored.where("_kind = 0").groupBy("_pid").count().collect()]
    assert len(sizes) == 7 and max(sizes) < 2 * min(sizes)           # the first of the eight chunks keeps no rows
    joined = [v for v in run.verdict.values() if v[0] and v[4] and v[4][0] is not None]
    assert len(joined) >= 4


def test_a_stretch_without_restarts_goes_on_in_order(chunks):
    """No change before the last rows: no chunk joins, the third pass carries the state through."""
    rows = [("k", i, 0.5 + 0.25 * (i % 3) + (5.0 if i >= 3_900 else 0.0)) for i in range(4_000)]
    df = chunks.createDataFrame(rows, "k string, i long, x double")
    detector = partial(make_detector, "PAGE_HINKLEY", min_n=30, delta=0.005, lam=50.0, alpha=0.9999)
    run = Relay(df, ["k"], ["i"], "x", detector)
    det, want = detector(), set()
    for n, (_, _, x) in enumerate(rows, 1):
        if det.step(x)[1]:
            want.add(n)
    assert want and {r.rn for r in run.alarms().collect()} == want
    assert any(v[2] == 2 for v in run.verdict.values())


def test_blocks_with_several_arguments(chunks):
    rnd = random.Random(3)
    rows = [("a" if i < 700 else "b", i, 20, rnd.gauss(20.0 * ((i // 25) % 2), 3.0)) for i in range(900)]
    rows = [(k, i, n, s, s * s / n + 5.0) for k, i, n, s in rows]
    df = chunks.createDataFrame(rows, "k string, i long, n long, s double, q double")
    got = {tuple(r) for r in fold_alarms(df, ["k"], ["i"], ["n", "s", "q"], SeqDrift1).collect()}
    want = set()
    for key in "ab":
        det = SeqDrift1()
        for n, r in enumerate([r for r in rows if r[0] == key], 1):
            w, c = det.step(*r[2:])
            if w or c:
                want.add((key, n, w, c))
    assert got == want and any(r[3] for r in got)


@pytest.mark.parametrize("any_row", [False, True])
def test_whole_vectors_and_refused_requests(chunks, any_row):
    """Requests of several rows and features; empty ones, null cells, and rows of another length, even a chunk's first."""
    rnd = random.Random(9)
    rows = []
    for i in range(3000):
        level = (i // 120) % 2
        xs = [[rnd.gauss(3.0 * level * (f == 1), 1.0) for f in range(3)] for _ in range(rnd.randint(0, 3))]
        if rnd.random() < 0.2:
            xs = [v + [1.0] for v in xs]
        elif rnd.random() < 0.05 and xs:
            xs[0][2] = None
        rows.append(("m" if i % 5 else "n", i // 100, i, xs))
    df = chunks.createDataFrame(rows, "k string, batch long, i long, xs array<array<double>>")
    detector = partial(make_detector, "CUSUM", min_n=10, delta=0.005, lam=15.0)
    run = Relay(df, ["k"], ["batch", "i"], "xs", detector, any_row=any_row, heads="batch")
    alarms, heads, rejects = set(), {}, set()
    for key in "mn":
        det, n = VectorDetector(detector), 0
        for _, batch, i, xs in [r for r in rows if r[0] == key]:
            if not det.fits(xs):
                rejects.add((key, i))
                continue
            n += 1
            first, count = heads.get((key, batch), (i, 0))
            heads[key, batch] = (first, count + 1)
            flags = {}
            for v in xs:
                det.step(v)
                for f, (w, c) in enumerate(zip(det.w, det.c)):
                    if v[f] is None:
                        continue
                    old = flags.get(f, (False, False)) if any_row else (False, False)
                    flags[f] = (w or old[0], c or old[1])
            if xs:
                det.end_request()
            alarms |= {(key, f, n, w, c) for f, (w, c) in flags.items() if w or c}
    got = {(r.k, r.feature, r.rn, r.warning, r.change) for r in run.alarms().collect()}
    assert got == alarms and len({a[1] for a in alarms}) > 1
    merged = run.heads().groupBy("k", "batch").agg(F.min("i").alias("i"), F.sum("n").alias("n")).collect()
    assert {(r.k, r.batch): (r.i, r.n) for r in merged} == heads
    assert {(r.k, r.i) for r in run.rejects().select("k", "i").collect()} == rejects and rejects


def test_keys_of_several_columns_and_an_empty_table(chunks):
    detector = partial(make_detector, "CUSUM", min_n=2, delta=0.0, lam=1.0)
    rows = [("a", f, i, 5.0 * (i % 7 == f)) for f in range(3) for i in range(200)] + [("b", None, 0, 9.0), (None, 1, 0, 9.0)]
    df = chunks.createDataFrame(rows, "k string, f long, i long, x double")
    got = {tuple(r) for r in fold_alarms(df, ["k", "f"], ["i"], "x", detector).collect()}
    want = set()
    for key in {r[:2] for r in rows}:
        det = detector()
        for n, r in enumerate([r for r in rows if r[:2] == key], 1):
            w, c = det.step(r[3])
            if c:
                want.add((*key, n, w, c))
    assert got == want
    assert fold_alarms(df.limit(0), ["k", "f"], ["i"], "x", detector).count() == 0


def test_entry_states_carry_only_what_goes_on():
    spec = dict(dim=1, dumps=[[3.0]], tail=["7", True, False], first_req="7", last_req="7")
    assert entry_state(end_state(spec, None, None), dict(spec, first_req="8"))["tail"] is None
    assert entry_state(end_state(spec, None, None), spec)["tail"] == ["7", True, False]
    run = dict(dim=1, dumps=[[9.0]], apart=False, cuts=[None], tail=None)
    assert end_state(spec, run, None)["dumps"] == [[9.0]]
    assert end_state(spec, dict(run, cuts=[4]), None)["dumps"] == [[3.0]]


@pytest.mark.parametrize("name, column, options", [DETECTORS[0], DETECTORS[3], DETECTORS[7]], ids=["CUSUM", "DDM", "HDDM_W"])
def test_states_carry_over_slices(chunks, rows, name, column, options):
    """Five slices of the rows, each from the states that the one before left, = all rows at once; idle keys keep theirs."""
    detector = partial(make_detector, name, **options)
    got, base, states = set(), {}, None
    for k in range(5):
        some = [r for r in rows if r[1] // 1200 == k and (r[0] != "d" or k != 2)]
        df = chunks.createDataFrame(some, "k string, i long, x double, b double, u double, req long")
        run = Relay(df, ["k"], ["i"], column, detector, states=states, keep_states=True)
        got |= {(r.k, r.rn + base.get(r.k, 0), r.warning, r.change) for r in run.alarms().collect()}
        for key in {r[0] for r in some}:
            base[key] = base.get(key, 0) + sum(1 for r in some if r[0] == key and r["kixbu".index(column)] == r["kixbu".index(column)]
                                               and r["kixbu".index(column)] is not None)
        new = run.states()
        kept = {r.k: r.state for r in new.collect()}
        assert set(kept) == {r[0] for r in some} and new.count() == len(kept)
        old = {} if states is None else {r.k: r.state for r in states.collect()}
        states = chunks.createDataFrame(list((old | kept).items()), "k string, state string")
    whole = [r for r in rows if r[0] != "d" or r[1] // 1200 != 2]
    assert got == {(r[0], r[1], r[3], r[4]) for r in sequential(whole, column, detector)}
