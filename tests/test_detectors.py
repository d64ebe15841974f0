"""Detector step functions on the reference's test series (fixed seeds)."""

import numpy as np
import pytest

from tidewatch import config as C
from tidewatch.operators import detectors as D
from tidewatch.operators.blocks import Seed, SeqDrift1


def alarms(det, xs):
    return [i for i, x in enumerate(xs) if det.step(float(x))[1]]


@pytest.fixture(scope="module")
def mean_shift():
    """200 rows x 100 features, N(0,1); from row 100 half the features move by 100."""
    rng = np.random.default_rng(7)
    dim = 100
    shift = (rng.random(dim) < 0.5) * 100.0
    data = np.concatenate([rng.normal(0, 1, (100, dim)), rng.normal(0, 1, (100, dim)) + shift])
    return data, shift > 0


@pytest.mark.parametrize("name,opts,at", [
    ("CUSUM", dict(min_n=30, lam=50.0), 100),
    ("PAGE_HINKLEY", dict(min_n=30, lam=50.0), 100),
    ("GEOMETRIC_MOVING_AVERAGE", dict(lam=0.2), 100),
    ("ADWIN", {}, 127),
])
def test_mean_shift_detected_at_change(mean_shift, name, opts, at):
    data, shifted = mean_shift
    for f in np.nonzero(shifted)[0]:
        assert alarms(D.make_detector(name, **opts), data[:, f])[:1] == [at]


@pytest.mark.parametrize("name,opts", [("CUSUM", dict(min_n=30, lam=50.0)),
                                       ("PAGE_HINKLEY", dict(min_n=30, lam=50.0)), ("ADWIN", {})])
def test_mean_shift_quiet_on_unshifted(mean_shift, name, opts):
    data, shifted = mean_shift
    for f in np.nonzero(~shifted)[0]:
        assert alarms(D.make_detector(name, **opts), data[:, f]) == []


def test_too_short_for_cusum_300_and_seq1_200(mean_shift):
    data, shifted = mean_shift
    f = int(np.nonzero(shifted)[0][0])
    assert alarms(D.make_detector("CUSUM", min_n=300), data[:, f]) == []
    s = SeqDrift1()
    col = data[:, f]
    blocks = [col[i:i + 200] for i in range(0, len(col), 200)]
    assert not any(s.step(len(b), float(b.sum()), float((b * b).sum()))[1] for b in blocks)


def test_no_crash_on_raw_values(mean_shift):
    data, _ = mean_shift
    for name in D.UNIVARIATE:
        det = D.make_detector(name)
        for x in data[:, 0]:
            det.step(float(x))    # negative radicands must not raise


@pytest.fixture(scope="module")
def plateau():
    xs = np.full(3000, 19.0)
    xs[999:1500] = 99.0
    return xs


@pytest.mark.parametrize("name", ["CUSUM", "PAGE_HINKLEY", "HDDM_W"])
def test_plateau_raw(plateau, name):
    assert alarms(D.make_detector(name), plateau)[:1] == [999]


@pytest.mark.parametrize("name", ["DDM", "EWMA"])
def test_plateau_binary(plateau, name):
    assert alarms(D.make_detector(name), (plateau > 50).astype(float))[:1] == [999]
    assert alarms(D.make_detector(name), plateau) == []


@pytest.mark.parametrize("name", list(D.UNIVARIATE))
def test_state_round_trip(name):
    rng = np.random.default_rng(3)
    xs = np.concatenate([rng.normal(0, 1, 300), rng.normal(2, 1, 300)])
    a = D.make_detector(name)
    ref = [a.step(float(x)) for x in xs]
    b, got = D.make_detector(name), []
    for i, x in enumerate(xs):
        if i % 37 == 0:
            c = D.make_detector(name)
            c.load(b.dump())
            b = c
        got.append(b.step(float(x)))
    assert got == ref


def test_options_are_validated():
    with pytest.raises(ValueError):
        D.make_detector("NOPE")
    with pytest.raises(ValueError):
        C.DdmOptions(warn_level=9.0)
    with pytest.raises(ValueError):
        C.SeedOptions(block=8)
    with pytest.raises(ValueError):
        D.make_detector("CUSUM", delta=2.0)


def test_seed_shrinks_window_on_shift():
    rng = np.random.default_rng(5)
    xs = np.concatenate([rng.normal(0, 1, 640), rng.normal(3, 1, 640)])
    s = Seed()
    hits = []
    for k in range(0, len(xs), 32):
        b = xs[k:k + 32]
        if s.step(len(b), float(b.sum()), float((b * b).sum()))[1]:
            hits.append(k + 31)
    assert hits and 640 <= hits[0] < 760


def test_adwin_histogram_detects_and_stays_small(mean_shift):
    data, shifted = mean_shift
    f = int(np.nonzero(shifted)[0][0])
    a = alarms(D.make_detector("ADWIN", exact=False), data[:, f])
    assert a[:1] == [127]
    g = int(np.nonzero(~shifted)[0][0])
    assert alarms(D.make_detector("ADWIN", exact=False), data[:, g]) == []
    det = D.make_detector("ADWIN", exact=False)
    for x in np.random.default_rng(1).normal(0, 1, 100_000):
        det.step(float(x))
    assert len(det.inner.b) <= 5 * 13 and sum(b[0] for b in det.inner.b) > 50_000   # O(M log n) buckets, long window


def test_adwin_histogram_state_round_trip():
    xs = np.concatenate([np.random.default_rng(2).normal(0, 1, 500), np.random.default_rng(3).normal(1, 1, 500)])
    a = D.make_detector("ADWIN", exact=False)
    ref = [a.step(float(x)) for x in xs]
    b, got = D.make_detector("ADWIN", exact=False), []
    for i, x in enumerate(xs):
        if i % 41 == 0:
            c = D.make_detector("ADWIN", exact=False)
            c.load(b.dump())
            b = c
        got.append(b.step(float(x)))
    assert got == ref


@pytest.mark.parametrize("kind", ["calm", "steps", "slope", "far"])
def test_exact_adwin_passes_over_blocks_and_cuts_as_every_split_does(kind, monkeypatch):
    n = 20_000
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, n)
    if kind == "steps":
        x += np.arange(n) // 6000 % 2 * 0.4
    elif kind == "slope":
        x += np.arange(n) * 4e-5
    elif kind == "far":
        x += 1e6
    tested = []
    last = D.adwin_last
    monkeypatch.setattr(D, "adwin_last", lambda P, start, t, j, var, dd: tested.append(len(j)) or last(P, start, t, j, var, dd))
    det, got = D.make_detector("ADWIN", exact=True), []
    for i, v in enumerate(x.tolist()):
        if i == 11_111:                       # the state goes through its dump
            state = det.dump()
            det = D.make_detector("ADWIN", exact=True)
            det.load(state)
        if det.step(v)[1]:
            got.append((i + 1, det.start))
    splits = sum(tested)
    P, Q = (np.concatenate([[0.0], np.add.accumulate(v)]) for v in (x, x * x))
    want, start = [], 0
    for t in range(32, n + 1, 32):
        before = start
        while (cut := D.adwin_cut(P, Q, start, t, 0.002, 5)) is not None:
            start = cut
        if start > before:
            want.append((t, start))
    assert got == want and (kind in ("calm", "far") or want)
    if kind in ("calm", "far"):
        assert splits < 0.25 * sum(range(32, n + 1, 32))
