"""Online drift detectors as small step objects.

Each detector consumes one value at a time: ``step(x) -> (warning, change)``.
After a change it restarts at the next value (``restarts``; ADWIN and SEED
shrink their window instead). The arithmetic follows the published methods and is the
specification the SQL oracles reproduce operation by operation, so keep the
evaluation order of every expression as written.

  CUSUM, Page-Hinkley   Page 1954; Hinkley 1971
  GMA                   Roberts 1959
  DDM                   Gama et al. 2004
  EDDM                  Baena-Garcia et al. 2006
  EWMA (ECDD)           Ross et al. 2012
  HDDM_A, HDDM_W        Frias-Blanco et al. 2015
  ADWIN                 Bifet and Gavalda 2007 (exact split search here, histogram in blocks)
  SEED                  Huang et al. 2014
  SeqDrift1             Sakthithasan et al. 2013
"""

from __future__ import annotations

import math

import numpy as np

from tidewatch import config as C

INF = float("inf")

# Control-limit polynomial of the EWMA chart (Ross et al. 2012,
# ARL0 = 1000): L(p) = 3.97 - 6.56 p + 48.73 p^3 - 330.13 p^5 + 848.18 p^7.
ECDD_L = (3.97, 6.56, 48.73, 330.13, 848.18)


class _Stateful:
    """``dump()``/``load()`` of the detector state as a list of doubles (the
    typed ``array<double>`` column of a streaming state store)."""

    __slots__ = ()
    STATE: tuple = ()

    def dump(self) -> list[float]:
        return [float(getattr(self, s)) for s in self.STATE]

    def load(self, values) -> None:
        for s, v in zip(self.STATE, values):
            kind = type(getattr(self, s))
            setattr(self, s, kind(v) if kind is not bool else bool(v))


class Cusum(_Stateful):
    restarts = True
    __slots__ = ("o", "n", "mean", "s")
    STATE = ("n", "mean", "s")

    def __init__(self, o: C.CusumOptions = C.CusumOptions()):
        self.o = o
        self.reset()

    def reset(self):
        self.n, self.mean, self.s = 0, 0.0, 0.0

    def step(self, x):
        self.n += 1
        self.mean = self.mean + (x - self.mean) / self.n
        self.s = max(0.0, self.s + x - self.mean - self.o.delta)
        if self.n >= self.o.min_n and self.s > self.o.lam:
            self.reset()
            return False, True
        return False, False


class PageHinkley(_Stateful):
    restarts = True
    __slots__ = ("o", "n", "mean", "s")
    STATE = ("n", "mean", "s")

    def __init__(self, o: C.PageHinkleyOptions = C.PageHinkleyOptions()):
        self.o = o
        self.reset()

    def reset(self):
        self.n, self.mean, self.s = 0, 0.0, 0.0

    def step(self, x):
        self.n += 1
        self.mean = self.mean + (x - self.mean) / self.n
        self.s = max(0.0, self.o.alpha * self.s + x - self.mean - self.o.delta)
        if self.n >= self.o.min_n and self.s > self.o.lam:
            self.reset()
            return False, True
        return False, False


class Gma(_Stateful):
    restarts = True
    __slots__ = ("o", "oma", "n", "mean", "s")
    STATE = ("n", "mean", "s")

    def __init__(self, o: C.GmaOptions = C.GmaOptions()):
        self.o = o
        self.oma = 1.0 - o.alpha
        self.reset()

    def reset(self):
        self.n, self.mean, self.s = 0, 0.0, 0.0

    def step(self, x):
        self.n += 1
        self.mean = self.mean + (x - self.mean) / self.n
        self.s = self.o.alpha * self.s + self.oma * (x - self.mean)
        if self.n >= self.o.min_n and self.s > self.o.lam:
            self.reset()
            return False, True
        return False, False


class Ddm(_Stateful):
    restarts = True
    __slots__ = ("o", "n", "p", "pmin", "smin", "psmin")
    STATE = ("n", "p", "pmin", "smin", "psmin")

    def __init__(self, o: C.DdmOptions = C.DdmOptions()):
        self.o = o
        self.reset()

    def reset(self):
        self.n, self.p, self.pmin, self.smin, self.psmin = 0, 0.0, INF, INF, INF

    def step(self, x):
        self.n += 1
        self.p = self.p + (x - self.p) / self.n
        rad = self.p * (1.0 - self.p) / self.n
        if rad < 0.0 or self.n < self.o.min_n:   # negative radicand: no alarm
            return False, False
        s = math.sqrt(rad)
        ps = self.p + s
        if ps <= self.psmin:
            self.pmin, self.smin, self.psmin = self.p, s, ps
        if ps > self.pmin + self.o.out_level * self.smin:
            self.reset()
            return False, True
        return ps > self.pmin + self.o.warn_level * self.smin, False


class Eddm(_Stateful):
    """Distances between events (x = 1): ratio of mean + 2 sd to its maximum."""

    restarts = True
    __slots__ = ("o", "n", "last", "k", "mean", "m2", "m2smax")
    STATE = ("n", "last", "k", "mean", "m2", "m2smax")

    def __init__(self, o: C.EddmOptions = C.EddmOptions()):
        self.o = o
        self.reset()

    def reset(self):
        self.n, self.last, self.k, self.mean, self.m2, self.m2smax = 0, 0, 0, 0.0, 0.0, 0.0

    def step(self, x):
        self.n += 1
        if x != 1.0:
            return False, False
        self.k += 1
        dist = self.n - self.last
        self.last = self.n
        dlt = dist - self.mean
        self.mean = self.mean + dlt / self.k
        self.m2 = self.m2 + dlt * (dist - self.mean)
        sd = math.sqrt(self.m2 / self.k) if self.m2 > 0.0 else 0.0
        m2s = self.mean + 2.0 * sd
        if self.n < self.o.min_n:
            return False, False
        if m2s > self.m2smax:
            self.m2smax = m2s
            return False, False
        ratio = m2s / self.m2smax
        if self.k >= self.o.min_events and ratio < self.o.out_ratio:
            self.reset()
            return False, True
        return self.k >= self.o.min_events and ratio < self.o.warn_ratio, False


class Ewma(_Stateful):
    restarts = True
    __slots__ = ("o", "c1", "oml", "n", "sum", "z")
    STATE = ("n", "sum", "z")

    def __init__(self, o: C.EwmaOptions = C.EwmaOptions()):
        self.o = o
        self.c1 = o.lam / (2.0 - o.lam)
        self.oml = 1.0 - o.lam
        self.reset()

    def reset(self):
        self.n, self.sum, self.z = 0, 0.0, 0.0

    def step(self, x):
        self.n += 1
        self.sum = self.sum + x
        p = self.sum / self.n
        self.z = self.z + self.o.lam * (x - self.z)
        rad = p * (1.0 - p) * self.c1 * (1.0 - self.oml ** (2 * self.n))
        if self.n < self.o.min_n or rad < 0.0:
            return False, False
        sd = math.sqrt(rad)
        a, b, c, d, e = ECDD_L
        lim = a - b * p + c * p ** 3 - d * p ** 5 + e * p ** 7
        if self.z > p + lim * sd:
            self.reset()
            return False, True
        return self.z > p + 0.5 * lim * sd, False


class HddmA(_Stateful):
    """Hoeffding bound on the mean before the best cut point vs the whole."""

    restarts = True
    __slots__ = ("o", "ln_d", "ln_w", "N", "S", "cn", "cs", "mn", "ms")
    STATE = ("N", "S", "cn", "cs", "mn", "ms")

    def __init__(self, o: C.HddmAOptions = C.HddmAOptions()):
        self.o = o
        self.ln_d = math.log(1.0 / o.drift_conf)
        self.ln_w = math.log(1.0 / o.warn_conf)
        self.reset()

    def reset(self):
        self.N, self.S, self.cn, self.cs, self.mn, self.ms = 0, 0.0, 0, 0.0, 0, 0.0

    def _eps(self, n):
        return math.sqrt(self.ln_d / (2.0 * n))

    def _thr(self, ncut, ln):
        return math.sqrt((self.N - ncut) / (2.0 * ncut * self.N) * ln)

    def step(self, x):
        self.N += 1
        self.S = self.S + x
        mean = self.S / self.N
        eps = self._eps(self.N)
        if self.cn == 0 or mean + eps <= self.cs / self.cn + self._eps(self.cn):
            self.cn, self.cs = self.N, self.S
        if self.o.two_sided and (self.mn == 0 or mean - eps >= self.ms / self.mn - self._eps(self.mn)):
            self.mn, self.ms = self.N, self.S
        warn = change = False
        if self.N > self.cn:
            dlt = mean - self.cs / self.cn
            if dlt >= self._thr(self.cn, self.ln_d):
                change = True
            elif dlt >= self._thr(self.cn, self.ln_w):
                warn = True
        if self.o.two_sided and not change and self.N > self.mn:
            dlt = self.ms / self.mn - mean
            if dlt >= self._thr(self.mn, self.ln_d):
                change = True
            elif dlt >= self._thr(self.mn, self.ln_w):
                warn = True
        if change:
            self.reset()
            return False, True
        return warn, False


class _Ewm:
    """EWMA with its bound coefficient: first value starts it with ibc = 1."""

    __slots__ = ("n", "z", "ibc")

    def __init__(self):
        self.n, self.z, self.ibc = 0, 0.0, 0.0


class HddmW:
    """Weighted (EWMA) variant: best cut of the total EWMA, second EWMA after it."""

    restarts = True
    __slots__ = ("o", "oml", "lam2", "oml2", "h_d", "h_w", "tot", "inc_set", "inc_z", "inc_ibc", "inc2",
                 "dec_set", "dec_z", "dec_ibc", "dec2")

    def __init__(self, o: C.HddmWOptions = C.HddmWOptions()):
        self.o = o
        self.oml = 1.0 - o.lam
        self.lam2 = o.lam * o.lam
        self.oml2 = self.oml * self.oml
        self.h_d = math.log(1.0 / o.drift_conf) / 2.0
        self.h_w = math.log(1.0 / o.warn_conf) / 2.0
        self.reset()

    def reset(self):
        self.tot = _Ewm()
        self.inc_set, self.inc_z, self.inc_ibc, self.inc2 = False, 0.0, 0.0, _Ewm()
        self.dec_set, self.dec_z, self.dec_ibc, self.dec2 = False, 0.0, 0.0, _Ewm()

    def _add(self, e: _Ewm, x):
        if e.n == 0:
            e.z, e.ibc = x, 1.0
        else:
            e.z = self.o.lam * x + self.oml * e.z
            e.ibc = self.lam2 + self.oml2 * e.ibc
        e.n += 1

    def dump(self) -> list[float]:
        e = [self.tot, self.inc2, self.dec2]
        return ([float(v) for w in e for v in (w.n, w.z, w.ibc)]
                + [float(self.inc_set), self.inc_z, self.inc_ibc, float(self.dec_set), self.dec_z, self.dec_ibc])

    def load(self, v) -> None:
        for i, w in enumerate([self.tot, self.inc2, self.dec2]):
            w.n, w.z, w.ibc = int(v[3 * i]), v[3 * i + 1], v[3 * i + 2]
        self.inc_set, self.inc_z, self.inc_ibc = bool(v[9]), v[10], v[11]
        self.dec_set, self.dec_z, self.dec_ibc = bool(v[12]), v[13], v[14]

    def step(self, x):
        t = self.tot
        self._add(t, x)
        eps = math.sqrt(t.ibc * self.h_d)
        if not self.inc_set or t.z + eps <= self.inc_z + math.sqrt(self.inc_ibc * self.h_d):
            self.inc_set, self.inc_z, self.inc_ibc, self.inc2 = True, t.z, t.ibc, _Ewm()
        else:
            self._add(self.inc2, x)
        if self.o.two_sided:
            if not self.dec_set or t.z - eps >= self.dec_z - math.sqrt(self.dec_ibc * self.h_d):
                self.dec_set, self.dec_z, self.dec_ibc, self.dec2 = True, t.z, t.ibc, _Ewm()
            else:
                self._add(self.dec2, x)
        warn = change = False
        if self.inc2.n > 0:
            diff = self.inc2.z - self.inc_z
            ib = self.inc_ibc + self.inc2.ibc
            if diff > math.sqrt(ib * self.h_d):
                change = True
            elif diff > math.sqrt(ib * self.h_w):
                warn = True
        if self.o.two_sided and not change and self.dec2.n > 0:
            diff = self.dec_z - self.dec2.z
            ib = self.dec_ibc + self.dec2.ibc
            if diff > math.sqrt(ib * self.h_d):
                change = True
            elif diff > math.sqrt(ib * self.h_w):
                warn = True
        if change:
            self.reset()
            return False, True
        return warn, False


def adwin_window(P: np.ndarray, Q: np.ndarray, start: int, t: int, delta: float) -> tuple[float, float, float]:
    """Mean, variance and logarithmic term of the bound of the window (start, t]."""
    n = t - start
    mu = (P[t] - P[start]) / n
    var = (Q[t] - Q[start]) / n - mu * mu
    if var < 0.0:
        var = 0.0
    return mu, var, math.log(2.0 * math.log(n) / delta)


def adwin_last(P: np.ndarray, start: int, t: int, j: np.ndarray, var: float, dd: float) -> int | None:
    """Last of the splits ``j`` (ascending) whose two sides differ by more than the ADWIN bound."""
    n0 = (j - start).astype(np.float64)
    n1 = (t - j).astype(np.float64)
    u0 = (P[j] - P[start]) / n0
    u1 = (P[t] - P[j]) / n1
    inv_m = 1.0 / n0 + 1.0 / n1
    eps = np.sqrt(2.0 * inv_m * var * dd) + 2.0 * inv_m / 3.0 * dd
    hit = np.nonzero(np.abs(u0 - u1) > eps)[0]
    return int(j[hit[-1]]) if hit.size else None


def adwin_cut(P: np.ndarray, Q: np.ndarray, start: int, t: int, delta: float, min_side: int) -> int | None:
    """Largest split j of the window (start, t] whose two sides differ by more
    than the ADWIN bound; ``P``/``Q`` are prefix sums of x and x^2 (index = row)."""
    if t - start < 2 * min_side:
        return None
    _, var, dd = adwin_window(P, Q, start, t, delta)
    return adwin_last(P, start, t, np.arange(start + min_side, t - min_side + 1), var, dd)


class Adwin:
    """Exact ADWIN: every ``clock`` values test every split with both sides of
    at least ``min_side`` values; drop the old side at the last qualifying
    split and test again. Keeps prefix sums of the current window only.

    A split j qualifies where the prefix sum leaves the straight line from the
    window's start to its end by more than ``sqrt(2 var dd n0 n1 / n) + 2 dd / 3``.
    Blocks of 32, 1024, ... rows keep how far the prefix sum leaves their own
    chord, which bounds that distance for all their splits: blocks that cannot
    qualify are passed over (with room for rounding), the rows of the others
    are tested as they stand. So a test costs some blocks of every size, not
    the window.
    """

    __slots__ = ("o", "t", "start", "P", "Q", "n", "base", "new", "low", "high", "first", "made", "scale")
    FAN = 32
    WHOLE = 2048          # rows of a window that is tested without its blocks

    def __init__(self, o: C.AdwinOptions = C.AdwinOptions()):
        self.o = o
        self.t, self.start, self.base = 0, 0, 0
        self._begin(np.zeros(1), np.zeros(1))

    def _begin(self, P: np.ndarray, Q: np.ndarray) -> None:
        """Prefix sums of the rows from ``base`` on, without blocks; ``new`` are values not summed yet."""
        self.P, self.Q, self.n, self.new = P, Q, len(P), []
        self.scale = float(np.abs(P).max())
        self.low: list[np.ndarray] = []          # by block size: how far the sums go below and above the chord
        self.high: list[np.ndarray] = []
        self.first: list[int] = []               # number of the first block, counted from row 0
        self.made: list[int] = []                # blocks so far
        self._blocks()

    def dump(self) -> list[float]:
        self._sum()
        return [float(self.t), float(self.start), float(self.base), float(self.n)] + self.P[:self.n].tolist() + self.Q[:self.n].tolist()

    def load(self, v) -> None:
        self.t, self.start, self.base, k = int(v[0]), int(v[1]), int(v[2]), int(v[3])
        self._begin(np.array(v[4:4 + k], np.float64), np.array(v[4 + k:4 + 2 * k], np.float64))

    def _sum(self) -> None:
        """Values not summed yet enter the prefix sums, one after the other."""
        k = len(self.new)
        if not k:
            return
        if self.n + k > len(self.P):
            room = np.zeros(len(self.P) + k)
            self.P, self.Q = np.concatenate([self.P, room]), np.concatenate([self.Q, room])
        x, i = np.array(self.new, np.float64), self.n
        self.P[i:i + k], self.Q[i:i + k] = x, x * x
        for sums in (self.P, self.Q):
            np.add.accumulate(sums[i - 1:i + k], out=sums[i - 1:i + k])
        self.n, self.new = i + k, []
        self.scale = max(self.scale, float(np.abs(self.P[i:i + k]).max()))
        self._blocks()

    def _blocks(self) -> None:
        """Complete blocks of all sizes get their bounds."""
        end, size, level = self.base + self.n - 1, self.FAN, 0
        while end // size > -(-self.base // size):
            if level == len(self.first):
                self.first.append(-(-self.base // size))
                self.made.append(0)
                self.low.append(np.zeros(16))
                self.high.append(np.zeros(16))
            while self.first[level] + self.made[level] < end // size:
                i = self.made[level]
                if i == len(self.low[level]):
                    self.low[level], self.high[level] = (np.concatenate([v, np.zeros(i)]) for v in (self.low[level], self.high[level]))
                r = (self.first[level] + i) * size - self.base
                p = self.P[r:r + size + 1]
                off = p - (p[0] + (p[-1] - p[0]) * (np.arange(size + 1) / size))
                self.low[level][i], self.high[level][i] = off.min(), off.max()
                self.made[level] = i + 1
            size, level = size * self.FAN, level + 1

    def _splits(self, s: int, e: int, mu: float, var: float, dd: float) -> np.ndarray:
        """Rows of the window (s, e] at which a split may qualify, ascending (rows counted from ``base``)."""
        P, n, side = self.P, e - s, self.o.min_side
        room = 1e-12 * self.scale
        open_: np.ndarray | None = None          # blocks of the next larger size that may hold such a row
        a_up = b_up = 0
        for level in range(len(self.first) - 1, -1, -1):
            size = self.FAN ** (level + 1)
            k0, k1 = -(-(s + self.base) // size), (e + self.base) // size      # complete blocks within the window
            if k1 <= k0:
                continue
            if open_ is None:
                k = np.arange(k0, k1)
            else:
                inner = (open_[:, None] * self.FAN + np.arange(self.FAN)).ravel()
                k = np.concatenate([np.arange(k0, a_up * self.FAN), inner, np.arange(b_up * self.FAN, k1)])
            a = k * size - self.base
            b = a + size
            da, db = P[a] - P[s] - mu * (a - s), P[b] - P[s] - mu * (b - s)
            at = k - self.first[level]
            far = np.maximum(np.maximum(da, db) + self.high[level][at], -np.minimum(da, db) - self.low[level][at])
            lo, hi = np.clip(a, s + side, e - side), np.clip(b, s + side, e - side)
            least = np.minimum((lo - s) * (e - lo).astype(np.float64), (hi - s) * (e - hi).astype(np.float64)) / n
            bound = np.sqrt(2.0 * var * dd * least) + 2.0 / 3.0 * dd
            open_, a_up, b_up = k[~(far + room <= bound * (1.0 - 1e-9))], k0, k1
        lo, hi = s + side, e - side
        if open_ is None:
            return np.arange(lo, hi + 1)
        inner = (open_[:, None] * self.FAN - self.base + np.arange(self.FAN)).ravel()
        j = np.concatenate([np.arange(lo, a_up * self.FAN - self.base), inner, np.arange(max(lo, b_up * self.FAN - self.base), hi + 1)])
        return j[(j >= lo) & (j <= hi)]

    def _cut(self) -> int | None:
        s, e = self.start - self.base, self.t - self.base
        if e - s <= self.WHOLE:
            return adwin_cut(self.P, self.Q, s, e, self.o.delta, self.o.min_side)
        if e - s < 2 * self.o.min_side:
            return None
        mu, var, dd = adwin_window(self.P, self.Q, s, e, self.o.delta)
        if not var < math.inf:        # no number exceeds the bound
            return None
        return adwin_last(self.P, s, e, self._splits(s, e, mu, var, dd), var, dd)

    def step(self, x):
        self.t += 1
        self.new.append(x)
        if self.t % self.o.clock:
            return False, False
        self._sum()
        change = False
        while (cut := self._cut()) is not None:
            self.start = cut + self.base
            change = True
        if change:   # forget prefix sums before the window start
            k = self.start - self.base
            self.base = self.start
            self._begin(self.P[k:self.n].copy(), self.Q[k:self.n].copy())
        return False, change


def _adwin(o: C.AdwinOptions):
    from tidewatch.operators.blocks import adwin_rows
    return Adwin(o) if o.exact else adwin_rows(o)


UNIVARIATE = {
    "CUSUM": (Cusum, C.CusumOptions),
    "PAGE_HINKLEY": (PageHinkley, C.PageHinkleyOptions),
    "GEOMETRIC_MOVING_AVERAGE": (Gma, C.GmaOptions),
    "DDM": (Ddm, C.DdmOptions),
    "EDDM": (Eddm, C.EddmOptions),
    "EWMA": (Ewma, C.EwmaOptions),
    "HDDM_A": (HddmA, C.HddmAOptions),
    "HDDM_W": (HddmW, C.HddmWOptions),
    "ADWIN": (_adwin, C.AdwinOptions),
}


def _seed(o):
    from tidewatch.operators.blocks import seed_rows
    return seed_rows(o)


def _seq1(o):
    from tidewatch.operators.blocks import seqdrift1_rows
    return seqdrift1_rows(o)


UNIVARIATE["SEED"] = (_seed, C.SeedOptions)
UNIVARIATE["SEQ1"] = (_seq1, C.SeqDrift1Options)


def make_detector(name: str, **options):
    """Detector by name with range-checked options (``ValueError`` on bad input)."""
    if name not in UNIVARIATE:
        raise ValueError(f"drift detector {name!r} not implemented; choose from {sorted(UNIVARIATE)}")
    cls, opts = UNIVARIATE[name]
    try:
        o = opts(**options)
    except TypeError as e:
        raise ValueError(f"bad options for {name}: {e}") from None
    return cls(o)
