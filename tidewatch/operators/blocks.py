"""Block detectors: SeqDrift1, SEED and the histogram form of ADWIN look at data only at block borders.

Rows are numbered per key (chunk-parallel, ``ordering.row_index``), cut into
blocks of ``B`` rows and pre-aggregated to ``(n, sum, sumsq, end_rn)`` with
a plain ``groupBy`` (partial aggregation runs map-side). Only the block
rows, ``B`` times fewer than the data, go through the ordered fold.
"""

from __future__ import annotations

import math
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch import config as C
from tidewatch.operators.fold import fold_alarms
from tidewatch.operators.ordering import row_index


def block_stats(df: DataFrame, key: str, order: list[str], x: str, block: int) -> DataFrame:
    """``key, block, n, sx, sxx, end_rn`` per block of ``block`` consecutive rows."""
    d = row_index(df.select(key, *order, x), key, order)
    d = d.withColumn("block", F.floor((F.col("rn") - 1) / block).cast("bigint"))
    return d.groupBy(key, "block").agg(F.count(F.lit(1)).alias("n"), F.sum(x).alias("sx"),
                                       F.sum(F.col(x) * F.col(x)).alias("sxx"), F.max("rn").alias("end_rn"))


class SeqDrift1:
    """Left reservoir (all blocks since the last change) against the newest block."""

    restarts = True        # after a change the state is that of the block alone
    __slots__ = ("o", "qd", "qw", "ln", "ls", "lq")

    def __init__(self, o: C.SeqDrift1Options = C.SeqDrift1Options()):
        self.o = o
        self.qd = math.log(4.0 / o.delta)
        self.qw = math.log(4.0 / o.warn_delta)
        self.ln, self.ls, self.lq = 0, 0.0, 0.0

    def dump(self) -> list[float]:
        return [float(self.ln), self.ls, self.lq]

    def load(self, v) -> None:
        self.ln, self.ls, self.lq = int(v[0]), v[1], v[2]

    @staticmethod
    def bound(q, var, m):
        return 2.0 / (3.0 * m) * (q + math.sqrt(q * q + 18.0 * var * m * q))

    def step(self, n, s, q):
        n = int(n)
        if self.ln == 0:
            self.ln, self.ls, self.lq = n, s, q
            return False, False
        ntot = self.ln + n
        mu = (self.ls + s) / ntot
        var = (self.lq + q) / ntot - mu * mu
        if var < 0.0:
            var = 0.0
        m = 1.0 / (1.0 / self.ln + 1.0 / n)
        diff = abs(self.ls / self.ln - s / n)
        if diff > self.bound(self.qd, var, m):
            self.ln, self.ls, self.lq = n, s, q
            return False, True
        warn = diff > self.bound(self.qw, var, m)
        self.ln, self.ls, self.lq = ntot, self.ls + s, self.lq + q
        return warn, False


def seed_cut(blocks: list, delta: float) -> int | None:
    """Last block border whose two sides differ by more than the ADWIN-style
    bound over the whole window of blocks; ``None`` if none does."""
    if len(blocks) < 2:
        return None
    N = sum(b[0] for b in blocks)
    S = sum(b[1] for b in blocks)
    Qs = sum(b[2] for b in blocks)
    mu = S / N
    var = Qs / N - mu * mu
    if var < 0.0:
        var = 0.0
    dd = math.log(2.0 * math.log(N) / delta)
    n0 = s0 = 0.0
    best = None
    for i in range(1, len(blocks)):
        n0 += blocks[i - 1][0]
        s0 += blocks[i - 1][1]
        n1 = N - n0
        inv_m = 1.0 / n0 + 1.0 / n1
        eps = math.sqrt(2.0 * inv_m * var * dd) + 2.0 * inv_m / 3.0 * dd
        if abs(s0 / n0 - (S - s0) / n1) > eps:
            best = i
    return best


class Seed:
    """SEED: blocks of the window are tested at their borders; old blocks are
    dropped at the last qualifying border (repeat), and every ``compress``
    blocks neighbours merge when their means differ by less than
    ``eps_prime * (1 + alpha * age)`` (age = borders newer than this one)."""

    __slots__ = ("o", "blocks", "added")

    def __init__(self, o: C.SeedOptions = C.SeedOptions()):
        self.o = o
        self.blocks = []
        self.added = 0

    def dump(self) -> list[float]:
        return [float(self.added)] + [v for b in self.blocks for v in b]

    def load(self, v) -> None:
        self.added = int(v[0])
        rest = list(v[1:])
        self.blocks = [rest[i:i + 3] for i in range(0, len(rest), 3)]

    def step(self, n, s, q):
        self.blocks.append([float(n), s, q])
        self.added += 1
        change = False
        while True:
            cut = seed_cut(self.blocks, self.o.delta)
            if cut is None:
                break
            del self.blocks[:cut]
            change = True
        if self.added % self.o.compress == 0:
            self._compress()
        return False, change

    def _compress(self):
        b = self.blocks
        i = 0
        while i < len(b) - 1:
            age = len(b) - 2 - i
            thr = self.o.eps_prime * (1.0 + self.o.alpha * age)
            if abs(b[i][1] / b[i][0] - b[i + 1][1] / b[i + 1][0]) < thr:
                b[i] = [b[i][0] + b[i + 1][0], b[i][1] + b[i + 1][1], b[i][2] + b[i + 1][2]]
                del b[i + 1]
            else:
                i += 1


class AdwinBlocks:
    """ADWIN over an exponential histogram (Bifet and Gavalda 2007) of blocks.

    A block of ``clock`` rows enters as one bucket; of each size at most
    ``buckets`` buckets stay, the two oldest merge first. Splits are tested at
    the buckets' borders, at every block, with both sides of at least
    ``min_side`` rows. State and work per block are O(buckets * log n).
    """

    __slots__ = ("o", "b")

    def __init__(self, o: C.AdwinOptions = C.AdwinOptions()):
        self.o = o
        self.b = []                 # [n, sum, sumsq], oldest first

    def dump(self) -> list[float]:
        return [v for bucket in self.b for v in bucket]

    def load(self, v) -> None:
        self.b = [list(v[i:i + 3]) for i in range(0, len(v), 3)]

    def _compress(self):
        b, i = self.b, len(self.b) - 1
        while i >= 0:
            size, j = b[i][0], i
            while j > 0 and b[j - 1][0] == size:
                j -= 1
            if i - j + 1 <= self.o.buckets:
                return
            b[j:j + 2] = [[b[j][k] + b[j + 1][k] for k in range(3)]]
            i = j                   # the merged bucket is the newest of the next size

    def _cut(self) -> int | None:
        b = self.b
        N = sum(x[0] for x in b)
        if N < 2 * self.o.min_side or len(b) < 2:
            return None
        S = sum(x[1] for x in b)
        mu = S / N
        var = sum(x[2] for x in b) / N - mu * mu
        if var < 0.0:
            var = 0.0
        dd = math.log(2.0 * math.log(N) / self.o.delta)
        n0 = s0 = 0.0
        best = None
        for i in range(1, len(b)):
            n0 += b[i - 1][0]
            s0 += b[i - 1][1]
            n1 = N - n0
            if n0 < self.o.min_side or n1 < self.o.min_side:
                continue
            inv_m = 1.0 / n0 + 1.0 / n1
            eps = math.sqrt(2.0 * inv_m * var * dd) + 2.0 * inv_m / 3.0 * dd
            if abs(s0 / n0 - (S - s0) / n1) > eps:
                best = i
        return best

    def step(self, n, s, q):
        self.b.append([float(n), s, q])
        self._compress()
        change = False
        while (cut := self._cut()) is not None:
            del self.b[:cut]
            change = True
        return False, change


class BlockRows:
    """Row-at-a-time face of a block detector (streams, vector detectors):
    values are summed into the current block, which is handed to the block
    detector when it completes. Same alarms as the pre-aggregated plan."""

    __slots__ = ("inner", "size", "n", "s", "q")

    @property
    def restarts(self) -> bool:
        return getattr(self.inner, "restarts", False)

    def __init__(self, inner, size: int):
        self.inner, self.size = inner, size
        self.n, self.s, self.q = 0, 0.0, 0.0

    def step(self, x):
        self.n += 1
        self.s += x
        self.q += x * x
        if self.n < self.size:
            return False, False
        out = self.inner.step(self.n, self.s, self.q)
        self.n, self.s, self.q = 0, 0.0, 0.0
        return out

    def dump(self) -> list[float]:
        return [float(self.n), self.s, self.q] + self.inner.dump()

    def load(self, v) -> None:
        self.n, self.s, self.q = int(v[0]), v[1], v[2]
        self.inner.load(list(v[3:]))


def seed_rows(o: C.SeedOptions = C.SeedOptions()) -> BlockRows:
    return BlockRows(Seed(o), o.block)


def seqdrift1_rows(o: C.SeqDrift1Options = C.SeqDrift1Options()) -> BlockRows:
    return BlockRows(SeqDrift1(o), o.block)


def adwin_rows(o: C.AdwinOptions = C.AdwinOptions()) -> BlockRows:
    return BlockRows(AdwinBlocks(o), o.clock)


def _make(cls, opts):
    return cls(opts)


def block_alarms(df: DataFrame, key: str, order: list[str], x: str, detector: str, **options) -> DataFrame:
    """``key, rn, warning, change`` (``rn`` = last row of the alarming block)."""
    cls, ocls, size = {"SEQ1": (SeqDrift1, C.SeqDrift1Options, "block"), "SEED": (Seed, C.SeedOptions, "block"),
                       "ADWIN": (AdwinBlocks, C.AdwinOptions, "clock")}[detector]
    o = ocls(**options)
    block = getattr(o, size)
    # a block is tested when it completes: a trailing partial block waits
    stats = block_stats(df, key, order, x, block).filter(F.col("n") == block)
    a = fold_alarms(stats, [key], ["block"], ["n", "sx", "sxx"], partial(_make, cls, o), carry=["end_rn"])
    return a.select(key, F.col("end_rn").alias("rn"), "warning", "change")
