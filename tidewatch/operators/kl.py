"""KL-divergence window detector (equal-width bins), as a window-free plan.

Rows are numbered per key (chunk-parallel), cut into windows of ``W`` rows,
and binned into ``K`` equal-width bins over ``[lo, hi)`` (values outside go
to the end bins). Bin counts per ``(key, window)`` come from one
``groupBy`` with ``K`` conditional sums; each window is compared with the
one before it through an equi-join on ``(key, window + 1)``. With
``p_b = (c_b + 0.5) / (n + 0.5 K)`` for the previous window and ``q_b`` the
same for the current one, ``KL = sum_b p_b ln(p_b / q_b)``; a change is
``2 W KL`` above the 95% chi-square quantile with ``K - 1`` degrees of
freedom (Kuncheva 2013). One bin has no degree of freedom: never a change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch import config as C
from tidewatch.operators.ordering import row_index

# 95% quantiles of the chi-square distribution, 1..10 degrees of freedom.
CHI2_95 = [3.841, 5.991, 7.815, 9.488, 11.070, 12.592, 14.067, 15.507, 16.919, 18.307]


def chi2_95(dof: int) -> float:
    return float("inf") if dof < 1 else CHI2_95[dof - 1]


def bin_of(x: Column, o: C.KlOptions) -> Column:
    width = (o.hi - o.lo) / o.bins
    return F.least(F.greatest(F.floor((x - F.lit(o.lo)) / F.lit(width)), F.lit(0)), F.lit(o.bins - 1))


def kl_windows(df: DataFrame, key: str, order: list[str], x: str,
               o: C.KlOptions = C.KlOptions()) -> DataFrame:
    """``key, win, kl, change`` for every window that has a predecessor."""
    d = row_index(df.select(key, *order, x), key, order)
    d = d.withColumn("win", F.floor((F.col("rn") - 1) / o.window).cast("bigint")).withColumn("_bin", bin_of(F.col(x), o))
    K = o.bins
    counts = d.groupBy(key, "win").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.when(F.col("_bin") == b, 1).otherwise(0)).alias(f"c{b}") for b in range(K)])
    prev = counts.select(key, (F.col("win") + 1).alias("win"), F.col("n").alias("pn"),
                         *[F.col(f"c{b}").alias(f"p{b}") for b in range(K)])
    j = counts.join(prev, [key, "win"], "inner")
    kl, change = _divergence(o)
    return j.select(key, "win", F.round(kl, 6).alias("kl"), change.alias("change"))


def _divergence(o: C.KlOptions) -> tuple[Column, Column]:
    """KL and change flag from the bin counts ``p*`` (of ``pn`` rows) and ``c*`` (of ``n`` rows)."""
    half = 0.5 * o.bins
    terms = []
    for b in range(o.bins):
        p = (F.col(f"p{b}") + 0.5) / (F.col("pn") + half)
        q = (F.col(f"c{b}") + 0.5) / (F.col("n") + half)
        terms.append(p * F.log(p / q))
    kl = terms[0]
    for t in terms[1:]:
        kl = kl + t
    thr = chi2_95(o.bins - 1)
    return kl, (F.lit(2.0 * o.window) * kl > F.lit(thr)) if thr != float("inf") else F.lit(False)


def kl_vector_windows(df: DataFrame, key: str, order: list[str], vec: str, batch: str,
                      o: C.KlOptions = C.KlOptions()) -> DataFrame:
    """``key, win, batch, n_changed, change`` of every full window of vector rows with a predecessor.

    Every feature is binned and compared on its own; the window changes when any
    feature does. ``batch`` is the one of the window's last row (batches follow
    the row order), where the window fills up and is tested. Rows of a key must
    have one length (``operators.state.split_dims``)."""
    d = row_index(df.select(*dict.fromkeys([key, *order, batch, vec])), key, order)
    d = d.withColumn("win", F.floor((F.col("rn") - 1) / o.window).cast("bigint"))
    cells = d.select(key, "win", batch, F.posexplode(vec).alias("_f", "_x")).withColumn("_bin", bin_of(F.col("_x"), o))
    K = o.bins
    counts = cells.groupBy(key, "win", "_f").agg(
        F.count(F.lit(1)).alias("n"), F.max(batch).alias(batch),
        *[F.sum(F.when(F.col("_bin") == b, 1).otherwise(0)).alias(f"c{b}") for b in range(K)]).filter(F.col("n") == o.window)
    prev = counts.select(key, (F.col("win") + 1).alias("win"), "_f", F.col("n").alias("pn"),
                         *[F.col(f"c{b}").alias(f"p{b}") for b in range(K)])
    _, change = _divergence(o)
    j = counts.join(prev, [key, "win", "_f"], "inner").withColumn("_c", change)
    return j.groupBy(key, "win").agg(F.max(batch).alias(batch), F.count_if("_c").alias("n_changed"),
                                     F.bool_or("_c").alias("change"))


def kmeans_cells(ref, k: int):
    """Lloyd's k-means on the rows of ``ref`` (numpy 2-d), started from the
    first ``k`` distinct rows in order (deterministic), until no row changes its
    cell; labels met before (rounding) end it too. Returns the centres."""
    import numpy as np
    seen, init = set(), []
    for row in ref:
        t = tuple(row)
        if t not in seen:
            seen.add(t)
            init.append(row)
        if len(init) == k:
            break
    c = np.array(init, dtype=float)
    met: set[bytes] = set()
    while True:
        lab = ((ref[:, None, :] - c[None, :, :]) ** 2).sum(axis=2).argmin(axis=1)
        if lab.tobytes() in met:
            break
        met.add(lab.tobytes())
        for j in range(len(c)):
            if (lab == j).any():
                c[j] = ref[lab == j].mean(axis=0)
    return c


def kl_cells(ref, cur, k: int, window: int) -> tuple[float, bool]:
    """KL between the cell shares of the reference and the current window over
    the reference's k-means cells (+0.5 smoothing); change when ``2 W KL``
    passes the chi-square quantile with (cells - 1) degrees of freedom."""
    import numpy as np
    c = kmeans_cells(ref, k)
    K = len(c)

    def shares(x):
        lab = ((x[:, None, :] - c[None, :, :]) ** 2).sum(axis=2).argmin(axis=1)
        counts = np.bincount(lab, minlength=K).astype(float)
        return (counts + 0.5) / (len(x) + 0.5 * K)
    p, q = shares(ref), shares(cur)
    kl = float((p * np.log(p / q)).sum())
    return kl, bool(2.0 * window * kl > chi2_95(K - 1))


def kmeans_pairs(ref, cur, n_cur, k: int, window: int):
    """``kl_cells`` of many windows at once: (KL, change) of ``ref`` (windows x W x dim) against ``cur``, of which
    the first ``n_cur`` rows of each count."""
    import numpy as np
    many, W, dim = ref.shape
    same = (ref[:, :, None, :] == ref[:, None, :, :]).all(3)
    new = ~np.tril(same, -1).any(2)                              # first of its value in the window
    nth = np.cumsum(new, 1) - 1
    c = np.full((many, k, dim), np.inf)
    w, i = np.nonzero(new & (nth < k))
    c[w, nth[w, i]] = ref[w, i]
    cells = np.minimum(new.sum(1), k)
    valid = np.arange(k) < cells[:, None]

    def nearest(x, c, valid):
        d = ((x[:, :, None, :] - np.where(valid[:, :, None], c, 0.0)[:, None, :, :]) ** 2).sum(3)
        return np.where(valid[:, None, :], d, np.inf).argmin(2)

    active, met = np.arange(many), []
    while len(active):                   # Lloyd's steps of the windows whose labels still change
        x = ref[active]
        lab = nearest(x, c[active], valid[active])
        seen = np.zeros(len(active), bool)
        for old in met:
            seen |= (old == lab).all(1)
        met = [old[~seen] for old in met] + [lab[~seen]]
        active, x, lab = active[~seen], x[~seen], lab[~seen]
        total, count = np.zeros((len(active), k, dim)), np.zeros((len(active), k))
        rows = np.arange(len(active))
        for i in range(W):               # in row order, as the mean of one window adds
            total[rows, lab[:, i]] += x[:, i]
            count[rows, lab[:, i]] += 1
        hit = count > 0
        moved = c[active]
        moved[hit] = total[hit] / count[hit][:, None]
        c[active] = moved

    def shares(x, n):
        lab = nearest(x, c, valid)
        there = np.arange(x.shape[1]) < n[:, None]
        counts = np.stack([((lab == j) & there).sum(1) for j in range(k)], 1).astype(float)
        return (counts + 0.5) / (n + 0.5 * cells)[:, None]

    p, q = shares(ref, np.full(many, W)), shares(cur, n_cur)
    kl = np.where(valid, p * np.log(p / q), 0.0).sum(1)
    limit = np.array([chi2_95(int(n) - 1) for n in cells])
    return kl, 2.0 * window * kl > limit


GROUP = 512            # windows of a key that one task compares at once


def kl_kmeans_windows(df: DataFrame, key: str, order: list[str], vector: str, o: C.KlOptions = C.KlOptions()) -> DataFrame:
    """``key, win, kl, change`` with cells from k-means of the previous window.

    A key's windows are dealt in groups of ``GROUP``; a group also gets the last
    window of the group before. Each row so moves once, but those at the
    borders twice, and all windows of a group are one numpy problem. Rows of a
    key must have one length.
    """
    import numpy as np
    import pyarrow as pa

    W, K = o.window, o.bins
    d = row_index(df.select(key, *order, vector), key, order)
    d = d.withColumn("win", F.floor((F.col("rn") - 1) / W).cast("bigint"))
    group = F.floor(F.col("win") / GROUP).cast("bigint")
    groups = F.when(F.col("win") % GROUP == GROUP - 1, F.array(group, group + 1)).otherwise(F.array(group))
    rows = d.select(F.explode(groups).alias("_g"), key, "win", "rn", F.col(vector).alias("_v"))
    rows = rows.repartition(key, "_g").sortWithinPartitions(key, "_g", "rn")
    schema = f"{key} string, win long, kl double, change boolean"

    def pairs(rows: pa.Table) -> pa.RecordBatch:
        name, g = rows[key][0], rows["_g"][0].as_py()
        win = rows["win"].to_numpy()
        x = rows["_v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(win), -1)
        first = int(win[0])
        at = np.zeros((int(win[-1]) - first + 1, W, x.shape[1]))
        at[win - first, (rows["rn"].to_numpy() - 1) % W] = x
        n = np.bincount(win - first, minlength=len(at))
        cur = np.arange(max(1, g * GROUP - first), len(at))          # windows of the group that have one before
        kl, change = kmeans_pairs(at[cur - 1], at[cur], n[cur], K, W)
        return pa.RecordBatch.from_arrays([pa.array([name.as_py()] * len(cur), pa.string()), pa.array(cur + first), pa.array(np.round(kl, 6)),
                                           pa.array(change)], names=[key, "win", "kl", "change"])

    def run(batches):
        held: list[pa.RecordBatch] = []
        last = None
        for b in batches:
            ks = list(zip(b.column(key).to_pylist(), b.column("_g").to_pylist()))
            a = 0
            for i in range(len(ks) + 1):
                if i < len(ks) and ks[i] == last:
                    continue
                if i > a:
                    held.append(b.slice(a, i - a))
                if i < len(ks):
                    if held:
                        yield pairs(pa.Table.from_batches(held))
                    held, last, a = [], ks[i], i
        if held:
            yield pairs(pa.Table.from_batches(held))

    return rows.mapInArrow(run, schema)


class KlKmeansRows:
    """Streaming face of the k-means KL detector: keeps the previous and the
    current window (at most ``2 W`` rows, bounded state) and tests when the
    current window completes; its warning answers the change flag."""

    vector = True
    __slots__ = ("window", "cells", "prev", "cur", "req")

    def __init__(self, window: int = 10, cells: int = 5):
        C.KlOptions(window=window, bins=cells)          # range checks
        self.window, self.cells = window, cells
        self.prev, self.cur, self.req = [], [], 0

    def step(self, row):
        import numpy as np
        if len(row) == 0:                   # a row without features is not a point
            return False, False
        self.cur.append([float(v) for v in row])
        if len(self.cur) < self.window:
            return False, False
        hit = False
        if self.prev and len({len(r) for r in self.prev + self.cur}) == 1:
            _, hit = kl_cells(np.array(self.prev), np.array(self.cur), self.cells, self.window)
        self.prev, self.cur = self.cur, []
        return hit, hit

    def fits(self, rows) -> bool:
        """Whether all non-empty rows have the dimension of the windows so far."""
        sizes = {len(r) for r in rows if len(r)} | {len(r) for r in (self.prev + self.cur)[:1]}
        return len(sizes) <= 1

    def end_request(self):
        self.req += 1

    def dump(self) -> list[float]:
        rows = self.prev + self.cur
        return ([float(len(self.prev)), float(len(self.cur))] + [float(len(r)) for r in rows]
                + [v for r in rows for v in r])

    def load(self, v) -> None:
        npv, n = int(v[0]), int(v[0]) + int(v[1])
        rows, at = [], 2 + n
        for size in v[2:2 + n]:
            rows.append(list(v[at:at + int(size)]))
            at += int(size)
        self.prev, self.cur = rows[:npv], rows[npv:]
