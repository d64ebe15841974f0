"""Exact top-k by inner product with MaxScore over sharded postings.

A vector of whole numbers is a set of signed terms: dimension i with its
positive or its negative part, the impact being the size. A query weighs each
term by its own component; terms of the other sign weigh negatively and can
raise no score. Shards hold postings by term, with the highest impact of each
list in each tile of rows. For a query and a tile the terms with positive
weights are sorted by their bounds (weight times highest impact). The lowest
whose sum stays below the query's threshold, its k-th score so far, are
non-essential: a row with no others cannot compete. Only the lists of the
essential terms are traversed; the other terms are probed, the most lowering
ones first, for the rows that can still reach the threshold. The threshold
rises from tile to tile; the shards' results merge by rank.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.hard_negatives import WIDE, Best, Rows, cells, deal, narrow, sound_vectors
from tidewatch.session import scratch_path

SHARD_ROWS = 16_384
BLOCK_ROWS = 2_048
TILE_ROWS = 4_096
PROBE_TERMS = 16
_LONG = 1 << 63


class Postings:
    """Lists of one tile by term (first the positive parts, then the negative ones), and each list's highest impact."""

    def __init__(self, x: np.ndarray, weight: float):
        """``weight``: the largest component of a query; sums are exact in the type chosen."""
        kind = np.float32 if x.shape[1] * np.abs(x).max(initial=0.0) * weight < 2 ** 24 else np.float64
        self.x = x
        self.lists = np.ascontiguousarray(np.concatenate([np.maximum(x, 0.0), np.maximum(-x, 0.0)], axis=1).T.astype(kind))
        self.most = self.lists.max(1, initial=0.0).astype(np.float64)
        self.mean = self.lists.mean(1, dtype=np.float64) if len(x) else self.most

    def _sum(self, terms: np.ndarray, weights: np.ndarray, rows: np.ndarray | None) -> np.ndarray:
        """Weighted sums over lists, for some rows."""
        w = weights[terms].astype(self.lists.dtype)
        if rows is None:
            return w @ self.lists[terms]
        if 4 * len(rows) > self.lists.shape[1]:
            return (w @ self.lists[terms])[rows]
        return w @ self.lists[np.ix_(terms, rows)]

    def search(self, query: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, int]:
        """(rows, scores) of at least ``threshold``, and how many rows were probed."""
        weights = np.concatenate([query, -query])
        up = np.flatnonzero((weights > 0) & (self.most > 0))
        bounds = weights[up] * self.most[up]
        order = np.argsort(bounds)
        up, upto = up[order], np.cumsum(bounds[order])
        n = int(np.searchsorted(upto, threshold)) if threshold > 0 else 0     # these cannot reach it together
        rest, essential = up[:n], up[n:]
        slack = float(upto[n - 1]) if n else 0.0
        score = self._sum(essential, weights, None) if len(essential) else np.zeros(self.lists.shape[1])
        rows = np.flatnonzero(score + slack >= threshold)
        probed, score = len(rows), score[rows].astype(np.float64)
        down = np.flatnonzero((weights < 0) & (self.most > 0))
        down = down[np.argsort(weights[down] * self.mean[down])]
        for i in range(0, len(down), PROBE_TERMS):
            if not len(rows):
                return rows, score, probed
            score = score + self._sum(down[i:i + PROBE_TERMS], weights, rows)
            alive = score + slack >= threshold
            rows, score = rows[alive], score[alive]
        while len(rest) and len(rows):
            some, rest = rest[-PROBE_TERMS:], rest[:-PROBE_TERMS]
            slack = float(upto[len(rest) - 1]) if len(rest) else 0.0
            score = score + self._sum(some, weights, rows)
            alive = score + slack >= threshold
            rows, score = rows[alive], score[alive]
        return rows, score, probed


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products in Python integers, those beyond a long as its ends; for the few rows too large for doubles."""
    whole = np.vectorize(int, otypes=[object])
    dim = min(a.shape[1], b.shape[1])
    if not dim:
        return np.zeros((len(a), len(b)), object)
    return np.minimum(np.maximum(whole(a[:, :dim]) @ whole(b[:, :dim]).T, -_LONG), _LONG - 1)


def _highest(score: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores and of all that tie with the last."""
    if len(score) <= k:
        return np.arange(len(score))
    return np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])


def search_tile(block: Rows, tile: Rows, best: Best, small: np.ndarray) -> int:
    """Adds a tile's rows to the block's results; rows probed. ``small``: queries whose products with small rows fit in doubles."""
    dim = min(block.x.shape[1], tile.x.shape[1])
    fits = narrow(tile.most, max(block.x.shape[1], tile.x.shape[1]))
    owners, keys, rows, probed = [], [], [], 0

    def found(q: int, at: np.ndarray, score: np.ndarray) -> None:
        other = tile.row[at] != block.row[q]
        at, score = at[other], score[other]
        top = _highest(score, at, best.k) if score.dtype != object else np.arange(len(score))
        owners.append(np.full(len(top), q))
        keys.append(score[top].astype(score.dtype if score.dtype == object else np.int64) * WIDE - tile.place[at[top]].astype(
            object if score.dtype == object else np.int64))
        rows.append(at[top])

    sound = np.flatnonzero(fits)
    postings = Postings(tile.x[sound][:, :dim], block.most[small].max()) if len(sound) and small.any() else None
    threshold = best.thresholds(len(block))
    for q in np.flatnonzero(small).tolist() if postings is not None else ():
        at, score, n = postings.search(block.x[q, :dim], threshold[q])
        probed += n
        found(q, sound[at], score)
    wide = np.flatnonzero(~fits)
    for q in range(len(block)):
        at = wide if small[q] else np.arange(len(tile))
        if len(at):
            found(q, at, _exact(block.x[q:q + 1], tile.x[at])[0])
    if owners:
        best.add(np.concatenate(owners), np.concatenate(keys), tile.id.take(pa.array(np.concatenate(rows))))
    return probed


class Results(Best):
    def thresholds(self, n: int) -> np.ndarray:
        """Each owner's k-th score so far; minus infinity while it has fewer."""
        out = np.full(n, -np.inf)
        count = np.bincount(self.owner, minlength=n)
        last = np.cumsum(count) - 1                    # entries are by owner, the highest first
        for q in np.flatnonzero(count >= self.k):
            out[q] = float(-(-int(self.key[last[q]]) // WIDE))
        return out


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, id: str = "vec_id", values: str = "embedding", scale: float = 64.0) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` highest inner products of each query with all other rows.

    Components become floor(scale * x), ``is_query`` marks the queries. Ties go
    to the smaller id, null ids last. Only the query's own row is no candidate
    of it: repeated rows, and others of its id, are rows of their own. Rows with
    a null vector, or a component that is null, not finite or too large for a
    double once scaled, take no part; missing components of a shorter vector
    count as zero. Scores are exact; one beyond a long counts as the nearest
    long. Fewer rows than ``k`` give fewer results, an empty table none. Other
    columns are not read.

    Every block of queries meets every shard of rows (a stated query set
    against all rows); a shard returns at most k rows a query.
    """
    spark = vectors.sparkSession
    path = scratch_path(spark, "vectors")
    sound_vectors(vectors, id, F.lit(0), values, is_query, scale).write.parquet(path)     # row numbers are fixed here
    rows = spark.read.parquet(path)
    n, n_queries = rows.agg(F.count("*"), F.coalesce(F.sum(F.col("anchor").cast("long")), F.lit(0))).first()
    shards, blocks = max(1, -(-n // SHARD_ROWS)), max(1, -(-n_queries // BLOCK_ROWS))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, tiles in cells(batches, TILE_ROWS):
            best = Results(k)
            small = narrow(block.most, block.x.shape[1])
            for tile in tiles:
                search_tile(block, tile, best, small)
            yield pa.RecordBatch.from_arrays([pa.array(block.row[best.owner]), block.id.take(pa.array(best.owner)), best.id, best.score()],
                                             names=["row", "query_id", id, "score"])

    queries = rows.where("anchor").withColumn("positives", F.lit(None).cast("array<long>"))
    found = deal(queries, rows, shards, blocks).mapInArrow(search, f"row long, query_id long, `{id}` long, score long")
    highest = Window.partitionBy("row").orderBy(F.desc("score"), F.col(id).asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(highest)).where(F.col("rank") <= k).select("query_id", "rank", id, "score")
