"""Hard negatives by exact integer scores from float32 matrix products.

A component modulo a small prime lies between -p/2 and p/2, so that sums of
some products of such residues stay below 2^24 and a float32 matrix product is
exact. The products modulo several primes give the signed score by Chinese
remaindering in balanced mixed radix, as long as twice the largest possible
score is below the primes' product; the number of primes follows from the
vectors at hand.

Anchors stand in blocks, all rows in shards by row number. Each (block, shard)
is a cell that one task works on: it holds the block and reads the shard in
tiles. A first pass finds each anchor's positives, a second the rows in the
windows that these positives open.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.session import scratch_path

SHARD_ROWS = 16_384
BLOCK_ROWS = 2_048
TILE_ROWS = 1_024      # rows scored against a block at a time
MOST_TASKS = 20_000    # cells beyond this number share tasks
_LONG = 1 << 63


def primes() -> Iterator[int]:
    """Odd primes below 1,024 from the largest, then those up to 4,096 for components of any size."""
    prime = lambda p: all(p % q for q in range(2, math.isqrt(p) + 1))
    yield from filter(prime, range(1023, 2, -2))
    yield from filter(prime, range(1025, 4096, 2))


def moduli(bound: int) -> list[int]:
    """Primes whose product tells all scores from -bound to bound."""
    out, product = [], 1
    for p in primes():
        if product > 2 * bound:
            break
        out.append(p)
        product *= p
    return out


def balanced(x: np.ndarray, p: int) -> np.ndarray:
    """Whole float32 numbers below 2^24 - p, modulo p, from -p/2 to p/2."""
    return x - np.float32(p) * np.rint(x * np.float32(1.0 / p))


def residues(x: np.ndarray, p: int) -> np.ndarray:
    """Whole doubles of any size modulo p, as float32 from -p/2 to p/2."""
    return balanced(np.fmod(x, p).astype(np.float32), p)


def modular_product(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """Products of the rows of a and b modulo p, both given by their residues."""
    step = max(1, ((1 << 24) - 2 * p) // (p // 2 + 1) ** 2)   # so many products keep a float32 sum exact
    total = np.zeros((len(a), len(b)), np.float32)
    for i in range(0, a.shape[1], step):
        total = balanced(total + a[:, i:i + step] @ b[:, i:i + step].T, p)
    return total


def reconstruct(parts: list[np.ndarray], ms: list[int], exact: bool) -> np.ndarray:
    """Signed whole numbers from their balanced residues (Garner): int64, or Python integers where ``exact``."""
    digits: list[np.ndarray] = []
    value, weight = None, 1
    for j, (r, p) in enumerate(zip(parts, ms)):
        w = 1
        for d, q in zip(digits, ms[:j]):
            r = balanced(r - balanced(d * np.float32(w), p), p)
            w = w * q % p
        if j:
            r = balanced(r * np.float32(pow(w, -1, p)), p)
        digits.append(r)
        big = r.astype(np.int64)
        big = big.astype(object) * weight if exact else big * weight
        value = big if value is None else value + big
        weight *= p
    return value


def _bound(a: np.ndarray, b: np.ndarray) -> int:
    """No product of a row of a and one of b is larger."""
    with np.errstate(over="ignore"):
        norm = math.sqrt((a * a).sum(1).max()) * math.sqrt((b * b).sum(1).max()) * 1.000001
    plain = int(np.abs(a).max()) * int(np.abs(b).max()) * a.shape[1]
    return min(plain, math.ceil(norm)) if math.isfinite(norm) else plain


def scores(a: np.ndarray, b: np.ndarray, fits: bool) -> np.ndarray:
    """Exact inner products of the rows of two matrices of whole doubles over their common columns.

    ``fits``: all lie in int64; else Python integers come back, those beyond a long as its ends.
    """
    dim = min(a.shape[1], b.shape[1])
    a, b = a[:, :dim], b[:, :dim]
    if not dim or not len(a) or not len(b):
        return np.zeros((len(a), len(b)), np.int64 if fits else object)
    ms = moduli(_bound(a, b))
    if not ms:
        ms = [next(primes())]
    value = reconstruct([modular_product(residues(a, p), residues(b, p), p) for p in ms], ms, not fits)
    return value if fits else np.minimum(np.maximum(value, -_LONG), _LONG - 1)


class Rows:
    """Some rows of a cell: vectors, ids, labels, row numbers; ``place``: their order by id within the cell."""

    def __init__(self, batches: list[pa.RecordBatch], at: int = 0):
        t = pa.Table.from_batches(batches)
        raw = t["x"].to_pylist()
        n = [len(r) // 8 for r in raw]
        self.x = np.zeros((len(raw), max(n, default=0)))
        if min(n, default=0) == self.x.shape[1]:
            self.x = np.frombuffer(b"".join(raw), np.float64).reshape(self.x.shape)
        else:
            for i, r in enumerate(raw):
                self.x[i, :n[i]] = np.frombuffer(r, np.float64)
        self.row, self.label = t["row"].to_numpy(), t["label"].to_numpy()
        self.id = t["id"].combine_chunks()
        self.place = np.arange(at, at + len(raw))
        self.windows = t["positives"].to_pylist()
        self.most = np.abs(self.x).max(1, initial=0.0)

    def __len__(self) -> int:
        return len(self.row)


WIDE = 1 << 20        # keys: score * WIDE - place; rows are dealt by hash, a shard is a small part of this


def narrow(most: np.ndarray, dim: int) -> np.ndarray:
    """Vectors so small that the keys of their scores among each other fit in int64."""
    return most <= math.sqrt((1 << 41) / max(dim, 1))


def _parts(mask: np.ndarray) -> Iterator[tuple[np.ndarray, bool]]:
    for side in (True, False):
        at = np.flatnonzero(mask == side)
        if len(at):
            yield at, side


def _keys(block: Rows, tile: Rows, anchors: np.ndarray, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(anchors, rows, score keys): small vectors in int64, the rest in Python integers."""
    dim = max(block.x.shape[1], tile.x.shape[1])
    for a, a_small in _parts(narrow(block.most[anchors], dim)):
        for b, b_small in _parts(narrow(tile.most[rows], dim)):
            fits = a_small and b_small
            s = scores(block.x[anchors[a]], tile.x[rows[b]], fits)
            yield anchors[a], rows[b], s * WIDE - tile.place[rows[b]].astype(np.int64 if fits else object)


def _first(owner: np.ndarray, key: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest keys of each owner."""
    order = np.argsort(-key, kind="stable")
    order = order[np.argsort(owner[order], kind="stable")]
    own = owner[order]
    start = np.concatenate([[0], np.flatnonzero(own[1:] != own[:-1]) + 1]) if len(own) else np.zeros(0, np.int64)
    nth = np.arange(len(own)) - np.repeat(start, np.diff(np.append(start, len(own))))
    return order[nth < k]


class Best:
    """The k highest (key, id) of each owner so far."""

    def __init__(self, k: int):
        self.k, self.owner, self.key, self.id = k, np.zeros(0, np.int64), np.zeros(0, np.int64), pa.array([], pa.int64())

    def add(self, owner: np.ndarray, key: np.ndarray, ids: pa.Array) -> None:
        owner, key = np.concatenate([self.owner, owner]), np.concatenate([self.key, key])
        ids = pa.concat_arrays([self.id, ids])
        keep = _first(owner, key, self.k)
        self.owner, self.key, self.id = owner[keep], key[keep], ids.take(pa.array(keep))

    def score(self) -> pa.Array:
        return pa.array([-(-int(k) // WIDE) for k in self.key], pa.int64())


def _highest(keys: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k highest keys of each row of a matrix."""
    n, m = keys.shape
    if m > k and keys.dtype != object:
        col = np.argpartition(-keys, k - 1, axis=1)[:, :k]
    else:
        col = np.argsort(-keys, axis=1, kind="stable")[:, :k]
    return np.repeat(np.arange(n), col.shape[1]), col.ravel()


def _same_label(block: Rows, tile: Rows, best: Best) -> None:
    for label in np.intersect1d(block.label, tile.label):
        for a, b, keys in _keys(block, tile, np.flatnonzero(block.label == label), np.flatnonzero(tile.label == label)):
            r, c = _highest(keys, best.k + 1)                   # one may be the anchor itself
            other = block.row[a[r]] != tile.row[b[c]]
            r, c = r[other], c[other]
            best.add(a[r], keys[r, c], tile.id.take(pa.array(b[c])))


def _in_windows(block: Rows, tile: Rows, best: Best, slots: int, low: np.ndarray, high: np.ndarray) -> None:
    for a, b, keys in _keys(block, tile, np.arange(len(block)), np.arange(len(tile))):
        score = -(-keys // WIDE)
        least, most = low[a].min(1), high[a].max(1)
        r, c = np.nonzero((score >= least[:, None]) & (score <= most[:, None]) & (block.label[a][:, None] != tile.label[b][None, :]))
        s = score[r, c]
        for k in range(slots):
            hit = np.flatnonzero((s >= low[a[r], k]) & (s <= high[a[r], k]))
            hit = hit[_first(r[hit], keys[r[hit], c[hit]], best.k)]
            best.add(a[r[hit]] * slots + k, keys[r[hit], c[hit]], tile.id.take(pa.array(b[c[hit]])))


def cells(batches: Iterator[pa.RecordBatch], tile_rows: int) -> Iterator[tuple[Rows, Iterator[Rows]]]:
    """(block, tiles of the shard) of each cell; rows come by cell, anchors first, then by id."""

    def pieces():
        for batch in batches:
            cell, anchor = batch.column("cell").to_numpy(), batch.column("side").to_numpy()
            cut = np.flatnonzero((cell[1:] != cell[:-1]) | (anchor[1:] != anchor[:-1])) + 1
            for i, j in zip([0, *cut.tolist()], [*cut.tolist(), len(cell)]):
                if j > i:
                    yield (int(cell[i]), int(anchor[i])), batch.slice(i, j - i)

    def tiles(parts):
        held, n, at = [], 0, 0
        for _, b in parts:
            while len(b):
                some = b.slice(0, tile_rows - n)
                b = b.slice(len(some))
                held.append(some)
                n += len(some)
                if n == tile_rows:
                    yield Rows(held, at)
                    at, held, n = at + n, [], 0
        if held:
            yield Rows(held, at)

    block = None
    for (cell, side), parts in groupby(pieces(), key=lambda p: p[0]):
        if side == 0:
            block = (cell, Rows([b for _, b in parts]))
        elif block is not None and block[0] == cell:
            yield block[1], tiles(parts)


def sound_vectors(vectors: DataFrame, id: str, label: Column, values: str, is_anchor: Column, scale: float) -> DataFrame:
    """row, id, label, anchor, x (whole doubles, packed) of the rows that take part."""
    rows = vectors.where(label.isNotNull() & F.col(values).isNotNull()).select(
        F.monotonically_increasing_id().alias("row"), F.col(id).cast("long").alias("id"), label.cast("long").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"), F.col(values).cast("array<double>").alias("v"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column("v")
            ends = np.concatenate([[0], np.cumsum(pc.list_value_length(v).to_numpy())])
            with np.errstate(over="ignore", invalid="ignore"):
                x = np.floor(v.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
            upto = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
            keep = np.flatnonzero(upto[ends[1:]] == upto[ends[:-1]])
            some = b.select(["row", "id", "label", "anchor"]).take(pa.array(keep))
            packed = pa.array([x[ends[i]:ends[i + 1]].tobytes() for i in keep.tolist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*some.columns, packed], names=["row", "id", "label", "anchor", "x"])

    return rows.mapInArrow(pack, "row long, id long, label long, anchor boolean, x binary")


def deal(anchors: DataFrame, rows: DataFrame, shards: int, blocks: int) -> DataFrame:
    """Rows by (shard, block) cell, a cell's anchors first (side 0), then the shard's rows by id (side 1).

    Shards and blocks go by the hash of the row number, so they are about even
    whatever the ids; cells go to tasks by their number.
    """
    block, shard = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)), F.pmod(F.xxhash64("row"), F.lit(shards))
    a = anchors.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn("cell", F.col("shard") * blocks + block)
    r = rows.withColumn("positives", F.lit(None).cast("array<long>")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn(
        "cell", shard * blocks + F.col("block"))
    cols = ["row", "id", "label", "x", "positives", F.col("cell").cast("long")]
    both = a.select(*cols, F.lit(0).alias("side")).unionByName(r.select(*cols, F.lit(1).alias("side")))
    tasks = min(shards * blocks, MOST_TASKS)
    return both.repartitionById(tasks, F.pmod(F.col("cell"), F.lit(tasks)).cast("int")).sortWithinPartitions(
        "cell", "side", F.col("id").asc_nulls_last(), "row")


def mine(vectors: DataFrame, is_anchor: Column, label: Column, id: str = "vec_id", values: str = "embedding", scale: float = 256.0,
         positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components become floor(scale * x). An anchor's positives are the
    ``positives`` highest-scoring other rows of its label; for each of them
    the ``negatives`` highest-scoring rows of another label whose score is
    from ``low`` to ``high`` per cent of the positive's are returned. Ties go
    to the smaller id, null ids last. Anchors without positives, and
    positives without such negatives, give no rows.

    Rows with a null label or vector, or a component that is null, not finite
    or too large for a double once scaled, take no part. Repeated rows are
    rows of their own: each is an anchor and a candidate, only the anchor's own row
    is left out. Missing components of a shorter vector count as zero. A
    score beyond a long counts as the nearest long. An empty table gives no
    rows; other columns are not read.
    """
    spark = vectors.sparkSession
    path = scratch_path(spark, "vectors")
    sound_vectors(vectors, id, label, values, is_anchor, scale).write.parquet(path)    # row numbers are fixed here
    rows = spark.read.parquet(path)
    n, n_anchors = rows.agg(F.count("*"), F.coalesce(F.sum(F.col("anchor").cast("long")), F.lit(0))).first()
    shards, blocks = max(1, -(-n // SHARD_ROWS)), max(1, -(-n_anchors // BLOCK_ROWS))
    none = F.lit(None).cast("array<long>")
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, tiles in cells(batches, TILE_ROWS):
            best = Best(positives)
            for tile in tiles:
                _same_label(block, tile, best)
            yield pa.RecordBatch.from_arrays([pa.array(block.row[best.owner]), block.id.take(pa.array(best.owner)), best.score(), best.id],
                                             names=["row", "anchor_id", "score", "id"])

    anchors = rows.where("anchor")
    found = deal(anchors.withColumn("positives", none), rows, shards, blocks).mapInArrow(find, "row long, anchor_id long, score long, id long")
    nearest = Window.partitionBy("row").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    found = found.withColumn("nth", F.row_number().over(nearest)).where(F.col("nth") <= positives)
    path = scratch_path(spark, "positives")
    found.write.parquet(path)
    found = spark.read.schema(found.schema).parquet(path)
    opened = anchors.join(found.groupBy("row").agg(F.transform(F.array_sort(F.collect_list(F.struct("nth", "score"))), lambda s: s["score"]).alias("positives")),
                          "row")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, tiles in cells(batches, TILE_ROWS):
            lows = np.full((len(block), positives), _LONG - 1, np.int64)      # no window: nothing is in it
            highs = np.full((len(block), positives), -_LONG, np.int64)
            for i, ps in enumerate(block.windows):
                for k, p in enumerate(ps):
                    if low * p <= high * p:                                   # negative scores open no window
                        lows[i, k], highs[i, k] = -(-low * p // 100), high * p // 100
            best = Best(negatives)
            for tile in tiles:
                _in_windows(block, tile, best, positives, lows, highs)
            yield pa.RecordBatch.from_arrays([pa.array(block.row[best.owner // positives]), pa.array((best.owner % positives + 1).astype(np.int32)),
                                              best.score(), best.id], names=["row", "nth", "negative_score", "negative_id"])

    hits = deal(opened, rows, shards, blocks).mapInArrow(search, "row long, nth int, negative_score long, negative_id long")
    hardest = Window.partitionBy("row", "nth").orderBy(F.desc("negative_score"), F.col("negative_id").asc_nulls_last())
    hits = hits.withColumn("rank", F.row_number().over(hardest)).where(F.col("rank") <= negatives)
    return hits.join(found, ["row", "nth"]).select("anchor_id", F.col("id").alias("positive_id"), "rank", "negative_id",
                                                   F.col("score").alias("positive_score"), "negative_score")
