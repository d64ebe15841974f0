"""Near-duplicate vectors: an exact range join in the angle metric by pivots and boundary replication."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.graph import components, cut

THRESHOLD = 0.95
PIVOTS = 64  # at most; they come from a bounded sample by hash order
CELL_ROWS = 8_192  # rows of a cell that share one pivot, and of a block of a larger cell
SLACK = 1e-9
COLUMNS = 512
MARGIN = 1e-4      # more than a single-precision cosine of up to ten thousand components is off


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1))[:, None]


class Side:
    """Rows of a comparison: as they came, with length one, and that in single precision."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.unit = _unit(vectors)
        self.short = self.unit.astype(np.float32)


def _linked(a: Side, b: Side, some: slice, threshold: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Rows of ``some`` of b that link, and the matrix of their links with a; None if there are none.

    Single precision (off by less than ``MARGIN``) rules out rows without a
    link. The others are computed in double precision, and pairs within
    rounding of the threshold again with exact sums.
    """
    c = a.short @ b.short[some].T
    if not len(c) or c.max() < threshold - MARGIN:
        return None
    cols = np.flatnonzero(c.max(0) >= threshold - MARGIN) + some.start
    c = a.unit @ b.unit[cols].T
    hit = c >= threshold
    for i, j in zip(*np.nonzero(np.abs(c - threshold) < 1e-12), strict=True):
        x, y = a.vectors[i].tolist(), b.vectors[cols[j]].tolist()
        dot = math.fsum(p * q for p, q in zip(x, y, strict=True))
        hit[i, j] = dot / math.sqrt(math.fsum(p * p for p in x) * math.fsum(q * q for q in y)) >= threshold
    any_ = hit.any(0)
    return (cols[any_], hit[:, any_]) if any_.any() else None


class Block:
    """Home rows of a cell: their links and the groups that links make, as rows stream past."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, angles: np.ndarray, weights: np.ndarray, threshold: float):
        self.ids, self.rows, self.threshold = ids, Side(vectors), threshold
        self.near, self.far = angles.min(), angles.max()
        self.links = np.zeros(len(ids), np.int64)
        self.root = np.arange(len(ids))
        self.radius = math.acos(threshold) + SLACK

    def _find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = self.root[i]
        return i

    def take(self, ids: np.ndarray, vectors: np.ndarray, angles: np.ndarray, weights: np.ndarray) -> list[tuple[int, int]]:
        """Compare rows with the block; returns one edge (row, home row) for each row that links."""
        edges = []
        able = np.flatnonzero((angles >= self.near - self.radius) & (angles <= self.far + self.radius))  # triangle inequality
        if not len(able):
            return edges
        ids, weights, side = ids[able], weights[able], Side(vectors[able])
        for i in range(0, len(able), COLUMNS):
            got = _linked(self.rows, side, slice(i, min(i + COLUMNS, len(able))), self.threshold)
            if got is None:
                continue
            cols, hit = got
            self.links += hit @ weights[cols]
            first = hit.argmax(0)
            edges += [(int(x), int(y)) for x, y in zip(ids[cols], self.ids[first], strict=True) if x != y]
            many = np.flatnonzero(hit.sum(0) > 1)
            if len(many):
                roots = np.array([self._find(x) for x in range(len(self.ids))])
                r, c = np.nonzero(hit[:, many])
                pairs = np.unique(roots[first[many[c]]] * len(roots) + roots[r])
                for p in pairs.tolist():
                    a, b = self._find(p // len(roots)), self._find(p % len(roots))
                    if a != b:
                        self.root[max(a, b)] = min(a, b)
        return edges

    def end(self) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
        """(edges between home rows of a group, (id, links) of home rows)."""
        return ([(int(self.ids[i]), int(self.ids[r])) for i in range(len(self.ids)) if (r := self._find(i)) != i],
                list(zip(self.ids.tolist(), self.links.tolist(), strict=True)))


def join_vectors(vectors: DataFrame, threshold: float = THRESHOLD, id: str = "vec_id", values: str = "embedding") -> DataFrame:
    """Links of every vector: (id, n_links, component, kept).

    Two rows link if the cosine of their vectors is at least ``threshold``
    (above 0), in double precision. Every vector's home is the cell of its
    nearest pivot. Angles are a metric, so a vector is copied to another cell
    only where its angle to that pivot exceeds the one to its own by no more
    than twice the radius arccos(threshold), and is no more than the radius
    beyond the cell's reach; each cell then finds all links of its home rows
    by itself. Home rows of a large cell are dealt into blocks, which stream
    the cell's rows. On data without neighbourhoods (random directions) all
    vectors reach all cells, and the join becomes blocks against all rows.

    Rows with equal vectors join as one with their number. A row that is null,
    zero or holds null or non-finite components links with nothing and is its
    own component, as do vectors of different lengths among each other. A null
    id is no smallest one: a component has one only if all its ids are null.
    Repeated ids are separate rows, counted as links. An empty table gives an empty result; other columns are ignored.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[id].dataType.simpleString()
    rows = vectors.select(F.col(id).cast("long").alias("id"), F.transform(values, lambda x: x.cast("double")).alias("v"))
    big = F.lit(1.7976931348623157e308)
    sound = (F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) > big))
             & F.exists("v", lambda x: x != 0))
    sound = F.coalesce(sound, F.lit(False))
    # one row for equal vectors: its smallest id, and how many
    classes = cut(rows.where(sound).groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("n")))
    # an id may own several classes: number links by class through the vector itself
    classes = cut(classes.withColumn("class", F.xxhash64("id", "v")))
    n = classes.count()
    dims = [r["d"] for r in classes.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(64).collect()]
    some = min(PIVOTS, max(1, -(-n // CELL_ROWS)))
    pivots: dict[int, np.ndarray] = {}
    for d in dims[:1]:
        got = classes.where(F.size("v") == d).orderBy(F.xxhash64("class", F.lit(3)), "class").limit(some).select("v").collect()
        pivots[d] = _unit(_scaled(np.array([r["v"] for r in got], np.float64)))
    shared = spark.sparkContext.broadcast(pivots)  # at most PIVOTS vectors
    radius = math.acos(threshold) + SLACK

    def angles_of(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(rows, vectors, angles to the pivots) of the rows of each length."""
        v = b.column("v")
        sizes = pa.compute.list_value_length(v).to_numpy()
        for d in np.unique(sizes):
            at = np.flatnonzero(sizes == d)
            x = _scaled(v.take(pa.array(at)).flatten().to_numpy().reshape(len(at), d))
            p = shared.value.get(int(d))
            yield at, x, np.arccos(np.clip(_unit(x) @ p.T, -1, 1)) if p is not None else np.zeros((len(at), 1))

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, x, a in angles_of(b):
                own = a.argmin(1)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), x.shape[1])), pa.array(own), pa.array(a.min(1))], names=["d", "cell", "reach"])

    cells = classes.select("v").mapInArrow(homes, "d long, cell long, reach double").groupBy("d", "cell").agg(
        F.count("*").alias("n"), F.max("reach").alias("reach")).collect()  # pivots x lengths
    reached, tasks = {}, 0           # by cell: reach, blocks, number of the first block
    for r in sorted(cells, key=lambda r: (r["d"], r["cell"])):
        blocks = max(1, -(-r["n"] // CELL_ROWS))
        reached[r["d"], r["cell"]] = (r["reach"], blocks, tasks)
        tasks += blocks
    reach = spark.sparkContext.broadcast(reached)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key, w = b.column("class").to_numpy(), b.column("n").to_numpy()
            for at, x, a in angles_of(b):
                d = x.shape[1]
                own = a.argmin(1)
                low = a[np.arange(len(at)), own]
                packed = np.array([r.tobytes() for r in np.ascontiguousarray(x)], object)
                for cell in range(a.shape[1]):
                    if (d, cell) not in reach.value:
                        continue
                    far, blocks, nth = reach.value[d, cell]
                    here = np.flatnonzero((own == cell) | ((a[:, cell] - low <= 2 * radius) & (a[:, cell] <= far + radius)))
                    if not len(here):
                        continue
                    home = own[here] == cell
                    mine = (key[at[here]].view(np.uint64) % np.uint64(blocks)).astype(np.int64)
                    for block in range(blocks):
                        is_home = home & (mine == block)
                        # home rows go first, then all rows of the cell stream past them
                        for first, take in ((0, is_home), (1, np.ones(len(here), bool))):
                            t = here[take]
                            if len(t):
                                yield pa.RecordBatch.from_arrays(
                                    [pa.array(np.full(len(t), nth + block)), pa.array(np.full(len(t), d)), pa.array(np.full(len(t), first, np.int8)), pa.array(key[at[t]]),
                                     pa.array(a[t, cell]), pa.array(w[at[t]]), pa.array(packed[t].tolist(), pa.binary())],
                                    names=["cell", "d", "turn", "class", "angle", "n", "v"])

    dealt = classes.mapInArrow(deal, "cell long, d long, turn byte, class long, angle double, n long, v binary")
    parts = max(1, min(tasks, 20_000))
    dealt = dealt.repartitionById(parts, F.pmod("cell", F.lit(parts)).cast("int")).sortWithinPartitions("cell", "turn", "angle")

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, block, held = None, None, []

        def out(edges: list, counts: list) -> pa.RecordBatch:
            u = [e[0] for e in edges] + [c[0] for c in counts]
            v = [e[1] for e in edges] + [None] * len(counts)
            m = [0] * len(edges) + [c[1] for c in counts]
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(m, pa.int64())], names=["u", "v", "m"])

        for b in batches:
            cell, turn = b.column("cell").to_numpy(), b.column("turn").to_numpy()
            for c in np.unique(cell):
                for t in (0, 1):
                    rows_ = np.flatnonzero((cell == c) & (turn == t))
                    if not len(rows_):
                        continue
                    if c != at:
                        if block is not None:
                            yield out(*block.end())
                        at, block, held = c, None, []
                    d = int(b.column("d")[int(rows_[0])].as_py())
                    part = [b.column("class").to_numpy()[rows_], np.frombuffer(b"".join(b.column("v").take(pa.array(rows_)).to_pylist())).reshape(-1, d),
                            b.column("angle").to_numpy()[rows_], b.column("n").to_numpy()[rows_]]
                    if t == 0:
                        held.append(part)
                        continue
                    if block is None:
                        if not held:
                            continue
                        block = Block(*[np.concatenate([h[i] for h in held]) for i in range(4)], threshold)
                        held = []
                    if edges := block.take(*part):
                        yield out(edges, [])
        if block is not None:
            yield out(*block.end())

    found = cut(dealt.mapInArrow(links, "u long, v long, m long"))
    counts = found.where("v is null").select(F.col("u").alias("class"), F.col("m").alias("links"))
    parts = components(found.where("v is not null").select("u", "v"))
    named = (classes.join(parts.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class")))
    least = named.groupBy("component").agg(F.min("id").alias("component_id"))
    result = (named.join(least, "component").join(counts, "class")
              .select("v", F.col("links").alias("links"), "component_id"))
    good = rows.where(sound).join(result, "v").select("id", (F.col("links") - 1).alias("n_links"), "component_id")
    rest = rows.where(~sound).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return good.union(rest).select(F.col("id").cast(kind).alias(id), "n_links", "component_id",
                                   F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows divided by a power of two near their largest component: no square over- or underflows, cosines stay."""
    return x / np.exp2(np.floor(np.log2(np.abs(x).max(1, initial=1e-300))))[:, None]
