"""Context-tree weighting of bytes: binary decisions, Krichevsky-Trofimov estimates mixed over all depths.

Texts are packed once into compressed blocks in the shared folder. A block
sends each distinct gram (``depth`` bytes of context and one byte) once with
its count in training texts; counts meet by gram, context trees are weighted
by shards of equal nearest bytes, and each block gets back the log
probability of its own grams. So nothing of the corpus' size is broadcast,
and what is shuffled follows the distinct grams of the blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.graph import cut
from tidewatch.llm.text import Words, slices
from tidewatch.operators.sizes import broadcast_small
from tidewatch.session import scratch_path

DEPTH = 4
LOW = 2  # shards share this many nearest bytes; less deep nodes are summed over shards (at most 65,536 of them)
BLOCK_BYTES = 24 << 20
PART_BYTES = 512 << 10
MERGE_KEYS = 250_000  # keys that a worker gathers before it merges them
EDGE = 0xFF  # no byte of UTF-8: stands before and behind a text
_U = np.uint64


def lgamma(x: np.ndarray) -> np.ndarray:
    """log Gamma for x > 0 by Stirling's series, moved up by eight."""
    x = np.asarray(x, np.float64)
    low = np.ones_like(x)
    for i in range(8):
        low *= x + i
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - np.log(low)


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a zeros and b ones."""
    return lgamma(a + 0.5) + lgamma(b + 0.5) - lgamma(a + b + 1) - 1.1447298858494002


def weigh(log_own: np.ndarray, log_children: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log weighted probability, posterior weight of the node's own estimate)."""
    total = np.logaddexp(log_own, log_children)
    return total - np.log(2), np.exp(log_own - total)


class Shard:
    """Context trees over the distinct grams (sorted, with training counts) of some nearest-byte contexts."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, depth: int = DEPTH, low: int = LOW):
        self.grams, self.depth, self.low = grams, depth, low
        self.levels: list[tuple] = []  # from the deepest: rows' place in the level, own nodes by bit
        keys, c = grams, counts.astype(np.float64)
        place = np.arange(len(grams))
        children = None
        for d in range(depth, low - 1, -1):
            if d < depth:
                shorter = ((keys >> _U(16)) << _U(8)) | (keys & _U(255))
                own, inv = np.unique(shorter, return_inverse=True)
                c = np.bincount(inv, c, len(own))
                place = inv[place]
            else:
                own, inv = keys, None
            nodes, sums = [], []
            for j in range(8):
                prefix = own >> _U(8 - j)
                first = np.flatnonzero(np.concatenate([[True], prefix[1:] != prefix[:-1]])) if len(own) else np.zeros(0, int)
                group = np.cumsum(np.bincount(first, minlength=len(own))) - 1 if len(own) else first
                one = ((own >> _U(7 - j)) & _U(1)).astype(bool)
                b = np.add.reduceat(np.where(one, c, 0.0), first) if len(own) else np.zeros(0)
                a = np.add.reduceat(np.where(one, 0.0, c), first) if len(own) else np.zeros(0)
                log_own = log_kt(a, b)
                if children is None:
                    log_w, w = log_own, np.ones(len(a))
                else:
                    kid_first, kid_log = children[j]
                    log_kids = np.bincount(group[inv[kid_first]], kid_log, len(a))
                    log_w, w = weigh(log_own, log_kids)
                nodes.append((group, one, (b + 0.5) / (a + b + 1), w, a, b))
                sums.append((first, log_w))
            self.levels.append((place, nodes))
            children = sums
            keys = own
        self.top_keys, self.top = keys, children

    def roots(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sums by the node one level up: key (context byte x 256 + node), zeros, ones, log weighted probability."""
        keys, a, b, s = [], [], [], []
        for j in range(8):
            first, log_w = self.top[j]
            nodes = self.levels[-1][1][j]
            own = self.top_keys[first]
            up = own >> _U(16)  # contexts one byte shorter
            keys.append(up * _U(256) + (_U(1 << j) | ((own & _U(255)) >> _U(8 - j))))
            a.append(nodes[4])
            b.append(nodes[5])
            s.append(log_w)
        k, inv = np.unique(np.concatenate(keys), return_inverse=True)
        return k, *(np.bincount(inv, np.concatenate(x), len(k)) for x in (a, b, s))

    def log_probabilities(self, tops: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Natural log probability of each gram's last byte; ``tops``: (own estimate of one, weight) by node,
        for depth LOW - 1 down to 0."""
        out = np.zeros(len(self.grams))
        sym = self.grams & _U(255)
        for j in range(8):
            p = None
            for place, nodes in self.levels:
                group, one, kt, w = nodes[j][:4]
                at = group[place]
                p = kt[at] if p is None else w[at] * kt[at] + (1 - w[at]) * p
            node = (_U(1 << j) | (sym >> _U(8 - j))).astype(np.int64)
            for d in range(self.low - 1, -1, -1):
                ctx = (self.grams >> _U(8 * (self.depth - d + 1))).astype(np.int64) if d else 0
                kt, w = tops[d]
                p = w[ctx * 256 + node] * kt[ctx * 256 + node] + (1 - w[ctx * 256 + node]) * p
            one = ((sym >> _U(7 - j)) & _U(1)).astype(bool)
            out += np.log(np.where(one, p, 1 - p))
        return out


def tops_of(rows: list[tuple[int, float, float, float]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(estimate of one, weight) by node for depths 0 and 1, from the sums of ``Shard.roots`` (LOW = 2)."""
    a, b, s = (np.zeros(65536) for _ in range(3))
    for k, x, y, z in rows:
        a[k], b[k], s[k] = x, y, z
    log_w, w1 = weigh(log_kt(a, b), s)
    w1[a + b == 0] = 0.5
    log_w[a + b == 0] = 0.0
    a0, b0, s0 = (x.reshape(256, 256).sum(0) for x in (a, b, log_w))
    w0 = weigh(log_kt(a0, b0), s0)[1]
    return [((b0 + 0.5) / (a0 + b0 + 1), w0), ((b + 0.5) / (a + b + 1), w1)]


def gram_keys(data: np.ndarray, offsets: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Grams of some texts in order, nearest context byte first and the byte itself last; a text of n bytes has n + 1."""
    n = np.diff(offsets)
    start = offsets[:-1] + depth * np.arange(1, len(n) + 1)
    flat = np.full(len(data) + depth * (len(n) + 1), EDGE, np.uint8)
    flat[np.arange(len(data)) + np.repeat(start - offsets[:-1], n)] = data
    at = np.arange(len(data) + len(n)) + np.repeat(start - offsets[:-1] - np.arange(len(n)), n + 1)
    flat = flat.astype(_U)
    keys = flat[at]
    for i in range(1, depth + 1):
        keys |= flat[at - i] << _U(8 * (depth + 1 - i))
    return keys


def _pack(batches: list[pa.RecordBatch]) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batches[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        for b in batches:
            out.write_batch(b)
    return sink.getvalue().to_pybytes()


def _unpack(blob: bytes) -> Iterator[pa.RecordBatch]:
    yield from pa.ipc.open_stream(blob)


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not keys:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    k, inv = np.unique(np.concatenate(keys), return_inverse=True)
    return k, np.bincount(inv, np.concatenate(counts), len(k)).astype(np.int64)


def _counted(keys: np.ndarray, train: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct keys with their training counts (0 for those that only other texts hold)."""
    k, c = np.unique(keys[train], return_counts=True)
    yield k, c
    k = np.unique(keys[~train])
    yield k, np.zeros(len(k), np.int64)


def _word_keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w = Words(data, offsets, lower=True)
    return w.hash, w.first


def pack_blocks(docs: DataFrame, train: Column, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write (block, texts): compressed groups of about ``BLOCK_BYTES`` of whole texts, with ids and training flags."""
    spark = docs.sparkSession

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, nth, held, some = TaskContext.get().partitionId(), 0, 0, []
        for b in batches:
            for i, j, data, _ in slices(b.column(1), BLOCK_BYTES):
                if held and held + len(data) > BLOCK_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([(part << 24) + nth]), pa.array([_pack(some)], pa.binary())], names=["block", "texts"])
                    nth, held, some = nth + 1, 0, []
                some.append(b.slice(i, j - i))
                held += len(data)
        if some:
            yield pa.RecordBatch.from_arrays([pa.array([(part << 24) + nth]), pa.array([_pack(some)], pa.binary())], names=["block", "texts"])

    path = scratch_path(spark, "ctw-blocks")
    docs.select(F.col(id).alias("id"), F.col(text).alias("text"), train.alias("train")).mapInArrow(
        pack, "block long, texts binary").write.option("compression", "uncompressed").parquet(path)
    return spark.read.parquet(path)


GRAMS, WORDS, TEXTS = range(3)


class _Counter:
    """Distinct keys with their training counts, merged as they grow."""

    def __init__(self):
        self.keys, self.counts, self.held, self.most = [], [], 0, MERGE_KEYS

    def add(self, keys: np.ndarray, train: np.ndarray) -> None:
        for k, c in _counted(keys, train):
            self.keys.append(k)
            self.counts.append(c)
            self.held += len(k)
        if self.held > self.most:
            k, c = _merge(self.keys, self.counts)
            self.keys, self.counts, self.held = [k], [c], 0
            self.most = MERGE_KEYS + 2 * len(k)

    def rows(self, kind: int, block: int) -> Iterator[pa.RecordBatch]:
        k, c = _merge(self.keys, self.counts)
        for i in range(0, len(k), 100_000):
            n = len(k[i:i + 100_000])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int8)), pa.array(k[i:i + 100_000].view(np.int64)),
                                              pa.array(np.full(n, block, np.int64)), pa.array(c[i:i + 100_000])], names=["kind", "k", "block", "c"])


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct grams and words of each block with their counts in its training texts, and the number of these texts."""
    for b in batches:
        for block, blob in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            grams, words, texts = _Counter(), _Counter(), 0
            for t in _unpack(blob.as_py()):
                train = t.column(2).to_numpy(zero_copy_only=False).astype(bool)
                texts += int(train.sum())
                for i, j, data, offsets in slices(t.column(1), PART_BYTES):
                    grams.add(gram_keys(data, offsets), np.repeat(train[i:j], np.diff(offsets) + 1))
                    h, first = _word_keys(data, offsets)
                    words.add(h, np.repeat(train[i:j], np.diff(first)))
            yield from grams.rows(GRAMS, block)
            del grams
            yield from words.rows(WORDS, block)
            pa.default_memory_pool().release_unused()
            yield pa.RecordBatch.from_arrays([pa.array([TEXTS], pa.int8()), pa.array([0]), pa.array([block]), pa.array([texts])],
                                             names=["kind", "k", "block", "c"])


class Lookup:
    """Values of distinct keys by hash: the keys of a slot stand together, and there are few."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.shift = _U(64 - max(4, (4 * len(keys)).bit_length()))
        slot = self._slot(keys)
        order = np.argsort(slot, kind="stable")
        self.keys, self.values = keys[order], values[order]
        self.start = np.concatenate([[0], np.cumsum(np.bincount(slot, minlength=1 << (64 - int(self.shift))))]).astype(np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _U(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The keys' values, 0 for unknown ones."""
        if not len(self.keys):
            return np.zeros(len(keys), self.values.dtype)
        slot = self._slot(keys)
        at, end = self.start[slot], self.start[slot + 1]
        here = np.minimum(at, len(self.keys) - 1)
        hit = (at < end) & (self.keys[here] == keys)
        out = np.where(hit, self.values[here], self.values.dtype.type(0))
        left = np.flatnonzero(~hit & (end > at + 1))
        while len(left):
            at[left] += 1
            hit = self.keys[at[left]] == keys[left]
            out[left[hit]] = self.values[at[left[hit]]]
            left = left[~hit & (end[left] > at[left] + 1)]
        return out


def _by_shard(use):
    """Run ``use`` (Shard -> record batch) over sorted rows (k, c), some whole nearest-byte contexts at a time."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = _U(8 * (DEPTH - LOW + 1))
        keys, counts = np.zeros(0, _U), np.zeros(0, np.int64)
        for b in batches:
            keys = np.concatenate([keys, b.column(0).to_numpy().view(_U)])
            counts = np.concatenate([counts, b.column(1).to_numpy()])
            if len(keys) > 400_000:
                cutoff = int(np.searchsorted(keys, (keys[-1] >> shift) << shift))
                if cutoff:
                    yield use(Shard(keys[:cutoff], counts[:cutoff]))
                    keys, counts = keys[cutoff:], counts[cutoff:]
        if len(keys):
            yield use(Shard(keys, counts))

    return work


def score(docs: DataFrame, train: Column, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every text with its code length under the weighted context tree and under the base unigram.

    ``train``: a boolean expression over ``docs``; true rows are learned from.
    The tree decides each byte bit by bit from the ``DEPTH`` bytes before it
    (a mark stands before and behind a text), mixing the estimates of all
    context lengths with their posterior weights after training. Columns: id,
    train, n_bytes, n_tokens (words and one end), n_known, train_tokens,
    base_score (log10, add-one unigram over lower-case words), score (log10
    probability of the text and its end), bits_per_byte (score over n_bytes + 1).

    A null text is an empty one. Repeated rows are separate documents, in
    training too; null in ``train`` counts as false. Without training texts
    every bit has probability 1/2. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    kind = docs.schema[id].dataType.simpleString()
    blocks = pack_blocks(docs, F.coalesce(train, F.lit(False)), id, text)
    path = scratch_path(spark, "ctw-counts")
    blocks.mapInArrow(_distinct, "kind byte, k long, block long, c long").write.option("compression", "zstd").parquet(path)   # read four times
    counts = spark.read.parquet(path)
    grams, words = counts.where(F.col("kind") == GRAMS).drop("kind"), counts.where(F.col("kind") == WORDS).drop("kind")

    # grams have DEPTH + 1 < 8 bytes, so that Spark's signed order is theirs
    counted = cut(grams.groupBy("k").agg(F.sum("c").alias("c")))
    near = F.shiftright("k", 8 * (DEPTH - LOW + 1))
    shards = counted.repartition(near).sortWithinPartitions("k")

    def to_roots(s: Shard) -> pa.RecordBatch:
        k, a, b, w = s.roots()
        return pa.RecordBatch.from_arrays([pa.array(k.astype(np.int64)), pa.array(a), pa.array(b), pa.array(w)], names=["node", "a", "b", "w"])

    roots = shards.mapInArrow(_by_shard(to_roots), "node long, a double, b double, w double")
    rows = roots.groupBy("node").agg(F.sum("a"), F.sum("b"), F.sum("w")).collect()  # 65,536 nodes at most
    tops = spark.sparkContext.broadcast(tops_of([tuple(r) for r in rows]))

    def to_logs(s: Shard) -> pa.RecordBatch:
        p = s.log_probabilities(tops.value)
        return pa.RecordBatch.from_arrays([pa.array(s.grams.view(np.int64)), pa.array(p.astype(np.float32))], names=["k", "p"])

    model = shards.mapInArrow(_by_shard(to_logs), "k long, p float")
    answers = grams.select("k", "block").join(model, "k").select(F.col("block"), F.lit(0).cast("byte").alias("kind"), "k", F.col("p").cast("float"))

    # a word's total comes back only where other blocks hold some of it
    total = F.sum("c").over(Window.partitionBy("k"))
    word_rows = words.withColumn("t", total).where("t > c").select("block", F.lit(1).cast("byte").alias("kind"), "k", F.col("t").alias("t"))
    stats = words.groupBy("k").agg(F.sum("c").alias("t")).where("t > 0").agg(F.count("*").alias("v"), F.sum("t").alias("n")).first()
    n_train = counts.where(F.col("kind") == TEXTS).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    total_n, total_v = (stats["n"] or 0) + n_train, stats["v"] + (n_train > 0)

    # each block's texts, then the answers to its grams and words, in one task; blocks are numbered to deal them evenly
    numbered = blocks.select("block", F.row_number().over(Window.orderBy("block")).alias("nth"))
    many = blocks.count()
    none = lambda t: F.lit(None).cast(t)
    rows = (blocks.select("block", F.lit(-1).cast("byte").alias("kind"), F.lit(0).cast("long").alias("k"), none("float").alias("p"), none("long").alias("t"), "texts")
            .unionByName(answers.select("block", "kind", "k", "p", none("long").alias("t"), none("binary").alias("texts")))
            .unionByName(word_rows.select("block", "kind", "k", none("float").alias("p"), "t", none("binary").alias("texts"))))
    parts = max(1, min(many, 20_000))
    dealt = rows.join(broadcast_small(numbered), "block").repartitionById(parts, F.pmod("nth", F.lit(parts))).sortWithinPartitions("block", "kind")
    out_schema = f"`{id}` {kind}, train boolean, n_bytes long, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
    log_base = np.log10(float(total_n + total_v + 1))

    def finish(blob: bytes, grams: Lookup, known_words: tuple[np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
        parts, own_k, own_c, held = [], [], [], 0
        for t in _unpack(blob):                 # words are hashed once: for the block's own training counts, then for the scores
            flags = t.column(2).to_numpy(zero_copy_only=False).astype(bool)
            for i, j, data, offsets in slices(t.column(1), PART_BYTES):
                h, first = _word_keys(data, offsets)
                parts.append((t.slice(i, j - i), data, offsets, h, first))
                k, c = np.unique(h[np.repeat(flags[i:j], np.diff(first))], return_counts=True)
                own_k.append(k)
                own_c.append(c)
                held += len(k)
                if held > 2 * MERGE_KEYS + len(own_k[0]):
                    k, c = _merge(own_k, own_c)
                    own_k, own_c, held = [k], [c], len(k)
        own = Lookup(*_merge(own_k, own_c))
        elsewhere = Lookup(*known_words)
        for at in range(len(parts)):
            t, data, offsets, h, first = parts[at]
            parts[at] = None
            n = np.diff(offsets)
            p = grams(gram_keys(data, offsets)).astype(np.float64)
            score_ = np.add.reduceat(p, offsets[:-1] + np.arange(len(n))) / np.log(10)
            c = np.maximum(own(h), elsewhere(h))
            doc = np.repeat(np.arange(len(n)), np.diff(first))
            base = np.bincount(doc, np.log10(c + 1.0) - log_base, len(n)) + np.log10(n_train + 1.0) - log_base
            known = np.bincount(doc, c > 0, len(n)).astype(np.int64) + (n_train > 0)
            yield pa.RecordBatch.from_arrays(
                [t.column(0), t.column(2), pa.array(n.astype(np.int64)), pa.array(np.diff(first) + 1, pa.int64()), pa.array(known),
                 pa.array(np.full(len(n), total_n, np.int64)), pa.array(base), pa.array(score_), pa.array(-score_ / np.log10(2) / (n + 1))],
                names=[id, "train", "n_bytes", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"])

    def close(blob: bytes, got: dict) -> Iterator[pa.RecordBatch]:
        whole = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
        yield from finish(blob, Lookup(whole(got["gk"], _U), whole(got["p"], np.float32)), (whole(got["wk"], _U), whole(got["t"], np.int64)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blob, got = None, {}
        for b in batches:
            which = b.column("kind").to_numpy()
            heads = np.flatnonzero(which == -1).tolist()      # a block's texts come first
            cut = [0, *[h for h in heads if h], len(b)]
            for i, j in zip(cut, cut[1:]):
                if i in heads:
                    if blob is not None:
                        yield from close(blob, got)
                        pa.default_memory_pool().release_unused()
                    blob, got = b.column("texts")[i].as_py(), {"gk": [], "p": [], "wk": [], "t": []}
                k, w = b.column("k").to_numpy()[i:j].view(_U), which[i:j]
                got["gk"].append(k[w == GRAMS])
                got["p"].append(b.column("p").to_numpy(zero_copy_only=False)[i:j][w == GRAMS].astype(np.float32))
                got["wk"].append(k[w == WORDS])
                got["t"].append(b.column("t").fill_null(0).to_numpy()[i:j][w == WORDS])
        if blob is not None:
            yield from close(blob, got)

    return dealt.select("kind", "k", "p", "t", "texts").mapInArrow(work, out_schema)
