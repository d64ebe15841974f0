"""Toxicity by a convolutional text classifier: hashed word embeddings, filter widths, max pooling.

``fit`` trains on rows in memory; it gives the first model, from a bounded
draw. If that draw is not all labelled rows, ``refine`` goes on over all of
them: vocabulary, weights and thresholds then come from every labelled row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.text import Words, slices
from tidewatch.session import scratch_path

BITS = 22  # hash buckets of words
LEAST_DOCS = 2  # a bucket gets an embedding if so many fitted texts hold it
DIM = 16
WIDTHS = (1, 2, 3)
FILTERS = 16
MAX_TRAIN = 6000  # labelled rows of the first model at most, by hash order, half of them of either label where there are so many
MAX_TRAIN_BYTES = 32_768  # longer texts are left to the passes over all rows
CHUNK = 4096  # rows that one copy of the model is trained on in a pass, before the copies are averaged
PIECE = 1 << 18  # words whose responses are held at a time
FETCH = 1 << 18  # embedding rows whose changes come to the driver at a time
FIXED = 2.0**32  # changes of weights are summed as integers of this unit: sums do not depend on their order
EPOCHS = 6
ROUNDS = EPOCHS  # passes over all labelled rows, if the first model has not seen them all
BATCH = 32
THRESHOLD = 0.7
GRID = np.arange(0.5, 0.91, 0.05)
PART_BYTES = 1 << 20


@dataclass
class Model:
    """Embedding row of each bucket, embeddings (the last row of zeros pads and stands for words not fitted),
    filters by width and tap, output layer, thresholds by language."""

    rows: np.ndarray
    emb: np.ndarray
    taps: dict[int, np.ndarray]
    bias: dict[int, np.ndarray]
    out: np.ndarray
    out_bias: float
    thresholds: dict[str, float] = field(default_factory=dict)
    seen: np.ndarray | None = None  # squared gradients of each embedding row so far

    def __getstate__(self) -> dict:
        """Shipped by its known buckets: the table of all buckets is made again where it arrives."""
        known = np.flatnonzero(self.rows != len(self.emb) - 1)
        return dict(self.__dict__, rows=(known.astype(np.int32), self.rows[known]))

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        known, at = state["rows"]
        self.rows = np.full(1 << BITS, len(self.emb) - 1, np.int32)
        self.rows[known] = at

    def tables(self) -> dict[int, np.ndarray]:
        """Embedding times each tap: a filter's response is then a sum of looked-up rows."""
        return {w: np.stack([self.emb @ self.taps[w][j] for j in range(w)]) for w in self.taps}


def new_model(texts: list[np.ndarray], seed: int = 7) -> Model:
    rng = np.random.default_rng(seed)
    docs = np.zeros(1 << BITS, np.int32)
    for t in texts:
        docs[np.unique(t)] += 1
    known = np.flatnonzero(docs >= LEAST_DOCS)
    rows = np.full(1 << BITS, len(known), np.int32)
    rows[known] = np.arange(len(known))
    emb = rng.normal(0, 0.1, (len(known) + 1, DIM)).astype(np.float32)
    emb[-1] = 0
    taps = {w: rng.normal(0, 0.5 / np.sqrt(DIM * w), (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS}
    return Model(rows, emb, taps, {w: np.zeros(FILTERS, np.float32) for w in WIDTHS},
                 rng.normal(0, 0.2, len(WIDTHS) * FILTERS).astype(np.float32), 0.0)


def padded(model: Model, buckets: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Embedding rows of all texts' words with the widest filter's padding behind each, and where each text starts."""
    pad = max(WIDTHS)
    n = np.diff(first)
    start = first[:-1] + pad * np.arange(len(n))
    flat = np.full(int(first[-1]) + pad * len(n), len(model.emb) - 1, np.int64)
    flat[np.arange(int(first[-1])) + np.repeat(start - first[:-1], n)] = model.rows[buckets]
    return flat, start


def _end(z: np.ndarray, start: np.ndarray, width: int) -> None:
    """A window that would reach into the next text is none of this one."""
    ends = np.append(start[1:], len(z))
    for j in range(1, width):
        z[ends - j] = -np.inf


def pooled(tables: dict[int, np.ndarray], model: Model, flat: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Highest response of every filter in every text, at least 0."""
    parts = []
    for w, t in tables.items():
        z = t[0][flat]
        for j in range(1, w):
            z[:-j] += t[j][flat[j:]]
        _end(z, start, w)
        parts.append(np.maximum(np.maximum.reduceat(z, start, axis=0) + model.bias[w], 0))
    return np.concatenate(parts, axis=1)


def score_buckets(model: Model, tables: dict[int, np.ndarray], buckets: np.ndarray, first: np.ndarray) -> np.ndarray:
    if len(first) < 2:
        return np.zeros(0)
    z = pooled(tables, model, *padded(model, buckets, first)) @ model.out + model.out_bias
    return 1 / (1 + np.exp(-z.astype(np.float64)))


class Trainer:
    """Adam and, for embeddings, AdaGrad on the logistic loss of batches; ``model`` is changed in place."""

    def __init__(self, model: Model):
        self.model = model
        dense = [("out", None), *[("taps", w) for w in WIDTHS], *[("bias", w) for w in WIDTHS]]
        self.moments = {k: [0.0, 0.0] for k in dense}
        self.seen = np.full(len(model.emb), 1e-8, np.float32) if model.seen is None else model.seen
        self.bias_m = [0.0, 0.0]
        self.step = 0

    def adam(self, m: list, g: np.ndarray, rate: float) -> np.ndarray:
        m[0] = 0.9 * m[0] + 0.1 * g
        m[1] = 0.999 * m[1] + 0.001 * g * g
        return rate * (m[0] / (1 - 0.9**self.step)) / (np.sqrt(m[1] / (1 - 0.999**self.step)) + 1e-8)

    def winners(self, words: list[np.ndarray], goes_on: list[bool]) -> tuple[dict, dict]:
        """By width: highest response of every filter in every text, and the embedding rows of the window that has it.

        A text that ``goes_on`` ends with words of its next piece: windows begin at its first ``PIECE`` words alone.
        """
        model = self.model
        flat, start = padded(model, np.concatenate(words), np.concatenate([[0], np.cumsum([len(x) for x in words])]))
        doc = np.repeat(np.arange(len(words)), np.diff(np.append(start, len(flat))))
        x = model.emb[flat]
        tops, rows_of = {}, {}
        for w in WIDTHS:
            z = x @ model.taps[w][0]
            for j in range(1, w):
                z[:-j] += x[j:] @ model.taps[w][j]
            _end(z, start, w)
            for d in np.flatnonzero(goes_on):
                z[start[d] + PIECE:start[d] + len(words[d]) + max(WIDTHS)] = -np.inf
            top = np.maximum.reduceat(z, start, axis=0)
            rows, cols = np.nonzero(z >= top[doc])
            at = np.zeros(top.shape, np.int64)
            at[doc[rows][::-1], cols[::-1]] = rows[::-1]
            tops[w] = top
            rows_of[w] = flat[np.minimum(at[:, :, None] + np.arange(w), len(flat) - 1)]
        return tops, rows_of

    def respond(self, words: list[np.ndarray]) -> tuple[dict, dict]:
        """``winners`` of whole texts, with the responses of ``PIECE`` words held at a time."""
        if sum(map(len, words)) <= PIECE:
            return self.winners(words, [False] * len(words))
        got = []
        for t in words:
            best = None
            for i in range(0, max(1, len(t)), PIECE):
                over = i + PIECE < len(t)
                tops, rows = self.winners([t[i:i + PIECE + (max(WIDTHS) - 1 if over else 0)]], [over])
                if best is None:
                    best = tops, rows
                    continue
                for w in WIDTHS:
                    more = tops[w] > best[0][w]
                    best[0][w][more], best[1][w][more] = tops[w][more], rows[w][more]
            got.append(best)
        return tuple({w: np.concatenate([g[k][w] for g in got]) for w in WIDTHS} for k in (0, 1))

    def batch(self, words: list[np.ndarray], y: np.ndarray, weight: float = 1.0) -> None:
        model = self.model
        self.step += 1
        tops, rows_of = self.respond(words)
        h = np.concatenate([np.maximum(tops[w] + model.bias[w], 0) for w in WIDTHS], axis=1)
        p = 1 / (1 + np.exp(-(h @ model.out + model.out_bias)))
        d = ((p - y) * np.where(y > 0, 1.0, weight) / len(words)).astype(np.float32)
        dh = np.outer(d, model.out) * (h > 0)
        grads = {("out", None): h.T @ d}
        emb_rows, emb_grads = [], []
        for n, w in enumerate(WIDTHS):
            g = dh[:, n * FILTERS:(n + 1) * FILTERS]
            gt = np.zeros_like(model.taps[w])
            for j in range(w):
                at = rows_of[w][:, :, j]
                gt[j] = np.einsum("bf,bfd->df", g, model.emb[at])
                emb_rows.append(at.ravel())
                emb_grads.append((g[:, :, None] * model.taps[w][j].T[None]).reshape(-1, DIM))
            grads["taps", w] = gt
            grads["bias", w] = g.sum(0)
        model.out -= self.adam(self.moments["out", None], grads["out", None], 0.01)
        model.out_bias -= float(self.adam(self.bias_m, np.array(d.sum()), 0.01))
        for w in WIDTHS:
            model.taps[w] -= self.adam(self.moments["taps", w], grads["taps", w], 0.005)
            model.bias[w] -= self.adam(self.moments["bias", w], grads["bias", w], 0.005)
        rows, eg = np.concatenate(emb_rows), np.concatenate(emb_grads)
        own, inv = np.unique(rows, return_inverse=True)
        total = np.zeros((len(own), DIM), np.float32)
        np.add.at(total, inv, eg)
        self.seen[own] += (total * total).mean(1)
        model.emb[own] -= 0.1 * total / np.sqrt(self.seen[own])[:, None]
        model.emb[-1] = 0


def fit(texts: list[np.ndarray], y: np.ndarray, langs: list[str | None], weight: float = 1.0, seed: int = 7) -> Model:
    """Adam on the logistic loss; gradients reach the words that win a filter's maximum.

    A sixth of the rows is kept aside to calibrate a threshold for each
    language. ``weight`` scales the loss of label 0 (to undo a balanced sample).
    """
    model = new_model(texts, seed)
    if not len(y) or y.min() == y.max():
        model.out_bias = -4.0 if not len(y) or not y.max() else 4.0
        model.out[:] = 0
        return model
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    aside, train = order[:len(y) // 6], order[len(y) // 6:]
    trainer = Trainer(model)
    for _ in range(EPOCHS):
        for i in range(0, len(train), BATCH):
            some = rng.permutation(train[i:i + BATCH]) if i == 0 else train[i:i + BATCH]
            trainer.batch([texts[r] for r in some], y[some], weight)
    model.seen = trainer.seen
    model.thresholds = calibrate(model, [texts[r] for r in aside], y[aside], [langs[r] for r in aside])
    return model


def calibrate(model: Model, texts: list[np.ndarray], y: np.ndarray, langs: list[str | None]) -> dict[str, float]:
    """Threshold of each language with the best F1 on rows kept aside, between 0.5 and 0.9; ties go to the middle."""
    if not texts:
        return {}
    tables = model.tables()
    some = [texts[i:i + BATCH] for i in range(0, len(texts), BATCH)]
    s = np.concatenate([score_buckets(model, tables, np.concatenate(b), np.concatenate([[0], np.cumsum([len(t) for t in b])])) for b in some])
    grid, found = GRID, {}
    for lang in sorted({x for x in langs if x is not None}):
        mine = np.array([x == lang for x in langs])
        if y[mine].sum() < 5:
            continue
        f1 = []
        for t in grid:
            hit = s[mine] >= t
            f1.append(2 * (hit & (y[mine] > 0)).sum() / max(1, hit.sum() + y[mine].sum()))
        best = grid[np.array(f1) >= max(f1) - 1e-12]
        found[lang] = float(round(best[np.abs(best - THRESHOLD).argmin()], 2))
    return found


def _buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w = Words(data, offsets, lower=True, letters=True)
    return (w.hash >> np.uint64(64 - BITS)).astype(np.int64), w.first


def _hashed(rows: DataFrame) -> DataFrame:
    """``rows`` with words (hash buckets) in place of text."""
    kept = [c for c in rows.columns if c != "text"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, offsets in slices(b.column(len(kept)), PART_BYTES):
                v, first = _buckets(data, offsets)
                words = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(v, pa.int32()))
                yield pa.RecordBatch.from_arrays([*[b.column(k)[i:j] for k in range(len(kept))], words], names=[*kept, "words"])

    from pyspark.sql.types import ArrayType, IntegerType, StructType

    return rows.select(*kept, "text").mapInArrow(work, StructType([rows.schema[c] for c in kept]).add("words", ArrayType(IntegerType())))


def _lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    """Each row's array, as a view; a null one is empty."""
    return [np.asarray(c.values)[a:b] for c in column.chunks for a, b in zip(c.offsets.to_pylist()[:-1], c.offsets.to_pylist()[1:])]


def train(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAIN) -> Model:
    """Fit on all labelled documents whose crc32(doc_id as text) mod 3 is not 1.

    The first model comes from at most ``limit`` rows, by hash order: these
    label rows are broadcast and the hashed words of their documents (not the
    texts) come to the driver. Where that is not every labelled row (too many,
    or longer ones), ``refine`` goes on over all of them. Of several labels of
    an id the largest counts, of several documents the one with the smallest
    text hash; null labels, ids and texts are left out.
    """
    known = (labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1).withColumn("h", F.xxhash64("doc_id")))
    counts = {r["toxic"]: r["count"] for r in known.groupBy(F.col("toxic").cast("int").alias("toxic")).count().collect()}
    ids = known.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic"), "h")
    chosen = [ids.where(F.col("toxic") == t).orderBy("h", "_id").limit(limit // 2) for t in (0, 1)]
    sample = chosen[0].union(chosen[1]).drop("h")
    texts_of = docs.select("doc_id", "text", "lang").where("text is not null")
    rows = texts_of.join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))
    long = F.octet_length("text") > MAX_TRAIN_BYTES
    rows = rows.select("doc_id", "lang", "toxic", long.alias("long"), F.xxhash64("text").alias("h"), F.when(~long, F.col("text")).alias("text"))
    rows = rows.groupBy("doc_id").agg(F.bool_or("long").alias("left"), F.min(F.when(~F.col("long"), F.struct("h", "text", "lang", "toxic"))).alias("r"))
    t = _hashed(rows.select("doc_id", "left", "r.lang", "r.toxic", "r.text")).toArrow()
    t = t.take(pa.array(np.argsort(np.array(t["doc_id"].to_pylist(), np.int64), kind="stable"))) if len(t) else t
    all_seen = not any(t["left"].to_pylist()) and all(counts.get(k, 0) <= limit // 2 for k in (0, 1)) and set(counts) <= {0, 1}
    t = t.filter(pa.array([x is not None for x in t["toxic"].to_pylist()], pa.bool_()))
    texts = _lists(t["words"])
    y = np.array(t["toxic"].to_pylist(), np.float32)
    y = (y > 0).astype(np.float32)
    share = [min(1.0, (limit // 2) / max(1, counts.get(k, 0))) for k in (0, 1)]
    model = fit(texts, y, t["lang"].to_pylist(), weight=min(4.0, share[1] / share[0]))
    if all_seen:
        return model
    del t, texts, y
    fitted = F.broadcast(sample.select(F.col("_id").alias("doc_id"), F.lit(True).alias("fitted")))
    chunks = max(1, -(-sum(counts.values()) // CHUNK))
    every = texts_of.where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1).select("doc_id", F.xxhash64("text").alias("h"), "lang", "text")
    every = _hashed(every).repartition(chunks, "doc_id")        # the only exchange of whole texts' words: what follows keeps it
    every = every.join(ids.select(F.col("_id").alias("doc_id"), "toxic").repartition(chunks, "doc_id"), "doc_id")
    every = every.groupBy("doc_id").agg(F.min(F.struct("h", "words", "lang", "toxic")).alias("r")).select("doc_id", "r.words", "r.lang", "r.toxic")
    return refine(every.join(fitted, "doc_id", "left"), model)


def _grown(model: Model, known: np.ndarray, seed: int = 7) -> Model:
    """``model`` with embeddings for the buckets ``known`` beside its own."""
    n = len(model.emb) - 1
    new = known[model.rows[known] == n]
    rows = model.rows.copy()
    rows[rows == n] = n + len(new)
    rows[new] = n + np.arange(len(new))
    fresh = np.random.default_rng(seed).normal(0, 0.1, (len(new), DIM)).astype(np.float32)
    seen = np.full(n + 1, 1e-8, np.float32) if model.seen is None else model.seen
    return replace(model, rows=rows, emb=np.concatenate([model.emb[:-1], fresh, model.emb[-1:]]),
                   seen=np.concatenate([seen[:-1], np.full(len(new) + 1, 1e-8, np.float32)]))


def _dense(model: Model) -> np.ndarray:
    return np.concatenate([model.out, [model.out_bias], *[model.taps[w].ravel() for w in WIDTHS], *[model.bias[w] for w in WIDTHS]])


def _with_dense(model: Model, v: np.ndarray) -> Model:
    """``model`` with the weights ``v`` beside the embeddings, as copies."""
    shapes = [(len(model.out),), (1,), *[model.taps[w].shape for w in WIDTHS], *[model.bias[w].shape for w in WIDTHS]]
    parts = [x.astype(np.float32).reshape(s) for x, s in zip(np.split(v, np.cumsum([int(np.prod(s)) for s in shapes])[:-1]), shapes)]
    n = len(WIDTHS)
    return replace(model, out=parts[0], out_bias=float(parts[1][0]), taps=dict(zip(WIDTHS, parts[2:2 + n])), bias=dict(zip(WIDTHS, parts[2 + n:])))


def refine(rows: DataFrame, model: Model) -> Model:
    """``model`` trained on over all ``rows`` (doc_id, words, lang, toxic, fitted).

    Every pass trains a copy of the model on each chunk (partition) of the rows,
    dealt by id, and averages the copies: changes are summed by weight, those of an
    embedding over the chunks that touched it. A sixth of the rows that the
    first model was not fitted on is kept aside; the thresholds come from it.
    What the driver holds is the model, at most ``2**BITS`` embeddings, and the
    changes of ``FETCH`` embeddings; a pass's broadcast goes with the pass.
    """
    spark = rows.sparkSession
    aside = F.col("fitted").isNull() & (F.pmod(F.xxhash64("doc_id", F.lit("aside")), F.lit(6)) == 0)
    path = scratch_path(spark, "toxicity")
    (rows.select("doc_id", "words", "lang", (F.col("toxic") > 0).cast("int").alias("y"), aside.alias("aside"),
                 F.spark_partition_id().alias("chunk"))
     .sortWithinPartitions(F.xxhash64("doc_id"), "doc_id").write.parquet(path))
    rows = spark.read.parquet(path)
    fitted = rows.where("not aside")

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(1 << BITS, np.int32)
        for b in batches:
            for k in range(len(b)):
                n[np.unique(np.asarray(b.column(0)[k].values))] += 1
        own = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(n[own].astype(np.int64))], names=["bucket", "n"])

    known = fitted.select("words").mapInArrow(buckets, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    known = known.where(F.col("n") >= LEAST_DOCS).select("bucket").toArrow()["bucket"].to_numpy()
    model = _grown(model, np.sort(known).astype(np.int64))
    for _ in range(ROUNDS):
        model = _pass(fitted, model)
    model.thresholds = _thresholds(rows.where("aside"), model)
    return model


def _pass(rows: DataFrame, model: Model) -> Model:
    """One pass over ``rows``: the average of the copies of ``model`` trained on the chunks, in its own arrays."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def change(start: Model, now: Trainer) -> pa.RecordBatch:
        """Changes as integers: of embedding rows with their squared gradients, and of all else in rows below 0."""
        rows = np.flatnonzero(now.seen != start.seen)
        moved = np.column_stack([now.model.emb[rows] - start.emb[rows], (now.seen - start.seen)[rows]])
        dense = _dense(now.model) - _dense(start)
        dense = np.concatenate([dense, np.zeros(-len(dense) % (DIM + 1))]).reshape(-1, DIM + 1)
        values = np.rint(np.concatenate([moved, dense]).astype(np.float64) * FIXED).astype(np.int64)
        at = np.concatenate([rows, -1 - np.arange(len(dense))]).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(at), *[pa.array(np.ascontiguousarray(v)) for v in values.T]],
                                          names=["at", *[f"d{k}" for k in range(DIM + 1)]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, now, chunk = shared.value, None, None
        words, y = [], []
        for b in batches:
            for k, (c, label) in enumerate(zip(b.column(2).to_pylist(), b.column(1).to_pylist())):
                if c != chunk:
                    if now is not None:
                        if words:
                            now.batch(words, np.array(y, np.float32))
                        yield change(start, now)
                    copy = _with_dense(replace(start, emb=start.emb.copy(), seen=start.seen.copy()), _dense(start))
                    now, chunk, words, y = Trainer(copy), c, [], []
                words.append(np.asarray(b.column(0)[k].values).astype(np.int64))
                y.append(label)
                if len(words) == BATCH or sum(map(len, words)) > PIECE:
                    now.batch(words, np.array(y, np.float32))
                    words, y = [], []
        if now is not None:
            if words:
                now.batch(words, np.array(y, np.float32))
            yield change(start, now)

    columns = [f"d{k}" for k in range(DIM + 1)]
    changes = rows.select("words", "y", "chunk").mapInArrow(work, "at long, " + ", ".join(f"{c} long" for c in columns))
    summed = changes.groupBy("at").agg(*[F.sum(c).alias(c) for c in columns], F.count("*").alias("n"))
    real = [F.col(c) / F.lit(FIXED) for c in columns]
    moved = [(x / F.col("n")).cast("float") for x in real[:DIM]] + [real[DIM].cast("float")]
    path = scratch_path(rows.sparkSession, "toxicity")
    summed.select("at", F.when(F.col("at") >= 0, F.array(*moved)).alias("own"),
                  F.when(F.col("at") < 0, F.array(*[x / F.col("n") for x in real])).alias("dense")).write.parquet(path)
    shared.destroy()
    mean = rows.sparkSession.read.parquet(path)
    flat = lambda c, kind: np.concatenate([np.zeros(0, kind), *[np.asarray(x.flatten()) for x in c.chunks]]).reshape(-1, DIM + 1)
    t = mean.where("at < 0").select("at", "dense").toArrow()
    dense = flat(t["dense"], np.float64)[np.argsort(-t["at"].to_numpy())]
    before = _dense(model)
    for i in range(0, len(model.emb), FETCH):
        t = mean.where(F.col("at").between(i, i + FETCH - 1)).select("at", "own").toArrow()
        own, change_of = t["at"].to_numpy(), flat(t["own"], np.float32)
        model.emb[own] += change_of[:, :DIM]
        model.seen[own] += change_of[:, DIM]
    return _with_dense(model, before + dense.ravel()[:len(before)] if len(dense) else before)


def _thresholds(rows: DataFrame, model: Model) -> dict[str, float]:
    """``calibrate`` from counts of all ``rows`` (words, lang, y), by language."""
    shared = rows.sparkSession.sparkContext.broadcast(replace(model, seen=None))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        tables = m.tables()
        for b in batches:
            for i in range(0, len(b), BATCH):
                words = [np.asarray(b.column(0)[k].values).astype(np.int64) for k in range(i, min(i + BATCH, len(b)))]
                s = score_buckets(m, tables, np.concatenate(words), np.concatenate([[0], np.cumsum([len(x) for x in words])]))
                over = (s[:, None] >= GRID).sum(1)          # the grid ascends: values up to this one are reached
                yield pa.RecordBatch.from_arrays([b.column(1)[i:i + BATCH], b.column(2)[i:i + BATCH], pa.array(over.astype(np.int32))],
                                                 names=["lang", "y", "over"])

    counted = rows.where("lang is not null").select("words", "lang", "y").mapInArrow(work, "lang string, y int, over int")
    found: dict[str, np.ndarray] = {}
    for r in counted.groupBy("lang", "y", "over").count().collect():
        found.setdefault(r["lang"], np.zeros((2, len(GRID) + 1)))[r["y"], r["over"]] = r["count"]
    shared.destroy()
    out = {}
    for lang, c in sorted(found.items()):
        if c[1].sum() < 5:
            continue
        hits = c[:, ::-1].cumsum(1)[:, ::-1][:, 1:]          # by grid value: rows at or above it, of either label
        f1 = 2 * hits[1] / np.maximum(1, hits.sum(0) + c[1].sum())
        best = GRID[f1 >= f1.max() - 1e-12]
        out[lang] = float(round(best[np.abs(best - THRESHOLD).argmin()], 2))
    return out


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with its score (0 to 1, of the whole text), threshold (its language's) and flagged.

    Only the text enters the score. A null or empty text gets the score of no
    words; a null or unseen language has the common threshold. Rows are
    independent; existing columns of these names are replaced.
    """
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c not in ("score", "threshold", "flagged")]
    shared = spark.sparkContext.broadcast(replace(model, seen=None))  # 16 MB of rows and the fitted words, whatever the corpus
    at = kept.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        tables = m.tables()
        for b in batches:
            s = [score_buckets(m, tables, *_buckets(data, offsets)) for _, _, data, offsets in slices(b.column(at), PART_BYTES)]
            s = np.concatenate(s) if s else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s)], names=[*kept, "score"])

    from pyspark.sql.types import DoubleType, StructType

    schema = StructType([docs.schema[c] for c in kept]).add("score", DoubleType())
    limits = [x for lang, t in sorted(model.thresholds.items()) for x in (F.lit(lang), F.lit(t))]
    own = F.create_map(*limits)[F.col("lang")] if limits else F.lit(None).cast("double")
    threshold = F.coalesce(own, F.lit(THRESHOLD))
    return (docs.select(*kept).mapInArrow(work, schema).withColumn("threshold", threshold)
            .withColumn("flagged", F.col("score") >= F.col("threshold")))
