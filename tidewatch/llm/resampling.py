"""Importance resampling towards a target corpus, over hashed n-grams of distinct lines.

Newlines cut texts into lines. Equal lines are counted first (a partial
aggregate, so a line that many documents share is one row), the features of
each distinct line are hashed once and kept, and the corpus counts are those
features times the line's occurrences. Runs of words across a line's end
belong to no line; they are hashed document by document and added. A bucket's
gain is the logarithm of its smoothed frequency in the target over that in the
corpus. Gains are summed once per distinct line and joined back to the
documents; lines with more than 1 / ``HEAVY`` of all occurrences, at most
``HEAVY`` of them, are joined by broadcast, the others by a shuffle.

A document's score is its mean gain plus Gumbel noise from the hash of its id,
so the highest scores are a sample without replacement by importance.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.text import Words, buffers, slices
from tidewatch.session import scratch_path

HEAVY = 1000
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"   # letters, digits and all beyond ASCII


def _hashed(data: np.ndarray, words: Words, start: np.ndarray, run: np.ndarray, k: int, buckets: int) -> np.ndarray:
    """Buckets of the runs of ``k`` words from ``start``; ``run``: a hash of each, equal runs are hashed by crc32 once."""
    _, first, of = np.unique(run, return_index=True, return_inverse=True)
    raw = data.tobytes()
    begin, end = words.start, words.end
    if k == 1:
        grams = (raw[begin[s]:end[s]] for s in start[first].tolist())
    else:
        grams = (b" ".join(raw[begin[i]:end[i]] for i in range(s, s + k)) for s in start[first].tolist())
    crc = np.fromiter((zlib.crc32(g.lower()) % buckets for g in grams), np.uint32, len(first))
    return crc[of]


def _features(data: np.ndarray, offsets: np.ndarray, n: int, buckets: int, across: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words of each text, text of each feature, bucket of each feature), features in the order of their texts.

    Features are runs of 1 to ``n`` words; ``across``: only those that span a newline, else all.
    """
    words = Words(data, offsets, lower=True, letters=True)
    doc = words.doc()
    line = np.searchsorted(np.flatnonzero(data == 10), words.start) if across else None
    docs, found = [], []
    for k in range(1, n + 1):
        if across and k == 1:
            continue
        start, run = words.windows(k)
        if across:
            spans = line[start] != line[start + k - 1]
            start, run = start[spans], run[spans]
        if len(start):
            docs.append(doc[start])
            found.append(_hashed(data, words, start, run, k, buckets))
    of = np.concatenate(docs) if docs else np.zeros(0, np.int64)
    crc = np.concatenate(found) if found else np.zeros(0, np.uint32)
    order = np.argsort(of, kind="stable")
    return np.diff(words.first), of[order], crc[order]


def _packed(of: np.ndarray, crc: np.ndarray, n: int) -> pa.Array:
    ends = np.searchsorted(of, np.arange(n + 1))
    return pa.array([crc[ends[i]:ends[i + 1]].tobytes() for i in range(n)], pa.binary())


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of all rows, number of each row)."""
    raw, offsets = buffers(column.cast(pa.large_binary()).view(pa.large_string()))
    return np.frombuffer(raw.tobytes(), np.uint32), np.diff(offsets) // 4


def _lower(text: Column) -> Column:
    """A-Z as a-z, nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _lines(text: Column) -> Column:
    """Lines that hold a word, in lower case."""
    return F.filter(F.split(_lower(text), "\n"), lambda x: x.rlike(WORD))


def _key(line: Column) -> Column:
    return F.unhex(F.md5(line))


def _cross(docs: DataFrame, n: int, buckets: int) -> DataFrame:
    """``docs`` (rid, doc_id, text) with ``cross``: the buckets of the runs that span lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, offsets in slices(b.column("text")):
                _, of, crc = _features(data, offsets, n, buckets, True)
                yield pa.RecordBatch.from_arrays([*b.slice(i, j - i).columns, _packed(of, crc, j - i)], names=[*b.schema.names, "cross"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("cross", T.BinaryType())]))


def line_features(texts: DataFrame, n: int, buckets: int) -> DataFrame:
    """One row per distinct line of ``texts`` (text): key, times (its occurrences), words, features (buckets, packed)."""
    lines = texts.select(F.explode(_lines(F.col("text"))).alias("line")).groupBy("line").agg(F.count("*").alias("times"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, offsets in slices(b.column("line")):
                words, of, crc = _features(data, offsets, n, buckets, False)
                part = b.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([part.column("key"), part.column("times"), pa.array(words.astype(np.int64)), _packed(of, crc, j - i)],
                                                 names=["key", "times", "words", "features"])

    return lines.select("line", _key(F.col("line")).alias("key"), "times").mapInArrow(
        run, "key binary, times long, words long, features binary")


def bucket_counts(features: DataFrame, buckets: int) -> DataFrame:
    """(bucket, n) of packed ``features`` that occur ``times`` times each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            crc, n = _unpacked(b.column("features"))
            total += np.bincount(crc, np.repeat(b.column("times").to_numpy(), n), buckets).astype(np.int64)
        seen = np.flatnonzero(total)
        if len(seen):
            yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    return features.select("features", "times").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """floor(1000 ln(target frequency / source frequency)) of every bucket, counts smoothed by one; ``buckets`` numbers on the driver."""
    counts = []
    for df in (source, target):
        c = np.zeros(buckets, np.int64)
        for r in df.collect():          # at most one row a bucket
            c[r["bucket"]] = r["n"]
        counts.append(c)
    s, t = counts
    total_s, total_t = float(s.sum() + buckets), float(t.sum() + buckets)
    return np.array([math.floor(1000 * math.log((b + 1.0) * total_s / ((a + 1.0) * total_t))) for a, b in zip(s.tolist(), t.tolist())], np.int64)


def _gain_sums(features: DataFrame, gain: np.ndarray, carry: list[str]) -> DataFrame:
    """``carry`` columns with n (features of the row) and gain (the sum of their gains)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            crc, n = _unpacked(b.column("features"))
            upto = np.concatenate([[0], np.cumsum(gain[crc])])
            ends = np.concatenate([[0], np.cumsum(n)])
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in carry], pa.array(n.astype(np.int64)), pa.array(upto[ends[1:]] - upto[ends[:-1]])],
                                             names=[*carry, "n", "gain"])

    schema = features.select(*carry).schema
    return features.select(*carry, "features").mapInArrow(run, schema.add("n", "long").add("gain", "long"))


def document_weights(docs: DataFrame, target: DataFrame, id: str = "doc_id", text: str = "text", n: int = 2, buckets: int = 10_000) -> DataFrame:
    """One row per row of ``docs``: id, words, n_features, weight (the floored mean gain of its features; none: 0).

    ``target``: a table with a column ``text``. Features are runs of 1 to
    ``n`` consecutive words of letters, digits and characters beyond ASCII,
    lower-cased in A-Z, joined by a space, and hashed by crc32 into
    ``buckets``. Null, empty and wordless texts have no features. Repeated
    rows and repeated ids stay apart. An empty ``docs`` gives no rows; with an
    empty target all its frequencies are equal. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id).alias("doc_id"), F.col(text).alias("text"))
    if n > 1:
        rows = _cross(rows, n, buckets)
    cross = F.col("cross") if n > 1 else F.lit(None).cast("binary")
    lines = (rows.select("rid", "doc_id", cross.alias("cross"), F.posexplode_outer(_lines(F.col("text"))).alias("at", "line"))
             .select("rid", "doc_id", _key(F.col("line")).alias("key"), F.when(F.coalesce("at", F.lit(0)) == 0, F.col("cross")).alias("features")))
    at_lines, at_features = scratch_path(spark, "lines"), scratch_path(spark, "features")
    lines.write.parquet(at_lines)               # row numbers are fixed here; no texts
    line_features(docs.select(F.col(text).alias("text")), n, buckets).write.option("compression", "zstd").parquet(at_features)
    lines, features = spark.read.parquet(at_lines), spark.read.parquet(at_features)

    goal = target.select("text")
    aim = line_features(goal, n, buckets)
    spans = lines.where(F.col("features").isNotNull()).withColumn("times", F.lit(1).cast("long"))
    counted = features.select("features", "times")
    if n > 1:
        counted = counted.unionByName(spans.select("features", "times"))
        over = _cross(goal.select(F.lit(0).alias("rid"), "text"), n, buckets).select(F.col("cross").alias("features"), F.lit(1).cast("long").alias("times"))
        aim = aim.select("features", "times").unionByName(over)
    gain = gains(bucket_counts(counted, buckets), bucket_counts(aim, buckets), buckets)

    total = features.agg(F.coalesce(F.sum("times"), F.lit(0))).first()[0]
    heavy = F.col("times") > total // HEAVY     # at most HEAVY lines
    sums = lambda df: _gain_sums(df, gain, ["key", "words"])
    mixed = lines.select("rid", "doc_id", "key").join(F.broadcast(sums(features.where(heavy))), "key", "left")
    known = F.col("key").isNull() | F.col("gain").isNotNull()
    rest = mixed.where(~known).select("rid", "doc_id", "key").join(sums(features.where(~heavy)), "key")
    parts = mixed.where(known).unionByName(rest).select("rid", "doc_id", "words", "n", "gain")
    if n > 1:
        parts = parts.unionByName(_gain_sums(spans, gain, ["rid", "doc_id"]).withColumn("words", F.lit(0).cast("long")))
    whole = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    docs = parts.groupBy("rid", "doc_id").agg(whole("words"), whole("n"), whole("gain"))
    return docs.select(F.col("doc_id").alias(id), "words", F.col("n").alias("n_features"),
                       F.when(F.col("n") > 0, F.floor(F.col("gain") / F.col("n"))).otherwise(0).cast("long").alias("weight"))


def gumbel_score(weight: Column, id: Column, seed: str) -> Column:
    """weight + floor(1000 g), g a Gumbel number from sha256(``seed:id``); a null id counts as empty."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    return weight + F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(docs: DataFrame, target: DataFrame, id: str = "doc_id", text: str = "text", n: int = 2, buckets: int = 10_000,
             percent: int = 10, min_words: int = 20, seed: str = "2024") -> DataFrame:
    """Every document with its n_features, weight, score, and rank if it is drawn (1, 2, ...; else null).

    Of the documents with at least ``min_words`` words, ``percent`` of a
    hundred (rounded down) with the highest scores are drawn; ties go to the
    smaller id (nulls last), then to fewer features. Rows equal in all of
    these are one group with a count, expanded at the end. Scores are whole
    numbers, so ranks are running counts within a score, behind the counts of
    all higher ones (a table of one row a score).
    """
    spark = docs.sparkSession
    w = document_weights(docs, target, id, text, n, buckets).withColumn("score", gumbel_score(F.col("weight"), F.col(id), seed))
    path = scratch_path(spark, "scores")
    w.withColumn("able", F.col("words") >= min_words).groupBy(id, "n_features", "weight", "score", "able").agg(F.count("*").alias("times")).write.parquet(path)
    rows = spark.read.parquet(path)
    able = rows.where("able")
    many = able.agg(F.coalesce(F.sum("times"), F.lit(0))).first()[0] * percent // 100
    higher = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)   # one row a score
    above = (able.groupBy("score").agg(F.sum("times").alias("all")).withColumn("above", F.coalesce(F.sum("all").over(higher), F.lit(0)))
             .where(F.col("above") < many).select("score", "above"))
    before = Window.partitionBy("score").orderBy(F.col(id).asc_nulls_last(), "n_features").rowsBetween(Window.unboundedPreceding, -1)
    place = F.col("above") + F.coalesce(F.sum("times").over(before), F.lit(0))
    drawn = able.join(above, "score").withColumn("first", place)
    rest = able.join(above, "score", "left_anti").unionByName(rows.where(~F.col("able"))).withColumn("first", F.lit(None).cast("long"))
    out = drawn.select(id, "n_features", "weight", "score", "times", "first").unionByName(rest.select(id, "n_features", "weight", "score", "times", "first"))
    out = out.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    rank = F.col("first") + F.col("i")
    return out.select(id, "n_features", "weight", "score", F.when(rank <= many, rank).alias("rank"))
