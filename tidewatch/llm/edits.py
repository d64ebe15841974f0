"""Each document beside the next one: fingerprints of a text, of its edited form and of its neighbour.

Documents are put in descending order by a range exchange; a partition reads
its rows in order and meets every row's successor, but that of its last row.
The last and first rows of the partitions (two a partition) are paired
afterwards. Rows of one id are ordered by their text and then as they were
read, so that a hot id is spread over partitions like any other rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm import weighted_sampling as ws
from tidewatch.llm.text import PART_BYTES, buffers, slices
from tidewatch.session import scratch_path

DONE, FIRST, LAST = 0, 1, 2


def edit(text: str, following: str) -> str:
    """The last third of ``text`` (rounded down, in code points) gives way to as much of ``following``'s start."""
    m = len(text) // 3
    return text[:len(text) - m] + following[:m]


def _signed(texts: list[str], samples: int) -> np.ndarray:
    data, offsets = buffers(pa.array(texts, pa.large_string()))
    return ws.signatures(data, offsets, samples)


def _rows(ids: pa.Array, texts: list[str], following: list[str], sig: np.ndarray, sig_next: np.ndarray, samples: int,
          pid: int, schema: list[str]) -> pa.RecordBatch:
    edited = [edit(a, b) for a, b in zip(texts, following)]
    sig_edited = _signed(edited, samples)
    n = len(texts)
    return pa.RecordBatch.from_arrays([
        pa.array([DONE] * n, pa.int32()), pa.array([pid] * n, pa.int32()), ids, pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()), ws._packed(sig), ws._packed(sig_edited),
        pa.array(ws.likeness(sig, sig_edited), pa.float64()), pa.array(ws.likeness(sig, sig_next), pa.float64()),
        pa.nulls(n, pa.string())], names=schema)


def _edge(kind: int, pid: int, ids: pa.Array, text: str, sig: np.ndarray, schema: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array([kind], pa.int32()), pa.array([pid], pa.int32()), ids, pa.array([len(text)], pa.int64()), pa.nulls(1, pa.string()),
        ws._packed(sig[None, :]), pa.nulls(1, pa.binary()), pa.nulls(1, pa.float64()), pa.nulls(1, pa.float64()), pa.array([text], pa.string())],
        names=schema)


def edited_fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", samples: int = ws.SAMPLES) -> DataFrame:
    """One row per document: id, n_chars, edited_sha256, fingerprint and edited_fingerprint (binary), near_edited, near_next.

    The next document is the next in descending ``id`` (nulls last), after the
    last one the first; a single document follows itself. Rows of one id are
    put in the order of their texts' hashes; repeated rows stay, each with a
    neighbour of its own. A null text counts as empty. An empty table gives no
    rows. Other columns are not read.
    """
    spark = docs.sparkSession
    schema = T.StructType([
        T.StructField("kind", T.IntegerType()), T.StructField("pid", T.IntegerType()), T.StructField("id", docs.schema[id].dataType),
        T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.BinaryType()),
        T.StructField("edited_fingerprint", T.BinaryType()), T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()), T.StructField("text", T.StringType())])
    names = schema.names
    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ordered = (rows.withColumn("h", F.xxhash64("text")).withColumn("r", F.monotonically_increasing_id())
               .orderBy(F.col("id").desc_nulls_last(), "h", "r").select("id", "text", F.spark_partition_id().alias("pid")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pid = None                     # last row so far: ids of one row, its text, its samples
        for batch in batches:
            for i, j, data, offsets in slices(batch.column("text"), PART_BYTES):
                ids, texts = batch.column("id").slice(i, j - i), batch.column("text").slice(i, j - i).to_pylist()
                sig = ws.signatures(data, offsets, samples)
                if held is None:
                    pid = batch.column("pid")[0].as_py()
                    yield _edge(FIRST, pid, ids.slice(0, 1), texts[0], sig[0], names)
                else:
                    ids = pa.concat_arrays([held[0], ids])
                    texts = [held[1], *texts]
                    sig = np.concatenate([held[2][None, :], sig])
                n = len(texts) - 1
                if n:
                    yield _rows(ids.slice(0, n), texts[:-1], texts[1:], sig[:-1], sig[1:], samples, pid, names)
                held = (ids.slice(n, 1), texts[-1], sig[-1])
        if held is not None:
            yield _edge(LAST, pid, held[0], held[1], held[2], names)

    path = scratch_path(spark, "edited")
    ordered.mapInArrow(run, schema).write.option("compression", "zstd").parquet(path)   # read for its rows and for its edges
    done = spark.read.schema(schema).parquet(path)
    first, last = done.where(F.col("kind") == FIRST), done.where(F.col("kind") == LAST)
    order = Window.orderBy("pid")             # one row a partition
    whole = Window.partitionBy()
    follows = first.select("pid", F.coalesce(F.lead("pid").over(order), F.min("pid").over(whole)).alias("next_pid"))
    pairs = last.join(follows, "pid").join(
        first.select(F.col("pid").alias("next_pid"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_fingerprint")), "next_pid")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(len(b)):
                one = b.slice(i, 1)
                yield _rows(one.column("id"), one.column("text").to_pylist(), one.column("next_text").to_pylist(),
                            ws.unpacked(one.column("fingerprint"), samples), ws.unpacked(one.column("next_fingerprint"), samples),
                            samples, one.column("pid")[0].as_py(), names)

    edges = pairs.select("pid", "id", "text", "fingerprint", "next_text", "next_fingerprint").mapInArrow(close, schema)
    out = done.where(F.col("kind") == DONE).unionByName(edges)
    return out.select(F.col("id").alias(id), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
