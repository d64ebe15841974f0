"""Repeated passages by De Bruijn compaction of word windows.

Edges are windows of ``WINDOW`` words. Successive windows whose smallest
k-gram (the anchor) is the same lie on one path; they travel as one block with
the hash of all their words. A block that occurs twice is a repeated path. An
anchor with several blocks is a branching: there, and only there, one
occurrence of each block is taken apart into its windows, which are counted
one by one. Repeated blocks that always follow each other are joined to longer
paths, and each text cuts the words that its spans cover.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.graph import cut
from tidewatch.llm.scan import split_join
from tidewatch.llm.text import _ODD, _WORD_P, Words, mix64, polynomial, slices, window_hashes
from tidewatch.session import scratch_path

WINDOW = 35
ANCHOR = 8
PART_BYTES = 1 << 20
_U = np.uint64
BLOCKS = "array<struct<akey:long,b1:long,b2:long,start:int,nwin:int,before:long,after:long>>"


class Blocks:
    """Blocks of some texts: anchor key, 128-bit key, text, first word within the text, number of windows."""

    def __init__(self, words: Words, window: int = WINDOW, anchor: int = ANCHOR):
        n = len(words.hash)
        last = np.repeat(words.first[1:], np.diff(words.first))
        at, h = words.windows(anchor)
        keys = np.full(n + window, np.iinfo(_U).max, _U)
        keys[at] = h
        start = np.flatnonzero(np.arange(n) + window <= last)
        self.windows = start
        span = window - anchor + 1
        mins = np.concatenate([
            np.lib.stride_tricks.sliding_window_view(keys, span)[i:min(i + 65_536, n)].argmin(1) for i in range(0, n, 65_536)]) if n else start
        anchor_at = start + mins[start]
        doc = np.searchsorted(words.first, start, "right") - 1
        new = np.ones(len(start), bool)
        new[1:] = (anchor_at[1:] != anchor_at[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(new)
        self.nwin = np.diff(np.append(first, len(start)))
        s = start[first]
        self.doc = doc[first]
        self.start = s - words.first[self.doc]
        self.akey = keys[anchor_at[first]]
        offset = (anchor_at[first] - s).astype(_U) * _ODD
        end = s + self.nwin - 1 + window
        self.b1, self.b2 = (mix64(x ^ offset) for x in _two(words, s, end))
        self.n_docs = len(words.first) - 1


def _two(words: Words, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of word ranges."""
    other = mix64(words.hash ^ _U(0x5851F42D4C957F2D))
    return (window_hashes(polynomial(words.hash, _WORD_P), start, end, _WORD_P),
            window_hashes(polynomial(other, _WORD_P), start, end, _WORD_P))


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(_U, copy=False).view(np.int64) if x.dtype == _U else x.astype(np.int64))


def _anchors(window: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key = b.column(0).to_numpy()
            for i, _, data, offsets in slices(b.column(1), PART_BYTES):
                x = Blocks(Words(data, offsets), window)
                yield pa.RecordBatch.from_arrays([_long(x.akey), pa.array(key[i + x.doc])], names=["akey", "k1"])
    return work


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n, sha = [], []
        for x in b.column(3):
            words = (x.as_py() or "").encode().split()
            n.append(len(words))
            sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(n, pa.int64()), pa.array(sha, pa.string())],
                                         names=["id", "k1", "k2", "n_words", "sha"])


def _blocks(window: int):
    """(tid, k1, k2, n, text, blocks): the blocks whose anchors occur elsewhere, in text order with their neighbours."""
    kind = pa.struct([("akey", pa.int64()), ("b1", pa.int64()), ("b2", pa.int64()), ("start", pa.int32()), ("nwin", pa.int32()),
                      ("before", pa.int64()), ("after", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tid = TaskContext.get().partitionId() << 33
        for b in batches:
            lists = b.column(4)
            for i, j, data, offsets in slices(b.column(3), PART_BYTES):
                x = Blocks(Words(data, offsets), window)
                known = lists.slice(i, j - i)
                wanted = known.flatten().to_numpy().view(_U)
                owner = np.repeat(np.arange(j - i), pa.compute.list_value_length(known).to_numpy())
                keep = np.isin(mix64(x.akey) ^ mix64(x.doc.astype(_U)), mix64(wanted) ^ mix64(owner.astype(_U)))
                k1 = x.b1[keep].view(np.int64)
                doc, start, nwin = x.doc[keep], x.start[keep], x.nwin[keep]
                joined = np.zeros(len(k1), bool)  # goes on from the block before
                joined[1:] = (doc[1:] == doc[:-1]) & (start[1:] == start[:-1] + nwin[:-1])
                before, after = np.zeros(len(k1), np.int64), np.zeros(len(k1), np.int64)
                at = np.flatnonzero(joined)
                before[at], after[at - 1] = k1[at - 1], k1[at]
                rows = pa.StructArray.from_arrays(
                    [_long(x.akey[keep]), pa.array(k1), _long(x.b2[keep]), pa.array(start.astype(np.int32)), pa.array(nwin.astype(np.int32)),
                     pa.array(before), pa.array(after)], fields=list(kind))
                bounds = np.searchsorted(doc, np.arange(j - i + 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(tid, tid + j - i)), b.column(0)[i:j], b.column(1)[i:j], b.column(2)[i:j], b.column(3)[i:j],
                     pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), rows)], names=["tid", "k1", "k2", "n", "text", "blocks"])
                tid += j - i

    return work


def _windows(window: int):
    """Windows of the listed blocks of a text: two hashes, the block's count, text and first word."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, offsets in slices(b.column(1), PART_BYTES):
                words = Words(data, offsets)
                lists = b.column(2).slice(i, j - i)
                flat = lists.flatten()
                doc = np.repeat(np.arange(j - i), pa.compute.list_value_length(lists).to_numpy())
                start, nwin, c = (flat.field(f).to_numpy().astype(np.int64) for f in ("start", "nwin", "c"))
                within = np.arange(nwin.sum()) - np.repeat(np.cumsum(nwin) - nwin, nwin)
                pos = np.repeat(start, nwin) + within
                at = np.repeat(words.first[doc], nwin) + pos
                w1, w2 = _two(words, at, at + window)
                tid = b.column(0).to_numpy()[i:j][np.repeat(doc, nwin)]
                yield pa.RecordBatch.from_arrays([_long(w1), _long(w2), pa.array(np.repeat(c, nwin)), pa.array(tid), pa.array(pos.astype(np.int32))],
                                                 names=["w1", "w2", "c", "tid", "pos"])

    return work


def repeated_paths(docs: DataFrame, window: int = WINDOW, id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(texts, spans): distinct texts with repeated anchors, and their repeated spans.

    texts: tid, k1, k2 (key of the text), n (rows with it), text. spans: tid,
    start (word), nwin (windows), glued and open (whether everywhere the same
    path comes before and after it). Each document row counts, so all windows
    of a text with two rows are repeated.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # 128 bits: a hash, and a checksum with the length
    base = base.select("id", F.xxhash64("text").alias("k1"), (F.shiftleft(F.crc32("text"), 32) + F.octet_length("text")).alias("k2"), "text")
    anchors = base.select("k1", "text").mapInArrow(_anchors(window), "akey long, k1 long")
    twice = anchors.groupBy("akey").agg(F.count("*").alias("c")).where("c > 1").select("akey")
    hot = split_join(anchors, twice, ["akey"]).groupBy("k1").agg(F.collect_set("akey").alias("akeys"))
    classes = base.groupBy("k1", "k2").agg(F.count("*").alias("n"), F.min("id").alias("rep"))
    wanted = hot.join(classes, "k1").select(F.col("k1").alias("_1"), F.col("k2").alias("_2"), "n", "rep", "akeys")
    same = (F.col("k1") == F.col("_1")) & (F.col("k2") == F.col("_2")) & F.col("id").eqNullSafe(F.col("rep"))
    path = scratch_path(spark, "substring-texts")
    base.join(wanted, same).select("k1", "k2", "n", "text", "akeys").mapInArrow(
        _blocks(window), f"tid long, k1 long, k2 long, n long, text string, blocks {BLOCKS}").write.parquet(path)
    texts = spark.read.parquet(path)

    blocks = texts.select("tid", "n", F.explode("blocks").alias("b")).select("tid", "n", "b.*")
    paths = cut(blocks.groupBy("b1", "b2", "akey", "nwin").agg(
        F.sum("n").alias("c"), F.min(F.struct("tid", "start")).alias("at"),
        (F.min("after") == F.max("after")).alias("one_after"), (F.min("before") == F.max("before")).alias("one_before")))
    branching = paths.groupBy("akey").agg(F.count("*").alias("k")).where("k > 1").select("akey")
    apart = split_join(paths, branching, ["akey"]).groupBy(F.col("at.tid").alias("tid")).agg(
        F.collect_list(F.struct(F.col("at.start").alias("start"), "nwin", "c")).alias("blocks"))
    edges = cut(texts.select("tid", "text").join(apart, "tid").select("tid", "text", "blocks").mapInArrow(
        _windows(window), "w1 long, w2 long, c long, tid long, pos int"))
    again = edges.groupBy("w1", "w2").agg(F.sum("c").alias("t")).where("t > 1").select("w1", "w2")
    single = split_join(edges.where("c = 1"), again, ["w1", "w2"]).select("tid", F.col("pos").alias("start"), F.lit(1).alias("nwin"),
        F.lit(False).alias("glued"), F.lit(False).alias("open"))
    whole = blocks.join(paths.where("c > 1").select("b1", "b2", "one_after", "one_before"), ["b1", "b2"]).select(
        "tid", "start", "nwin", (F.col("one_before") & (F.col("before") != 0)).alias("glued"), (F.col("one_after") & (F.col("after") != 0)).alias("open"))
    return texts, single.union(whole)


def _cut_words(window: int):
    """Join the paths of a text to maximal spans, drop the words they cover, and hash the rest."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            removed, sha, spans, kept_text = [], [], [], []
            for x, s in zip(b.column(2), b.column(3), strict=True):
                words = x.as_py().encode().split()
                flat = s.values
                start, nwin = flat.field("start").to_numpy().astype(np.int64), flat.field("nwin").to_numpy().astype(np.int64)
                glued, open_ = (flat.field(f).to_numpy(zero_copy_only=False) for f in ("glued", "open"))
                order = np.argsort(start, kind="stable")
                start, end = start[order], (start + nwin - 1 + window)[order]
                # source coordinates: a span goes on where the next windows start right behind its last one
                follows, branch = np.zeros(len(start), bool), np.zeros(len(start), bool)
                follows[1:] = start[1:] <= end[:-1] - window + 1
                branch[1:] = follows[1:] & ~(glued[order][1:] & open_[order][:-1])
                head = np.flatnonzero(~follows)
                branches = np.add.reduceat(branch.astype(np.int64), head)
                start, end = start[head], np.append(end[head[1:] - 1], end[-1])
                change = np.zeros(len(words) + 1, np.int64)
                np.add.at(change, start, 1)
                np.add.at(change, end, -1)
                keep = np.cumsum(change)[:-1] == 0
                left = b" ".join([w for w, k in zip(words, keep.tolist(), strict=True) if k])
                removed.append(int((~keep).sum()))
                sha.append(hashlib.sha256(left).hexdigest())
                spans.append([{"start": int(p), "end": int(q), "branches": int(k)} for p, q, k in zip(start, end, branches, strict=True)])
                kept_text.append(left.decode())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(removed, pa.int64()), pa.array(sha, pa.string()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("branches", pa.int32())]))), pa.array(kept_text, pa.string())],
                names=["k1", "k2", "n_removed", "sha_left", "spans", "kept"])

    return work


def remove_repeats(docs: DataFrame, window: int = WINDOW, id: str = "doc_id", text: str = "text", texts_too: bool = False) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) of every row; with ``texts_too`` also spans and kept.

    A word goes if a window of ``window`` words that covers it also starts
    anywhere else, in the same document or another; windows are those of the
    input. Words are runs of bytes other than space and tab to carriage
    return, unchanged; kept words are joined by one space. spans: maximal
    word ranges whose windows all repeat (end exclusive) with the number of
    branchings between the paths they consist of; null, as is kept, where
    nothing repeats.

    A null text has no words; texts shorter than a window lose nothing.
    Repeated rows are separate documents, so their windows repeat. An empty
    table gives an empty result; other columns are ignored.
    """
    texts, spans = repeated_paths(docs, window, id, text)
    lists = spans.groupBy("tid").agg(F.collect_list(F.struct("start", "nwin", "glued", "open")).alias("spans"))
    shape = "k1 long, k2 long, n_removed long, sha_left string, spans array<struct<start:int,end:int,branches:int>>, kept string"
    done = texts.select("tid", "k1", "k2", "text").join(lists, "tid").select("k1", "k2", "text", "spans").mapInArrow(_cut_words(window), shape)
    if not texts_too:
        done = done.select("k1", "k2", "n_removed", "sha_left")
    # equal rows of a text give equal results
    done = done.dropDuplicates(["k1", "k2"])
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id).alias("id"), F.xxhash64(body).alias("k1"), (F.shiftleft(F.crc32(body), 32) + F.octet_length(body)).alias("k2"), body.alias("text"))
    kind = docs.schema[id].dataType.simpleString()
    rows = rows.mapInArrow(_stats, f"id {kind}, k1 long, k2 long, n_words long, sha string")
    out = split_join(rows, done, ["k1", "k2"], "left")
    more = ["spans", "kept"] if texts_too else []
    return out.select(F.col("id").alias(id), "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
                      F.coalesce("sha_left", "sha").alias("kept_sha256"), *more)
