"""N-gram Jaccard join by chosen paths: sets are split on sampled shared tokens until buckets are small.

Texts become sets of word 5-grams, sets become 64 min-hash tokens. A run
starts with all sets in one node; a node samples tokens with probability
1 / (similarity x 64) by a hash of its path, and each set goes to a child for
every sampled token it holds. Similar sets share a child with about one
expected token a level, others thin out. Small buckets are compared by brute
force on the tokens; independent runs repeat until the target recall, and go
on for the sets of buckets that had to be split. Groups
of candidates are then compared exactly on their whole texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.graph import components, cut
from tidewatch.llm.scan import split_join
from tidewatch.llm.stream import deal_tiles, forest, whole_groups
from tidewatch.llm.text import Words, mix64, slices, window_hashes, polynomial, _WORD_P
from tidewatch.session import scratch_path

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.99999  # of a pair at the threshold, over all runs
TOKENS = 64
BUCKET = 4_096  # sets compared by brute force in one task; larger buckets split on
LEVELS = 5  # deeper ones are compared in tiles of BUCKET sets
TILE = 512
PART_BYTES = 1 << 20
MARKS = 18  # 2^18 words of 64 bits mark the texts that are compared
_U = np.uint64
_ODD32 = (mix64(np.arange(1, TOKENS + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)) >> _U(32)).astype(np.uint32) | np.uint32(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each text, sorted within the text, and n + 1 offsets.

    A text of fewer than ``words`` words has one n-gram, all of its words; a text without words has none.
    """
    w = Words(data, offsets)
    start, h = w.windows(words)
    doc = np.searchsorted(w.first, start, "right") - 1
    short = np.flatnonzero((np.diff(w.first) > 0) & (np.diff(w.first) < words))
    if len(short):
        c = polynomial(w.hash, _WORD_P)
        h = np.concatenate([h, window_hashes(c, w.first[short], w.first[short + 1], _WORD_P)])
        doc = np.concatenate([doc, short])
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    return h, np.searchsorted(doc, np.arange(len(offsets)))


def set_keys(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """128-bit keys of the sets (two columns); only for texts that have n-grams."""
    n = np.diff(first)
    some = first[:-1][n > 0]
    out = np.zeros((len(n), 2), _U)
    if len(some):
        out[n > 0, 0] = mix64(np.add.reduceat(mix64(h), some) + n[n > 0].astype(_U))
        out[n > 0, 1] = np.add.reduceat(mix64(h ^ _U(0x5851F42D4C957F2D)), some)
    return out


def min_hashes(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Min-hash tokens of the non-empty sets, 64 bits each."""
    n = np.diff(first)
    some = first[:-1][n > 0]
    out = np.zeros((len(some), TOKENS), _U)
    low = (h >> _U(32)).astype(np.uint32)
    for i in range(TOKENS if len(some) else 0):
        out[:, i] = np.minimum.reduceat(low * _ODD32[i], some)
    return mix64(out + (np.arange(TOKENS, dtype=_U) << _U(40)))


def sketches(tokens: np.ndarray) -> np.ndarray:
    """16 bits of each token, enough to compare two sets."""
    return (tokens >> _U(48)).astype(np.uint16)


def missed(similarity: float, levels: int) -> float:
    """Chance that a pair at the threshold does not stay together for ``levels`` levels of one run.

    Reckoned with the share of equal tokens three deviations below the similarity.
    """
    equal = TOKENS * similarity - 3 * math.sqrt(TOKENS * similarity * (1 - similarity))
    together = 1.0
    for _ in range(levels):
        together = 1 - (1 - together / (similarity * TOKENS)) ** equal
    return 1 - together


def runs_for(recall: float, similarity: float, splits: int = 0) -> int:
    """Runs after which a pair at the threshold has met in a bucket that is compared with probability ``recall``.

    Of a pair that meets in buckets split up to ``splits`` times only: the
    chance to have met in none of the first runs is taken off first.
    """
    low = similarity - 3 * math.sqrt(similarity * (1 - similarity) / TOKENS)
    runs = math.ceil(math.log(1 / (1 - recall)) * similarity / low)
    if splits:
        left = (1 - recall) - missed(similarity, 1) ** runs
        runs = max(runs, math.ceil(math.log(left) / math.log(missed(similarity, splits + 1))))
    return runs


def children(paths: np.ndarray, tokens: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(rows, child paths): row r goes on with each of its tokens that the node samples."""
    t = tokens.astype(_U) + np.arange(TOKENS, dtype=_U)[None, :] * _U(0x9FB21C651E98DF25)
    h = mix64(t * _U(0x9E3779B97F4A7C15) ^ paths[:, None])
    rows, cols = np.nonzero(h < _U(int(2.0**64 / (similarity * TOKENS))))
    return rows, mix64(h[rows, cols] + _U(1))


def _read(column: pa.Array | pa.ChunkedArray, kind: type, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _compare(least: int):
    """Edges within small buckets: pairs of sets with ``least`` equal tokens, as a forest.

    The rows of a bucket come by node, so that a group's edges lead to its smallest node.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, at in whole_groups(batches, "tile"):
            tokens = _read(t["sketch"], np.uint16, TOKENS)
            nodes = t["node"].combine_chunks().to_numpy()
            side = t["side"].combine_chunks().to_numpy()
            size = np.diff(at)
            two = at[:-1][size == 2]
            two = two[((tokens[two] == tokens[two + 1]).sum(1) >= least)] if len(two) else two
            u, v = (two + 1).tolist(), two.tolist()
            for g in np.flatnonzero(size > 2):
                a, b = at[g], at[g + 1]
                for i, r in _bucket_forest(tokens[a:b], side[a:b], least):
                    u.append(a + i)
                    v.append(a + r)
            yield pa.RecordBatch.from_arrays([pa.array(nodes[np.array(x, np.int64)]) for x in (u, v)], names=["u", "v"])

    return work


def _bucket_forest(x: np.ndarray, side: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Edges (row, root) of the groups made by pairs with ``least`` equal tokens (between the sides, if there are two).

    Each row is compared once with the rows that no group holds yet, so a
    bucket of much the same sets takes few steps.
    """
    two = side.any()
    open_ = np.arange(len(x))
    out = []
    while len(open_):
        root, open_ = int(open_[0]), open_[1:]
        queue = [root]
        while queue and len(open_):
            i = queue.pop()
            near = (x[open_] == x[i]).sum(1) >= least
            if two:
                near &= side[open_] != side[i]
            joined = open_[near].tolist()
            out += [(k, root) for k in joined]
            queue += joined
            open_ = open_[~near]
    return out


def _links(words: int, similarity: float):
    """Exact comparison of the texts of a tile: (u, v) edges of a forest, (u, null, m) linked documents of a set."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, at in whole_groups(batches, "tile"):
            cids = _read(t["cid"], _U, 2)
            weight = t["m"].combine_chunks().to_numpy()
            side = t["side"].combine_chunks().to_numpy()
            text = t["text"].combine_chunks()
            u, v, m = [], [], []
            for a, b in zip(at[:-1], at[1:], strict=True):
                if b - a < 2:
                    continue
                sets, ok = [], np.zeros(b - a, bool)
                for _, _, data, offsets in slices(text.slice(a, b - a), PART_BYTES):
                    h, first = shingle_sets(data, offsets, words)
                    keys = set_keys(h, first)
                    for r in range(len(keys)):
                        ok[len(sets)] = (keys[r] == cids[a + len(sets)]).all()  # the text that the set came from
                        sets.append(h[first[r]:first[r + 1]])
                names = [x.tobytes() for x in cids[a:b]]
                seen = set()
                for i in range(b - a):
                    if ok[i]:
                        ok[i] = (names[i], side[a + i]) not in seen
                        seen.add((names[i], side[a + i]))
                left = np.flatnonzero(ok & (side[a:b] == 0))
                right = np.flatnonzero(ok & (side[a:b] == 1)) if side[a:b].any() else left
                hit = _jaccard([sets[i] for i in left], [sets[i] for i in right] if right is not left else None) + 1e-9 >= similarity
                if right is left:
                    np.fill_diagonal(hit, False)
                w = weight[a:b]
                both = [(left, hit @ w[right])] + ([] if right is left else [(right, hit.T @ w[left])])
                for rows, sums in both:
                    for i, s in zip(rows.tolist(), sums.tolist(), strict=True):
                        if s:
                            u.append(names[i])
                            v.append(None)
                            m.append(s)
                r, c = np.nonzero(hit)
                for i, root in forest(b - a, np.stack([left[r], right[c]], 1)):
                    u.append(names[i])
                    v.append(names[root])
                    m.append(0)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.binary()), pa.array(v, pa.binary()), pa.array(m, pa.int64())], names=["u", "v", "m"])

    return work


def _jaccard(left: list[np.ndarray], right: list[np.ndarray] | None) -> np.ndarray:
    """Jaccard similarities of sorted sets; ``right`` None: of ``left`` among themselves."""
    everyone = left if right is None else left + right
    n = np.array([len(x) for x in everyone])
    if len(everyone) <= 6:
        rights = left if right is None else right
        both = np.array([[len(np.intersect1d(x, y, assume_unique=True)) for y in rights] for x in left], np.float64).reshape(len(left), len(rights))
    else:
        tokens, inv, count = np.unique(np.concatenate(everyone), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(n)), n)
        keep = count[inv] > 1  # a token of one set meets nothing
        col = (np.cumsum(count > 1) - 1)[inv[keep]]
        row, width = row[keep], int((count > 1).sum())
        order = np.argsort(col, kind="stable")
        row, col = row[order], col[order]
        both = np.zeros((len(left), len(left) if right is None else len(right)))
        step = max(1, 4_000_000 // len(n))
        for c in range(0, width, step):
            i, j = np.searchsorted(col, [c, c + step])
            x = np.zeros((len(n), min(step, width - c)), np.float32)
            x[row[i:j], col[i:j] - c] = 1
            both += x[:len(left)] @ (x if right is None else x[len(left):]).T
    a, b = n[:len(left)], n[:len(left)] if right is None else n[len(left):]
    return both / np.maximum(a[:, None] + b[None, :] - both, 1)


def join_documents(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, recall: float = RECALL,
                   id: str = "doc_id", text: str = "text") -> DataFrame:
    """Near-duplicate groups: (id, n_links, class_id, text_key, first) for every row.

    n_links counts the other rows whose set of word n-grams has a Jaccard
    similarity of at least ``similarity``; class_id is the smallest id
    reachable by links; ``first`` marks the row that stands for its group (of
    rows equal in id and text all are marked). Links are exact: a pair is
    reported only after comparing the whole texts, and one at the threshold
    is missed with probability 1 - ``recall`` at most, whatever the sizes of its
    buckets (see ``runs_for``).

    Words are runs of bytes other than space and tab to carriage return. A
    text of fewer words than an n-gram is one n-gram; a null, empty or blank
    text links with nothing and is its own group, as is a row with null id
    unless it links. Repeated rows count as separate rows. An empty table
    gives an empty result; other columns are ignored.

    Equal sets are joined as one with their number. A bucket too large to
    compare goes to its children, and is joined to its smallest member: those
    nearly equal to it need not go on, as all their partners are joined to it
    too. A pair may lose sight of each other at each split, so the sets that
    went on get more runs, by the number of splits. Buckets still too large
    after ``LEVELS``, and candidate groups of any size, are compared in tiles.
    """
    spark = docs.sparkSession
    kind = docs.schema[id].dataType.simpleString()
    runs = runs_for(recall, similarity)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, offsets in slices(b.column(1), PART_BYTES):
                h, first = shingle_sets(data, offsets, words)
                full = np.diff(first) > 0
                keys = iter(set_keys(h, first)[full])
                tokens = min_hashes(h, first)
                sk = iter(sketches(tokens))
                into = [children(np.full(len(tokens), r, _U), tokens, similarity) for r in mix64(np.arange(1, runs + 1, dtype=_U))]
                owner = np.flatnonzero(full)[np.concatenate([x[0] for x in into])]
                order = np.argsort(owner, kind="stable")
                starts = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner[order], np.arange(j - i + 1)), pa.int32()),
                                                  pa.array(np.concatenate([x[1] for x in into])[order].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[i:j], b.column(2)[i:j], pa.array([next(keys).tobytes() if f else None for f in full], pa.binary()),
                     pa.array([next(sk).tobytes() if f else None for f in full], pa.binary()), starts],
                    names=["id", "text_key", "cid", "sketch", "starts"])

    path = scratch_path(spark, "jaccard-sets")
    source = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_key"))
    source.mapInArrow(sketch, f"id {kind}, text_key long, cid binary, sketch binary, starts array<long>").write.parquet(path)
    sets = spark.read.parquet(path)
    classes = cut(sets.where("cid is not null").groupBy("cid").agg(
        F.count("*").alias("m"), F.min("sketch").alias("sketch"), F.min("starts").alias("starts"), F.min(F.struct("id", "text_key")).alias("rep"),
        F.min("id").alias("low")).withColumn("node", F.xxhash64("cid")))

    deviation = math.sqrt(similarity * (1 - similarity) / TOKENS)
    least = max(1, math.floor((similarity - 5 * deviation) * TOKENS))
    # beside the smallest member of a large bucket: a set near it (inner) has all its partners within
    # the distance of a link more, which even with four deviations of error is still joined
    joined = TOKENS // 5
    low = joined / TOKENS + 4 * math.sqrt(0.16 / TOKENS) + (1 - similarity)
    inner = math.ceil((low + 4 * math.sqrt(low * (1 - low) / TOKENS)) * TOKENS)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, paths = children(b.column("path").to_numpy().view(_U), _read(b.column("sketch"), np.uint16, TOKENS), similarity)
            yield pa.RecordBatch.from_arrays([pa.array(paths.view(np.int64)), b.column("node").take(pa.array(rows))], names=["path", "node"])

    found: list[DataFrame] = []

    def descend(nodes: DataFrame, sketches: DataFrame) -> tuple[int, DataFrame | None]:
        """Add the edges under ``nodes`` to ``found``; the number of splits, and the sets that the first split sent on."""
        splits, sent = 0, None
        for level in range(LEVELS + 1):
            last = level == LEVELS
            met = cut(_met(nodes, None if last else BUCKET))
            small = (met if last else met.where(F.col("n") <= BUCKET)).join(sketches, "node")
            small = deal_tiles(small.select("path", "node", "sketch"), "path", F.col("node"), BUCKET) if last else small.select(
                F.col("path").alias("tile"), F.lit(0).cast("byte").alias("side"), "node", "sketch")
            small = small.select("tile", "side", "node", "sketch").repartition("tile").sortWithinPartitions("tile", "node")
            found.append(cut(small.mapInArrow(_compare(least), "u long, v long")))
            large = met.where(F.col("n") > BUCKET).select("path", "node")
            if last or large.isEmpty():
                break
            if not level:  # the levels below join sketches of little more than the sets of large buckets
                sketches = cut(_marked(sketches, "node", large.select("node")))
            heads = large.groupBy("path").agg(F.min("node").alias("head")).join(
                sketches.select(F.col("node").alias("head"), F.col("sketch").alias("head_sketch")), "head")
            large = cut(large.join(sketches, "node").join(heads, "path").select("path", "node", "sketch", "head", "head_sketch").mapInArrow(
                _beside_head, "path long, node long, sketch binary, head long, equal int"))
            found.append(large.where(F.col("equal") >= joined).select(F.col("node").alias("u"), F.col("head").alias("v")))
            onward = large.where(F.col("equal") < inner).select("path", "node", "sketch")
            if onward.isEmpty():
                break
            splits = level + 1
            sent = cut(onward.select("node", "sketch").dropDuplicates(["node"])) if sent is None else sent
            nodes = onward.mapInArrow(split, "path long, node long")
        return splits, sent

    # sets go by 64 bits of their keys until the candidates are known: two that share them are both candidates
    splits, sent = descend(classes.select(F.explode("starts").alias("path"), "node"), classes.select("node", "sketch"))
    while (more := runs_for(recall, similarity, splits)) > runs:
        salts = mix64(np.arange(runs + 1, more + 1, dtype=_U)).view(np.int64).tolist()
        again = sent.withColumn("path", F.explode(F.array(*[F.lit(x) for x in salts])))
        deeper, _ = descend(again.mapInArrow(split, "path long, node long"), sent)
        runs, splits = more, max(splits, deeper)
    edges = found[0]
    for f in found[1:]:
        edges = edges.union(f)
    groups = cut(components(edges).join(classes.select("node", "cid", "m", "rep"), "node"))

    mine = groups.select("cid", "m", "component", F.col("rep.id").alias("_i"), F.col("rep.text_key").alias("_t"))
    sizes = groups.groupBy("component").agg(F.count("*").alias("_n"))
    dealt = _tiles_of(mine, sizes, TILE)
    wanted = _marked(source, "text_key", mine.select(F.col("_t").alias("text_key")))
    tiles = wanted.join(dealt, wanted["text_key"].eqNullSafe(F.col("_t")) & wanted["id"].eqNullSafe(F.col("_i"))).select("tile", "side", "cid", "m", "text")
    tiles = tiles.repartition("tile").sortWithinPartitions("tile", "cid")
    compared = cut(tiles.mapInArrow(_links(words, similarity), "u binary, v binary, m long"))

    linked = compared.where("v is null").groupBy(F.col("u").alias("cid")).agg(F.sum("m").alias("linked"))
    parts = components(compared.where("v is not null").select("u", "v")).withColumnRenamed("node", "cid")
    named = classes.select("cid", "m", "rep", "low").join(parts, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    least_id = named.groupBy("component").agg(F.min("rep").alias("head"), F.min("low").alias("class_id"))
    info = named.join(least_id, "component").join(linked, "cid", "left").select(
        "cid", (F.col("m") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), "class_id", "head")
    # a row without a set, or whose group has no id, stands alone
    out = sets.select("id", "text_key", "cid").join(info, "cid", "left")
    return out.select(F.col("id").alias(id), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.when(F.col("cid").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"), "text_key",
                      (F.col("cid").isNull() | F.col("head").eqNullSafe(F.struct("id", "text_key"))).alias("first"))


def _met(nodes: DataFrame, most: int | None) -> DataFrame:
    """(path, node, n) of the buckets, rows of ``nodes`` (path, node) with the same path, of two sets at least.

    Of buckets of the same sets one stands for all. Those of more than ``most`` sets
    stay, as each is split by its own path.
    """
    sizes = nodes.groupBy("path").agg(F.count("*").alias("n"), F.bit_xor("node").alias("members")).where("n > 1")
    own = F.lit(None) if most is None else F.when(F.col("n") > most, F.col("path"))
    one = sizes.groupBy("n", "members", own.cast("long").alias("own")).agg(F.min("path").alias("path")).select("path", "n")
    return split_join(nodes, one, ["path"])


def _marked(rows: DataFrame, key: str, keys: DataFrame, marks: int = MARKS) -> DataFrame:
    """``rows`` whose hash ``key`` (long) may be among ``keys``: all that are, and few others.

    One bit of a broadcast table of 2^``marks`` words stands for a hash, so what is
    shuffled to be joined with ``keys`` is little more than the rows that do.
    """
    word, bit = F.shiftrightunsigned(key, 64 - marks), F.expr(f"shiftleft(1L, cast(`{key}` & 63 as int))")
    table = keys.select(word.alias("_w"), bit.alias("_b")).groupBy("_w").agg(F.bit_or("_b").alias("_b"))
    return rows.join(F.broadcast(table), word == F.col("_w")).where(F.col("_b").bitwiseAND(bit) != 0).drop("_w", "_b")


def _tiles_of(members: DataFrame, sizes: DataFrame, block: int) -> DataFrame:
    """``deal_tiles`` for rows whose group sizes are known; the texts join their tiles afterwards."""
    t = split_join(members, sizes, ["component"]).withColumn("_k", F.ceil(F.col("_n") / block).cast("int"))
    t = t.withColumn("_b", F.pmod(F.xxhash64("cid", F.lit(11)), F.col("_k")).cast("int"))
    t = t.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
    return t.select(F.xxhash64("component", F.least("_b", "_o"), F.greatest("_b", "_o")).alias("tile"),
                    (F.col("_b") > F.col("_o")).cast("byte").alias("side"), "cid", "m", "_i", "_t")


def _beside_head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal tokens of each set of a large bucket and the bucket's smallest member."""
    for b in batches:
        x, y = (_read(b.column(c), np.uint16, TOKENS) for c in ("sketch", "head_sketch"))
        yield pa.RecordBatch.from_arrays(
            [b.column("path"), b.column("node"), b.column("sketch"), b.column("head"), pa.array((x == y).sum(1).astype(np.int32))],
            names=["path", "node", "sketch", "head", "equal"])


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without near-duplicates: of each group the row with the smallest (id, text key) stays.

    Every row with a null, empty or blank text is its own group, so all of them stay.
    """
    joined = cut(join_documents(docs, **options))
    keep = joined.where("first").select(F.col("doc_id").alias("_i"), F.col("text_key").alias("_t"))
    again = keep.count() - (unique := keep.distinct()).count()
    kept = docs.join(unique, docs["doc_id"].eqNullSafe(F.col("_i")) & F.xxhash64(docs["text"]).eqNullSafe(F.col("_t"))).select(*docs.columns)
    own = F.when(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(0)).otherwise(F.monotonically_increasing_id() + 1)
    return kept.withColumn("_own", own).dropDuplicates(["doc_id", "text", "_own"]).drop("_own") if again else kept
