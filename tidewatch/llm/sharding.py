"""Balanced label propagation of documents into shards (DataFrame operations only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.graph import cut
from tidewatch.llm.scan import hash_chunk, running_sum, split_join, with_copies

SHARDS = 40
ROUNDS = 4


def _pick(values: list[int], at: Column) -> Column:
    return F.get(F.array(*[F.lit(v).cast("long") for v in values]), at)


def _by_room(room: list[int], h: Column) -> Column:
    """A shard drawn by the hash ``h`` in proportion to the room left in each."""
    ends, total = [], 0
    for r in room:
        total += r
        ends.append(total)
    p = F.pmod(h, F.lit(max(total, 1)))
    return F.size(F.filter(F.array(*[F.lit(x).cast("long") for x in ends]), lambda e: e <= p)).cast("int")


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its shard and slot; law ``rows``.

    Documents with equal texts are linked. Each document starts with a label
    drawn by its hash. In each round a group's documents vote with their
    labels, weighted by count, among the shards with room, and move together
    to the winner; the shard's quota admits movers in hash order until it is
    full, and those turned away take a new label from the shards with room. A
    group larger than half a quota is split by hash into parts of about that
    size, which move one by one but vote together. What is still open after
    ``rounds`` and all unlinked documents fill the exact free places, groups
    in one piece first. So counts differ by at most one, and only groups that
    meet a full shard are cut.

    Columns: doc_id, size (UTF-8 bytes + 16), text_crc32, law, shard, slot
    (gapless from 0 within the shard), grown_shard (null under this law),
    group_size (documents with this text). A null text has size 16, crc32 0
    and no links; an empty text is an ordinary text. Repeated rows are
    separate documents. An empty table gives an empty result. Other columns
    are ignored. Equal rows are told apart by a number, so that they spread like others.
    """
    rows = cut(with_copies(docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 16).alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.unhex(F.md5(F.col("text"))).alias("gid"),
    )).withColumn("key", F.when(F.col("copy") == 1, F.xxhash64("doc_id", "gid")).otherwise(F.xxhash64("doc_id", "gid", "copy"))).drop("copy"))
    n = rows.count()
    quota = [n // shards + (j < n % shards) for j in range(shards)]
    part = max(1, (n // shards) // 2)

    sizes = rows.where("gid is not null").groupBy("gid").agg(F.count("*").alias("n")).where("n > 1")
    rows = cut(split_join(rows, sizes, ["gid"], "left").withColumn(
        "sub", F.when(F.col("n").isNotNull(), F.pmod("key", F.ceil(F.col("n") / part)).cast("int"))))
    votes = rows.where("n is not null").groupBy(
        "gid", "sub", F.pmod(F.xxhash64("key", F.lit(1)), F.lit(shards)).cast("int").alias("label")).agg(F.count("*").alias("c"))
    parts = cut(votes.groupBy("gid", "sub").agg(
        F.sum("c").alias("m"), F.max_by("label", F.struct("c", "label")).alias("label"))
        .withColumn("settled", F.lit(False)))
    room = list(quota)
    for turn in range(rounds):
        if not sum(room):
            break
        votes = parts.where(_pick(room, F.col("label")) > 0).groupBy("gid", "label").agg(F.sum("m").alias("c"))
        best = votes.groupBy("gid").agg(
            F.max_by("label", F.struct("c", F.xxhash64("gid", "label"), "label")).alias("best"))
        moves = parts.join(best, "gid", "left").withColumn("shard", F.coalesce("best", "label"))
        moves = moves.withColumn("chunk", hash_chunk("gid", "sub", chunks=256)).withColumn("h", F.xxhash64("gid", "sub"))
        want = running_sum(moves.where("not settled"), ["shard"], "chunk", ["h", "gid", "sub"], F.col("m"), "upto")
        fits = F.col("upto") <= _pick(room, F.col("shard"))
        other = _by_room(room, F.xxhash64("gid", "sub", F.lit(turn + 2)))
        parts = cut(parts.where("settled").select("gid", "sub", "m", "label", "settled").union(
            want.select("gid", "sub", "m", F.when(fits, F.col("shard")).otherwise(F.least(other, F.lit(shards - 1))).alias("label"),
                        fits.alias("settled"))))
        room = list(quota)
        for r in parts.where("settled").groupBy("label").agg(F.sum("m").alias("m")).collect():  # at most one row a shard
            room[r["label"]] -= r["m"]

    placed = cut(rows.join(parts.where("settled").select("gid", "sub", F.col("label").alias("shard")), ["gid", "sub"], "left"))
    linked = F.col("n").isNotNull()
    rest = placed.where("shard is null").withColumn("chunk", F.when(linked, hash_chunk("gid", "sub")).otherwise(
        4096 + hash_chunk("key"))).withColumn("h", F.when(linked, F.xxhash64("gid", "sub")).otherwise(F.xxhash64("key")))
    rest = running_sum(rest.withColumn("one", F.lit(0)), ["one"], "chunk", ["h", "gid", "sub", "key", "doc_id"], F.lit(1), "place")
    ends, total = [], 0
    for r in room:
        total += r
        ends.append(total)
    rest = rest.withColumn("shard", F.size(F.filter(
        F.array(*[F.lit(x).cast("long") for x in ends]), lambda e: e < F.col("place"))).cast("int"))
    cols = ["doc_id", "size", "text_crc32", "gid", "key", "n", "shard"]
    all_rows = placed.where("shard is not null").select(*cols).union(rest.select(*cols))
    all_rows = running_sum(all_rows.withColumn("chunk", hash_chunk("key", chunks=1024)).withColumn("h", F.xxhash64("key")),
                           ["shard"], "chunk", ["h", "key", "doc_id"], F.lit(1), "nth")
    return all_rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("nth") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"))
