"""Mix sources to target weights by weighted sampling without replacement (DataFrame operations only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.graph import cut
from tidewatch.llm.scan import hash_chunk, running_sum, split_join, with_copies

WORD = r"[^\x20\x09-\x0D]+"
CYCLE = (5.0, 2.0, 1.0)
CHUNKS = 1024


def exponential_key(names: list[Column], weight: Column) -> Column:
    """Efraimidis-Spirakis key -ln(u) / weight; u in (0, 1) from the first 52 bits of the md5 of ``names``, joined by colons."""
    name = F.concat_ws(":", *[F.coalesce(n.cast("string"), F.lit("")) for n in names])
    bits = F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("double")
    return -F.log((bits + 0.5) / F.lit(2.0**52)) / weight


def source_targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0, cycle: tuple = CYCLE) -> DataFrame:
    """(source, source_size) with its rank and target.

    Weights follow the sources in code-point order, null last. Targets share
    ``share`` times all words by weight; none is above ``most`` times its
    source, and what that frees is shared again by weight until none is
    above: with sources in order of limit per weight, a source is at its
    limit where that ratio is at most the level which the rest would get. The
    table has one row a source, so one window over it is small beside the
    documents.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    w = F.get(F.array(*[F.lit(float(c)) for c in cycle]), ((F.row_number().over(order) - 1) % len(cycle)))
    t = sizes.withColumn("rank", F.row_number().over(order)).withColumn("w", w).withColumn(
        "limit", F.col("source_size") * F.lit(float(most)))
    every = Window.partitionBy(F.lit(0))
    by_level = Window.partitionBy(F.lit(0)).orderBy(F.col("limit") / F.col("w"), "rank")
    upto = by_level.rowsBetween(Window.unboundedPreceding, -1)
    t = (t.withColumn("total", F.sum("source_size").over(every) * F.lit(float(share)))
         .withColumn("used", F.coalesce(F.sum("limit").over(upto), F.lit(0.0)))
         .withColumn("left_w", F.sum("w").over(every) - F.coalesce(F.sum("w").over(upto), F.lit(0.0)))
         .withColumn("level", (F.col("total") - F.col("used")) / F.col("left_w")))
    # the level of the first source below its limit holds for all after it
    free = F.col("limit") > F.col("w") * F.col("level")
    t = t.withColumn("final", F.min(F.when(free, F.struct((F.col("limit") / F.col("w")).alias("r"), "rank", "level"))).over(every))
    over = F.col("final").isNull() | (F.struct((F.col("limit") / F.col("w")).alias("r"), "rank") < F.struct("final.r", "final.rank"))
    return t.select("source", "rank", "source_size",
                    F.when(over, F.col("limit")).otherwise(F.col("w") * F.col("final.level")).alias("target"))


def mix(docs: DataFrame, labels: DataFrame | None = None, share: float = 1.5, most: float = 2.0,
        cycle: tuple = CYCLE) -> DataFrame:
    """Every document with the words that the mix takes of it.

    A source's target over its size gives complete epochs, in which all its
    documents are taken; the fraction left is filled by documents in order of
    exponential keys (smaller first) scaled by quality weight: 2 for label 1,
    0.5 for label 0, 1 without a label. A document is taken while the words
    before it and half its own fit the fraction, so the taken words differ
    from the target by half of one document at most.

    Columns: doc_id, source, size, source_size, target, taken (size x
    epochs), epochs and text_md5. A null text has size 0, a null source
    is a source of its own; of several labels of an id the largest counts.
    A row's key comes from its id, its text and its number among equal rows,
    so repeated rows and rows of one id are separate documents. An empty
    table gives an empty result; a source without words has target 0.
    """
    rows = with_copies(docs.select("doc_id", "source", F.md5(F.col("text")).alias("text_md5"),
                                   F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")))
    if labels is not None:
        q = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("_q"))
        rows = split_join(rows, q, ["doc_id"], "left")
        weight = F.when(F.col("_q") == 1, 2.0).when(F.col("_q") == 0, 0.5).otherwise(1.0)
    else:
        weight = F.lit(1.0)
    rows = cut(rows.withColumn("key", exponential_key([F.col("doc_id"), F.col("text_md5"), F.col("copy")], weight)).drop("_q", "copy"))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, share, most, cycle)
    rows = rows.join(targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    # -ln(u)/1 is exponential, so this spreads the keys over the chunks and follows their order
    rows = rows.withColumn("chunk", F.floor((1 - F.exp(-F.col("key"))) * CHUNKS).cast("int"))
    rows = running_sum(rows, ["rank"], "chunk", ["key", "doc_id", "size"], F.col("size"), "upto")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.col("target") - epochs * F.col("source_size")
    picked = (F.col("upto") - F.col("size") / 2 <= rest) & (rest > 0)
    times = (epochs + F.when(picked, 1).otherwise(0)).cast("long")
    return rows.select("doc_id", "source", "size", F.col("source_size").cast("long"), F.col("target").cast("double"),
                       (times * F.col("size")).alias("taken"), times.alias("epochs"), "text_md5")


def mixed_documents(docs: DataFrame, labels: DataFrame | None = None, **options) -> DataFrame:
    """The rows of ``docs`` as the mix takes them: each as often as its epochs say, none where it takes none.

    Rows equal in doc_id, source and text share what the mix takes of them as evenly as it goes.
    """
    def named(text_md5: Column) -> list[Column]:
        return [F.xxhash64(F.lit(k), "doc_id", "source", text_md5).alias(f"_g{k}") for k in (1, 2)]

    m = mix(docs, labels, **options).select(*named(F.col("text_md5")), "epochs")
    m = cut(m.groupBy("_g1", "_g2").agg(F.sum("epochs").alias("_e"), F.count("*").alias("_c")).where("_e > 0"))
    rows = split_join(docs.select("*", *named(F.md5("text"))), m, ["_g1", "_g2"])
    alone = rows.where("_c = 1").select(*docs.columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_e"))).alias("_nth"))
    if m.where("_c > 1").isEmpty():
        return alone.select(*docs.columns)
    equal = cut(rows.where("_c > 1").withColumn("_r", F.monotonically_increasing_id()))
    equal = running_sum(equal.withColumn("_chunk", hash_chunk("_r")).withColumn("_b", F.xxhash64("_r")), ["_g1", "_g2"], "_chunk", ["_b", "_r"], F.lit(1), "_nth")
    equal = equal.withColumn("_times", F.floor(F.col("_e") / F.col("_c")) + F.when(F.col("_nth") <= F.col("_e") % F.col("_c"), 1).otherwise(0))
    equal = equal.where("_times > 0").withColumn("_n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times").cast("long"))))
    return alone.select(*docs.columns).unionByName(equal.select(*docs.columns))
