"""Pipeline stages on odd documents: foreign columns keep their values, nothing crashes, decisions follow the operators."""

import collections

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewatch.llm import bpe, jaccard_join, mixing, pii, stages, toxicity

#: Names that the operators use inside or return.
CLASHING = ["score", "threshold", "flagged", "spans", "_email", "_ip", "_card", "_phone", "_iban", "_tel", "_hits", "_gaps", "_i", "_t", "_n", "_e",
            "_s", "_h", "_own", "words", "cid", "component", "tile", "text_key", "class_id", "n_links", "key", "chunk", "rank", "target", "upto",
            "epochs", "taken", "size", "first", "n_tokens", "with space", "a.b"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Documents of four kinds, one in five of them toxic by a word, and their labels."""
    root = tmp_path_factory.mktemp("stages")
    rows = [(i, " ".join(f"w{(i * 7 + k) % 50}" for k in range(30)) + (" vile vile vile" if i % 5 == 0 else ""), "en", "s") for i in range(200)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(i, i % 2, int(i % 5 == 0)) for i in range(200)], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return str(root)


@pytest.fixture(scope="module")
def clashing(odd_docs):
    """``odd_docs`` with a column of each helper's name, whose values tell their row."""
    docs = odd_docs.drop("size")
    return docs.select("*", *[F.concat(F.lit(c + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("?"))).alias(c) for c in CLASHING]).cache()


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_foreign_columns_keep_their_values(spark, tables, clashing, name, stage):
    out = stage(spark, clashing, tables)
    assert out.columns == clashing.columns and [f.dataType for f in out.schema] == [f.dataType for f in clashing.schema]
    rows = out.collect()
    assert rows
    for r in rows:
        assert all(r[c] == f"{c}:{'?' if r['doc_id'] is None else r['doc_id']}" for c in CLASHING)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_an_empty_table_gives_an_empty_one(spark, tables, clashing, name, stage):
    assert stage(spark, clashing.limit(0), tables).count() == 0


def test_decisions_are_the_operators(spark, tables, clashing, odd_docs):
    """Stage by stage from the operators' own results, on nulls, blanks, repeats, near copies and a long text."""
    whole, labels = spark.read.parquet(f"{tables}/documents.parquet"), spark.read.parquet(f"{tables}/labels.parquet")
    texts = lambda df: collections.Counter((r["doc_id"], r["text"]) for r in df.collect())
    docs = odd_docs.drop("size").unionByName(spark.createDataFrame([(90, "vile vile vile w1 w2", "en", "s0", 20)], odd_docs.drop("size").schema))
    kept = stages.drop_toxic(spark, docs, tables)
    clean = toxicity.score(docs, toxicity.train(whole, labels)).where("not flagged")
    assert texts(kept) == texts(clean)
    once = stages.drop_near_duplicates(spark, docs, tables)
    groups = collections.defaultdict(set)
    for r in jaccard_join.join_documents(docs).collect():
        if r["doc_id"] is not None:
            groups[r["class_id"]].add(r["doc_id"])
    left = [r["doc_id"] for r in once.collect()]
    assert all(sum(left.count(i) for i in ids) == 1 for ids in groups.values()) and None in left
    redacted = {r["doc_id"]: r for r in stages.redact_pii(spark, docs, tables).collect()}
    assert redacted[12]["text"] == "Mail [EMAIL], card [CARD]." and redacted[12]["n_chars"] == len(redacted[12]["text"])
    spans = {r["doc_id"]: r["spans"] for r in pii.find_pii(docs).collect()}
    assert all(redacted[r["doc_id"]]["text"] == r["text"] for r in docs.collect() if not spans[r["doc_id"]])
    taken = collections.Counter(r["doc_id"] for r in stages.mix_sources(spark, docs, tables).collect())
    want = collections.Counter()
    for r in mixing.mix(docs, labels).collect():
        want[r["doc_id"]] += r["epochs"]
    assert taken == +want
    tokens = {r["doc_id"]: r["n_tokens"] for r in stages.count_tokens(spark, docs, tables).collect()}
    assert tokens == {r["doc_id"]: r["n_tokens"] for r in bpe.encode(docs).collect()} and tokens[0] == 0
