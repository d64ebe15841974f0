"""Vector join, Jaccard join, MaxScore and repeated passages against brute force."""

import collections
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import sha, words
from tidewatch.llm import embed_join, graph, jaccard_join, maxscore, substring


def groups(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        root[find(a)] = find(b)
    return [find(i) for i in range(n)]


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 130)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 130)}}


@pytest.mark.parametrize("cell", [4096, 8])
def test_vectors_against_all_pairs(spark, monkeypatch, cell):
    monkeypatch.setattr(embed_join, "CELL_ROWS", cell)
    rng = np.random.default_rng(1)
    base = rng.normal(size=(30, 6))
    rows = [(int(i), (base[i % 30] + rng.normal(size=6) * (0.02 * (i % 7))).tolist()) for i in range(200)]
    rows += [(200, None), (201, [0.0] * 6), (202, [1.0, None, 0, 0, 0, 0]), (203, [float("nan")] * 6), (204, [float("inf")] + [0.0] * 5),
             (205, [1.0, 2.0]), (206, [2.0, 4.0]), rows[0], (207, rows[3][1]), (208, [19.0, math.sqrt(39.0), 0, 0, 0, 0]), (209, [1.0, 0, 0, 0, 0, 0]),
             (None, rows[3][1]), (None, [0, 0, 0, 0, 0, 7.0]), (None, None)]
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], i) for i, v in rows]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n long")
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in embed_join.join_vectors(df).collect()), key=str)

    def sound(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)

    pairs = []
    for a in range(len(rows)):
        for b in range(len(rows)):
            u, v = rows[a][1], rows[b][1]
            if a != b and sound(u) and sound(v) and len(u) == len(v):
                if math.fsum(x * y for x, y in zip(u, v)) / math.sqrt(math.fsum(x * x for x in u) * math.fsum(x * x for x in v)) >= 0.95:
                    pairs.append((a, b))
    links = collections.Counter(a for a, _ in pairs)
    root = groups(len(rows), pairs)
    least = {r: min((rows[i][0] for i in range(len(rows)) if root[i] == r and rows[i][0] is not None), default=None) for r in set(root)}
    want = sorted(((rows[i][0], links[i], least[root[i]], rows[i][0] == least[root[i]]) for i in range(len(rows))), key=str)
    assert got == want
    assert embed_join.join_vectors(df.limit(0)).count() == 0


def test_max_score_against_all_products(spark, monkeypatch):
    monkeypatch.setattr(maxscore, "SHARD_ROWS", 50)
    rng = np.random.default_rng(2)
    v = rng.integers(-9, 10, (200, 5))
    v[40:60] = v[0]  # ties
    rows = [(int(i), [int(x) for x in v[i]]) for i in range(200)] + [(500, None), (501, [1, None, 1, 1, 1])]
    df = spark.createDataFrame(rows, "vec_id long, vector array<int>")
    got = collections.defaultdict(list)
    for r in maxscore.top_k(df, F.col("vec_id") % 20 == 0, 7, values="vector", scale=1.0).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(range(0, 200, 20))
    for q, found in got.items():
        order = sorted((-int(v[q] @ v[i]), i) for i in range(200) if i != q)[:7]
        assert sorted(found) == [(k + 1, i, -s) for k, (s, i) in enumerate(order)]
    few = maxscore.top_k(df.where("vec_id < 3"), F.col("vec_id") == 0, 7, values="vector", scale=1.0)
    assert few.count() == 2
    assert maxscore.top_k(df.limit(0), F.col("vec_id") == 0, values="vector").count() == 0


def test_top_k_of_repeated_and_large_rows(spark, monkeypatch):
    """Repeated rows and ids are rows of their own, null ids come last, scores beyond doubles are exact and those beyond a long its ends."""
    monkeypatch.setattr(maxscore, "SHARD_ROWS", 40)
    monkeypatch.setattr(maxscore, "TILE_ROWS", 16)
    monkeypatch.setattr(maxscore, "BLOCK_ROWS", 3)
    rng = np.random.default_rng(8)
    rows = [(int(i), rng.normal(size=6).tolist()) for i in range(60)] + [(60, [3.0])]
    rows += [rows[0], rows[0], (0, rows[1][1]), (None, rows[0][1]), (80, [1e9, -1e9, 3.0, 0.0, 0.0, 1.0]), (81, [1e9 + 1, 1e9, 0.0, 0.0, 0.0, 1.0]),
             (82, [1e18, 1.0, 0.0, 0.0, 0.0, 0.0]), (100, [1e18, 2.0, 0.0, 0.0, 0.0, 0.0]), (83, None), (84, [1.0, None]), (85, [float("inf")])]
    df = spark.createDataFrame([(*r, 5) for r in rows], "vec_id long, embedding array<double>, score int")
    got = sorted(((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in maxscore.top_k(df, F.col("vec_id") % 20 == 0, 4).collect()), key=str)
    sound = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for a, (i, v) in enumerate(sound):
        if i is not None and i % 20 == 0:
            scored = sorted(((-max(-2**63, min(2**63 - 1, sum(x * y for x, y in zip(v, w)))), j is None, j or 0, j) for b, (j, w) in enumerate(sound) if a != b))
            want += [(i, n + 1, j, -s) for n, (s, _, _, j) in enumerate(scored[:4])]
    assert got == sorted(want, key=str) and len({r[0] for r in got}) < len(want) / 4


def test_thresholds_spare_rows():
    """With a threshold the lists of weak terms are not traversed and few rows are probed; nothing at or above it is lost."""
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(4000, 16)) ** 3 * 20) * (rng.random((4000, 16)) < 0.2)
    query = np.round(rng.normal(size=16) ** 3 * 20)
    full = x @ query
    threshold = float(np.sort(full)[-20])
    rows, score, probed = maxscore.Postings(x, np.abs(query).max()).search(query, threshold)
    assert sorted(rows) == sorted(np.flatnonzero(full >= threshold)) and (score == full[rows]).all() and probed < 2000


def brute_jaccard(rows):
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    pairs = [(a, b) for a in range(len(rows)) for b in range(len(rows))
             if a != b and sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    links, root = collections.Counter(a for a, _ in pairs), groups(len(rows), pairs)
    return sorted(((rows[i][0], links[i], min((rows[k][0] for k in range(len(rows)) if root[k] == root[i] and rows[k][0] is not None), default=None))
                   for i in range(len(rows))), key=str)


def test_jaccard_of_odd_documents(odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    got = sorted(((r["doc_id"], r["n_links"], r["class_id"]) for r in jaccard_join.join_documents(odd_docs).collect()), key=str)
    assert got == brute_jaccard(rows)
    kept = sorted((r["doc_id"] for r in jaccard_join.one_of_each(odd_docs).collect()), key=str)
    assert kept == sorted([0, 1, 2, 3, 4, 5, 8, 9, 10, 11, 12, None], key=str)
    assert jaccard_join.join_documents(no_docs).count() == 0


def test_jaccard_of_buckets_that_split_and_tile(spark, monkeypatch):
    """A large group of near copies goes through the recursion and the tiles and loses no link."""
    monkeypatch.setattr(jaccard_join, "BUCKET", 8)
    monkeypatch.setattr(jaccard_join, "LEVELS", 2)
    monkeypatch.setattr(jaccard_join, "TILE", 8)
    rnd = random.Random(5)
    base = [f"w{rnd.randint(0, 9999)}" for _ in range(150)]
    rows = []
    for i in range(60):
        t = list(base)
        for _ in range(rnd.randint(0, 3)):
            t[rnd.randrange(len(t))] = f"x{rnd.randint(0, 9999)}"
        rows.append((i, " ".join(t)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["n_links"], r["class_id"]) for r in jaccard_join.join_documents(df).collect()), key=str)
    assert got == brute_jaccard(rows)


def test_jaccard_of_null_ids_and_rows_without_a_set(spark):
    same = "one two three four five six"
    rows = [(None, same, "s0"), (7, same, "s0"), (9, same, "s1"), (None, None, "s0"), (None, None, "s1"), (None, "", "s0"), (None, "", "s1"),
            (3, " \t", "s0"), (3, " \t", "s1"), (4, "x y", "s0"), (4, "x y", "s0")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    joined = sorted(((r["doc_id"], r["n_links"], r["class_id"]) for r in jaccard_join.join_documents(df).collect()), key=str)
    assert joined == sorted([(None, 2, 7), (7, 2, 7), (9, 2, 7), *[(None, 0, None)] * 4, *[(3, 0, 3)] * 2, *[(4, 1, 4)] * 2], key=str)
    kept = sorted((tuple(r) for r in jaccard_join.one_of_each(df).collect()), key=str)
    assert kept == sorted([rows[0], *rows[3:9], rows[9]], key=str)


def test_jaccard_of_mixed_frequent_passages(spark, monkeypatch):
    """Near copies whose common tokens all lie in buckets that split several times keep the recall asked for."""
    monkeypatch.setattr(jaccard_join, "BUCKET", 4)
    rnd = random.Random(11)
    rows = []
    for _ in range(300):
        t = [f"p{k}w{i}" for k in rnd.sample(range(200), 20) for i in range(8)]
        near = list(t)
        for i in (1, 20, 60, 100):
            near[i] = f"x{rnd.randint(0, 9999)}"
        rows += [(len(rows), " ".join(t)), (len(rows) + 1, " ".join(near))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_join.join_documents(df, recall=0.9).select("doc_id", "n_links", "class_id").collect()
    assert all(r["n_links"] <= 1 and r["class_id"] == r["doc_id"] - (r["doc_id"] % 2) * r["n_links"] for r in got)
    assert sum(r["n_links"] for r in got) >= 0.9 * len(rows)


def test_only_texts_that_are_compared_are_shuffled(spark, monkeypatch):
    """Of 3,000 documents 40 are near copies of another: the tiles are joined with little more than those."""
    rnd = random.Random(5)
    texts = [[f"w{rnd.randrange(10**6)}" for _ in range(60)] for _ in range(2960)]
    texts += [[*t[:-1], "changed"] for t in texts[:40]]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    kept, marked = [], jaccard_join._marked
    monkeypatch.setattr(jaccard_join, "_marked", lambda *a, **k: kept.append(marked(*a, **k)) or kept[-1])
    out = {r["doc_id"]: (r["n_links"], r["class_id"]) for r in jaccard_join.join_documents(docs).collect()}
    assert out == {i: (int(i < 40 or i >= 2960), i - 2960 if i >= 2960 else i) for i in range(3000)}
    sent = {r["id"] for r in kept[0].collect()}
    assert {*range(40), *range(2960, 3000)} <= sent and len(sent) < 200
    keys = spark.createDataFrame([(-1,), (5,), (5,)], "k long")
    rows = spark.createDataFrame([(-1,), (5,), (5,), (6,), (None,)], "k long")
    assert sorted(r["k"] for r in marked(rows, "k", keys).collect()) == [-1, 5, 5]


def test_buckets_of_the_same_sets_are_met_once(spark):
    """Paths 1, 2 and 5 hold the same two sets, 3 another two, 4 one; 6 and 7 hold the same three."""
    sets = {1: (10, -20), 2: (-20, 10), 3: (10, 30), 4: (10,), 5: (10, -20), 6: (10, -20, 30), 7: (10, -20, 30)}
    nodes = spark.createDataFrame([(p, n) for p, x in sets.items() for n in x], "path long, node long")

    def met(most):
        out = {}
        for r in jaccard_join._met(nodes, most).collect():
            out.setdefault(r["path"], []).append(r["node"])
            assert r["n"] == len(sets[r["path"]])
        return {p: sorted(x) for p, x in out.items()}

    assert met(None) == met(3) == {1: [-20, 10], 3: [10, 30], 6: [-20, 10, 30]}
    assert met(2) == {1: [-20, 10], 3: [10, 30], 6: [-20, 10, 30], 7: [-20, 10, 30]}  # the large ones split, each for itself


def test_components_of_stars_need_no_round(spark, monkeypatch):
    joins, split_join = [], graph.split_join
    monkeypatch.setattr(graph, "split_join", lambda *a, **k: joins.append(a) or split_join(*a, **k))

    def parts(edges):
        joins.clear()
        df = spark.createDataFrame(edges, "u long, v long")
        return {r["node"]: r["component"] for r in graph.components(df).collect()}

    assert parts([(5, 1), (1, 7), (5, 1), (9, 8), (4, 4), (None, 1)]) == {1: 1, 5: 1, 7: 1, 8: 8, 9: 8} and not joins
    assert parts([(4, 4), (None, 1)]) == {} and not joins
    assert parts([(1, 5), (2, 5), (2, 3)]) == dict.fromkeys((1, 2, 3, 5), 1) and joins


def test_runs_follow_the_splits():
    left = 1 - jaccard_join.RECALL
    for splits in range(jaccard_join.LEVELS + 1):
        runs = jaccard_join.runs_for(jaccard_join.RECALL, 0.8, splits)
        assert jaccard_join.missed(0.8, splits + 1) ** runs <= left
    assert jaccard_join.runs_for(jaccard_join.RECALL, 0.8) == 15


def test_repeats_of_odd_documents(odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    count = collections.Counter(tuple(w[i:i + 35]) for _, t in rows for w in [words(t)] for i in range(len(w) - 34))
    want = []
    for d, t in rows:
        w = words(t)
        keep = [True] * len(w)
        for i in range(len(w) - 34):
            if count[tuple(w[i:i + 35])] > 1:
                keep[i:i + 35] = [False] * 35
        left = b" ".join(x for x, k in zip(w, keep) if k)
        want.append((d, len(w), keep.count(False), sha(left)))
    out = substring.remove_repeats(odd_docs, texts_too=True).collect()
    assert sorted([(r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in out], key=str) == sorted(want, key=str)
    passage = next(r for r in out if r["doc_id"] == 8)
    assert [(s["start"], s["end"]) for s in passage["spans"]] == [(50, 110)]
    assert substring.remove_repeats(no_docs).count() == 0
