"""Shards, mix, personal data, toxicity, code lengths, tokens and the pipeline."""

import collections
import math
import os
import pickle
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import sha, words
from tidewatch.llm import bpe, ctw, mixing, pii, sharding, toxicity


def test_shards_of_odd_documents(odd_docs, no_docs):
    out = sharding.shard_documents(odd_docs, shards=4).collect()
    assert len(out) == odd_docs.count()
    count = collections.Counter(r["shard"] for r in out)
    assert max(count.values()) - min(count.values()) <= 1 and len(count) == 4
    for s in count:
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(count[s]))
    by_id = {r["doc_id"]: r for r in out}
    assert (by_id[0]["size"], by_id[0]["text_crc32"], by_id[3]["size"]) == (16, 0, 19)
    assert by_id[3]["text_crc32"] == zlib.crc32(b"one")
    assert sharding.shard_documents(no_docs, shards=4).count() == 0


def test_shards_split_a_hot_group_and_keep_small_ones_whole(spark):
    rows = [(i, "hot") for i in range(200)] + [(200 + i, f"pair {i // 2}") for i in range(100)] + [(300 + i, f"own {i}") for i in range(300)]
    out = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), shards=6).collect()
    assert sorted(collections.Counter(r["shard"] for r in out).values()) == [100] * 6
    places = collections.defaultdict(set)
    for r in out:
        places[r["text_crc32"]].add(r["shard"])
    assert sum(len(s) > 1 for s in places.values()) <= 4
    assert len(places[zlib.crc32(b"hot")]) <= 5


def test_mix_of_odd_documents(odd_docs, no_docs, spark):
    labels = spark.createDataFrame([(5, 1, 0), (5, 0, 0), (10, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    out = mixing.mix(odd_docs, labels).collect()
    size = collections.Counter()
    taken = collections.Counter()
    for r in out:
        size[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert r["taken"] <= 2 * r["size"]
    assert [r["size"] for r in sorted(out, key=lambda r: str(r["doc_id"])) if r["doc_id"] == 0] == [0]
    target = {r["source"]: r["target"] for r in out}
    assert sum(target.values()) == pytest.approx(1.5 * sum(size.values()))
    for s in size:
        largest = max(r["size"] for r in out if r["source"] == s)
        assert target[s] <= 2 * size[s] + 1e-9 and abs(taken[s] - target[s]) <= largest / 2 + 1e-9
    assert sorted(map(str, out)) == sorted(map(str, mixing.mix(odd_docs, labels).collect()))
    assert mixing.mix(no_docs, labels).count() == 0
    assert mixing.mixed_documents(odd_docs, labels).columns == odd_docs.columns


def test_personal_data(spark, odd_docs, no_docs):
    texts = [None, "", "x@y.z..", "a@b.c_d@e.f", "300.1.1.1.5 0001.2.3.4 1.2.3.256", "+1 (274) 555-9629 +12 3", "4418452524842581 4418452524842582",
             "é😀 a.b@c.de", "IBAN GB82 WEST 1234 5698 7654 32", "GB82 WEST 1234 5698 7654 33", "call 555-123-4567", "number 555-123-4567",
             "9" * 30_000, "a." * 20_000 + "@", "a@b" + ".c" * 20_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in pii.find_pii(df).collect()}
    assert got[0] == got[1] == got[9] == got[11] == got[12] == got[13] == []
    assert got[2] == [("email", 0, 5)]
    assert got[3] == [("email", 0, 5), ("email", 5, 11)]
    assert got[4] == [("ip", 12, 22)]
    assert got[5] == [("phone", 0, 17)]
    assert got[6] == []  # one run of 32 digits
    assert got[7] == [("email", 3, 11)]
    assert got[8] == [("iban", 5, 32)] and got[10] == [("tel", 5, 17)]
    assert got[14] == [("email", 0, len(texts[14]))]
    clean = {r["doc_id"]: r["text"] for r in pii.redact(df).collect()}
    assert clean[0] is None and clean[10] == "call [TEL]" and clean[7] == "é😀 [EMAIL]"
    assert pii.redact(odd_docs).columns == odd_docs.columns and pii.redact(no_docs).count() == 0


def test_account_and_local_numbers_beside_words_numbers_and_stops(spark):
    de, gb, no = "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "NO93 8601 1117 947"
    tel = "555-123-4567"
    ibans = [(f"IBAN {de} Thanks", [de]), ("IBAN DE89 3704 0044 0532 0130 00 OR pay", ["DE89 3704 0044 0532 0130 00"]), (f"{de} 2024", [de]),
             (f"{de}.", [de]), (f"Pay {gb} NOW.", [gb]), (f"{no} 12 A {de} {gb} AND {gb}", [no, de, gb, gb]), (f"AB12 {gb} X", [gb]),
             (f"{de} DE89370400440532013001 X", [de]), (f"{de}X {de}x x{de}", []), ("DE89 3704 0044 0532 0130 00 7", ["DE89 3704 0044 0532 0130 00"]),
             (f"{de} " * 3000, [de] * 3000), ("AB12 " * 6000, [])]
    # a country that is not registered: 98 less the remainder of the number with 00
    body = "1234567890AB"
    check = 98 - int("".join(str(int(c, 36)) for c in f"{body}ZZ00")) % 97
    ibans.append((f"ZZ{check:02d}{body} Then", [f"ZZ{check:02d}{body}"]))
    tels = [(f"Tel. {tel}", [tel]), (f"call - {tel}", [tel]), (f"(phone) {tel}.", [tel]), (f"Call us ({tel}) or", [f"({tel}"]), (f"phone...{tel} Ask", [tel]),
            (f"call 12 {tel}", []), (f"call 1-{tel}", []), (f"call 5{tel}", []), ("call 1 (555) 123-4567", []), ("tel +1 555-123-4567", [])]
    rows = [(i, t) for i, (t, _) in enumerate(ibans + tels)]
    got = {r["doc_id"]: r["spans"] for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (t, want) in enumerate(ibans + tels):
        found = [s for s in got[i] if s["kind"] == ("iban" if i < len(ibans) else "tel")]
        assert [s["text"] for s in found] == want, t[:80]
        assert all(t[s["start"]:s["end"]] == s["text"] for s in found)
    clean = pii.redact(spark.createDataFrame([(0, f"IBAN {de} Thanks. Tel. {tel}")], "doc_id long, text string")).first()["text"]
    assert clean == "IBAN [IBAN] Thanks. Tel. [TEL]"


def test_toxicity_learns_a_word_and_scores_odd_documents(spark, odd_docs, no_docs):
    rng = np.random.default_rng(0)
    vocabulary = [f"w{i}" for i in range(300)]
    rows, marks = [], []
    for i in range(1200):
        t = [vocabulary[k] for k in rng.integers(0, 300, 30)]
        toxic = i % 4 == 0
        if toxic:
            t[int(rng.integers(0, 30))] = "vile"
        rows.append((i, " ".join(t), "en"))
        marks.append((i, int(toxic), 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([*marks, (None, 1, 0), (5, None, 0)], "doc_id long, toxic int, quality int")
    model = toxicity.train(docs, labels)
    out = toxicity.score(docs, model).collect()
    held = [r for r in out if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    right = sum((r["score"] >= 0.7) == (r["doc_id"] % 4 == 0) for r in held)
    assert right / len(held) > 0.97
    odd = toxicity.score(odd_docs, model).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in odd)
    assert toxicity.score(no_docs, model).count() == 0
    assert toxicity.train(docs, labels.limit(0)).out_bias < 0


def test_toxicity_fits_one_row_per_id(spark, monkeypatch):
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 3 != 1]
    hot = ids[0]
    rows = [(i, f"text of {i}", "en") for i in ids] + [(hot, f"copy {k % 7}", "fr") for k in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, toxic int")
    fitted = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, y, lang, weight: fitted.append(([x.tolist() for x in texts], y.tolist(), lang)))
    for k in (1, -1):
        toxicity.train(spark.createDataFrame(rows[::k], "doc_id long, text string, lang string"), labels)
    assert len(fitted[0][0]) == len(ids) and fitted[0] == fitted[1]
    assert fitted[0][1] == [i % 2 for i in ids]


def test_toxicity_learns_from_rows_beyond_the_first_draw(spark, monkeypatch):
    """A word that no drawn row has, in short texts and at the end of long ones; all rows reach the passes, once each."""
    monkeypatch.setattr(toxicity, "CHUNK", 1000)
    rng = np.random.default_rng(1)
    vocabulary = [f"w{i}" for i in range(300)]
    ids = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 3 != 1]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in ids], "doc_id long, toxic int")
    first = {0: [], 1: []}
    for r in labels.orderBy(F.xxhash64("doc_id")).collect():
        first[r["toxic"]].append(r["doc_id"])
    drawn = {i for k in first for i in first[k][:50]}
    rows = []
    for i in range(3000):
        t = [vocabulary[k] for k in rng.integers(0, 300, 9000 if i % 400 == 0 else 30)]
        if i % 4 == 0:
            t[-1] = "vile" if i in drawn else "nasty"
        rows.append((i, " ".join(t), ["en", None][i % 2]))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen, refine = [], toxicity.refine

    def watched(every, model):
        seen.extend(r["doc_id"] for r in every.select("doc_id").collect())
        return refine(every, model)

    monkeypatch.setattr(toxicity, "refine", watched)
    out = toxicity.score(docs, toxicity.train(docs, labels, limit=100)).collect()
    assert sorted(seen) == ids
    held = [r for r in out if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert sum((r["score"] >= 0.7) == (r["doc_id"] % 4 == 0) for r in held) / len(held) > 0.97
    again = toxicity.score(docs, toxicity.train(docs, labels, limit=100)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_toxicity_model_of_many_passes_stays_small_in_the_driver(spark, monkeypatch):
    """A shipped model holds its known buckets; a pass's broadcast goes with it; changes come in slices, of any size the same."""
    rng = np.random.default_rng(4)
    texts = [rng.integers(0, 1 << toxicity.BITS, 50).astype(np.int32) for _ in range(40)]
    model = toxicity.new_model(texts * 2)
    shipped = pickle.dumps(model)
    assert len(shipped) < 1 << 20
    again = pickle.loads(shipped)
    assert (again.rows == model.rows).all() and (again.emb == model.emb).all()

    rows = [(int(i), [int(k) for k in t], "en", int(i % 2), None) for i, t in enumerate(texts * 2)]
    every = spark.createDataFrame(rows, "doc_id long, words array<int>, lang string, toxic int, fitted boolean").repartition(3, "doc_id")
    shared, fetched = [], []
    send, arrow = type(spark.sparkContext).broadcast, type(every).toArrow
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda sc, v: shared.append(send(sc, v)) or shared[-1])
    monkeypatch.setattr(type(every), "toArrow", lambda df: fetched.append(arrow(df)) or fetched[-1])
    whole = toxicity.refine(every, pickle.loads(shipped))
    assert len(shared) == toxicity.ROUNDS + 1 and not any(os.path.exists(b._path) for b in shared)
    monkeypatch.setattr(toxicity, "FETCH", 100)
    fetched.clear()
    sliced = toxicity.refine(every, pickle.loads(shipped))
    assert max(len(t) for t in fetched if "own" in t.column_names) <= 100
    assert (whole.emb == sliced.emb).all() and (whole.seen == sliced.seen).all() and (whole.out == sliced.out).all()


def test_toxicity_responses_of_pieces_are_those_of_whole_texts(monkeypatch):
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 50, n) for n in (0, 1, 2, 7, 8, 9, 40, 41, 100)]
    model = toxicity.new_model(texts * 2)
    whole = toxicity.Trainer(model).respond(texts)
    monkeypatch.setattr(toxicity, "PIECE", 8)  # texts of several pieces, also of one word more
    pieces = toxicity.Trainer(model).respond(texts)
    for w in toxicity.WIDTHS:
        assert np.allclose(whole[0][w], pieces[0][w], atol=1e-6) and (whole[1][w] == pieces[1][w]).mean() > 0.99


def test_code_lengths_against_a_recursive_tree(spark, odd_docs, no_docs):
    texts, train = ["abab", "abba abab", None, "", "ba é", "zzz"], [True, True, True, False, False, True]
    df = spark.createDataFrame(list(zip(range(6), texts, train)), "doc_id long, text string, t boolean")
    got = {r["doc_id"]: r for r in ctw.score(df, F.col("t")).collect()}
    depth, count = ctw.DEPTH, {}

    def bytes_of(t):
        return [255] * depth + list((t or "").encode()) + [255]

    def steps(q):
        for p in range(depth, len(q)):
            for j in range(8):
                yield p, (1 << j) | (q[p] >> (8 - j)), (q[p] >> (7 - j)) & 1

    for t, f in zip(texts, train):
        q = bytes_of(t)
        for p, node, bit in steps(q) if f else ():
            for d in range(depth + 1):
                count.setdefault((tuple(q[p - i] for i in range(1, d + 1)), node), [0, 0])[bit] += 1
    kids = collections.defaultdict(list)
    for ctx, node in count:
        if ctx:
            kids[ctx[:-1], node].append(ctx)

    def weighted(ctx, node):
        a, b = count[ctx, node]
        own = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
        if len(ctx) == depth:
            return own, 1.0
        both = np.logaddexp(own, sum(weighted(c, node)[0] for c in kids[ctx, node]))
        return both - math.log(2), math.exp(own - both)

    def one(q, p, d, node):
        ctx = tuple(q[p - i] for i in range(1, d + 1))
        if (ctx, node) not in count:
            return 0.5
        a, b = count[ctx, node]
        k = (b + 0.5) / (a + b + 1)
        if d == depth:
            return k
        w = weighted(ctx, node)[1]
        return w * k + (1 - w) * one(q, p, d + 1, node)

    tokens = collections.Counter()
    for t, f in zip(texts, train):
        if f:
            tokens.update([w.lower() for w in words(t)] + [b"\n end"])
    n, v = sum(tokens.values()), len(tokens)
    for i, t in enumerate(texts):
        q = bytes_of(t)
        want = sum(math.log10(x if bit else 1 - x) for p, node, bit in steps(q) for x in [one(q, p, 0, node)])
        assert got[i]["score"] == pytest.approx(want, rel=1e-5)
        base = sum(math.log10((tokens[w] + 1) / (n + v + 1)) for w in [x.lower() for x in words(t)] + [b"\n end"])
        assert got[i]["base_score"] == pytest.approx(base, rel=1e-9) and got[i]["train_tokens"] == n
        assert got[i]["n_known"] == sum(tokens[w] > 0 for w in [x.lower() for x in words(t)] + [b"\n end"])
    assert ctw.score(odd_docs, F.col("doc_id") % 2 == 0).count() == odd_docs.count()
    assert ctw.score(no_docs, F.lit(True)).count() == 0


def test_tokens_equal_the_library(spark, odd_docs, no_docs):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(bpe.default_path())
    texts = ["", None, "Hello  World", "<|endoftext|>x<|startoftext|>", "ΣΑΣ İstanbul ﬁ", "日本語 12 can't I'LL 👍🏽", "a" * 3000, "''s't", "\x1c\x85　 ½Ⅷ", "\U0001b434x"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in bpe.encode(df, lists=True).collect():
        e = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False)
        assert (r["ids"], r["n_tokens"], r["decoded"]) == (e.ids, len(e.ids), library.decode(e.ids, skip_special_tokens=False))
        assert r["ids_sha256"] == sha(" ".join(map(str, e.ids)).encode())
    t = bpe.Tokenizer(bpe.default_path())
    for k in range(1, 70):
        w = ("thequickbrownfox" * 5)[:k].encode()
        first = [t.ids[t.letters[b]] for b in w[:-1]] + [t.ids[t.letters[w[-1]] + t.end]]
        assert t.merge_word(first) == library.encode(w.decode(), add_special_tokens=False).ids
    assert bpe.encode(odd_docs).count() == odd_docs.count() and bpe.encode(no_docs).count() == 0


def test_pipeline_runs_all_stages(spark):
    import corpus_pipeline
    from tidewatch.session import table_path

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(table_path(sf, "documents"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
    tokens = corpus_pipeline.run(spark, sf)
    assert 0 < tokens.count() < 2 * docs.count()


def test_a_hot_id_spreads_over_chunks(spark):
    """A third of the rows has one id, some of them equal: keys, chunks and shards spread as with unique ids, the mix stays exact."""
    rows = [(7, f"text {i // 3} of the hot id", "s", 0) for i in range(300)] + [(100 + i, f"own words {i}", "s", 0) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, extra int")
    m = mixing.mix(docs).collect()
    taken, target = sum(r["taken"] for r in m), m[0]["target"]
    assert len(m) == 900 and abs(taken - target) <= 3
    hot = [r for r in m if r["doc_id"] == 7]
    assert 0.3 < sum(r["epochs"] > 1 for r in hot) / len(hot) < 0.7          # the half of an epoch, sampled
    got = collections.Counter((r["doc_id"], r["text"]) for r in mixing.mixed_documents(docs).collect())
    assert sum(len(words(t)) * n for (_, t), n in got.items()) == taken
    per_text = collections.Counter()
    for r in hot:
        per_text[r["text_md5"]] += r["epochs"]
    assert sorted(per_text.values()) == sorted(n for (i, _), n in got.items() if i == 7)
    shards = collections.Counter(r["shard"] for r in sharding.shard_documents(docs, shards=9).collect())
    assert set(shards.values()) == {100}


def test_personal_data_against_the_plain_patterns(spark):
    """Random texts of the characters that matter: the base kinds are what the patterns find, leftmost and without retries."""
    import random
    import re
    rnd = random.Random(11)
    pieces = ["a.b@c.de", "x@y", "@", ".", "1.2.3.4", "256.1.1.1", "01.2.3.255", "4242 4242 4242 4242", "4111-1111-1111-1111", "+1 (555) 010-9999",
              "+49.30.1234567", "+", "(", ")", "-", " ", "  ", "é", "😀", "9", "12", "345", "abc", "%+_", "\n", "\t"]
    texts = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 14))) for _ in range(3000)]

    def luhn(d):
        return sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(reversed(d))) % 10 == 0

    def plain(t):
        digits = lambda s: re.sub("[^0-9]", "", s)
        rules = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
                 ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
                 ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
                 ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15)]
        return [(k, m.start(), m.end()) for k, p, ok in rules for m in re.finditer(p, t) if ok(m.group())]

    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = 0
    for r in pii.find_pii(df).collect():
        base = [(s["kind"], s["start"], s["end"]) for s in r["spans"] if s["kind"] in pii.BASE]
        assert base == plain(texts[r["doc_id"]]), texts[r["doc_id"]]
        found += len(base)
    assert found > 1000


def test_scores_from_the_convolutions(spark):
    """The forward pass word by word: embeddings, taps, maxima and the output layer of a fitted model."""
    rng = np.random.default_rng(5)
    texts = [rng.integers(0, 200, rng.integers(0, 12)) for _ in range(60)]
    y = np.array([1.0 if 3 in t else 0.0 for t in texts], np.float32)
    model = toxicity.fit(texts, y, ["en"] * 60)
    fresh = [rng.integers(0, 300, n) for n in (0, 1, 2, 3, 9)]
    got = toxicity.score_buckets(model, model.tables(), np.concatenate(fresh), np.concatenate([[0], np.cumsum([len(t) for t in fresh])]))
    zero = np.zeros(toxicity.DIM)
    for t, s in zip(fresh, got):
        x = [model.emb[model.rows[b]].astype(float) for b in t] + [zero] * 3
        hidden = []
        for w in toxicity.WIDTHS:
            z = [sum(x[i + j] @ model.taps[w][j].astype(float) for j in range(w)) for i in range(max(1, len(x) - w + 1))]
            hidden.append(np.maximum(np.max(z, axis=0) + model.bias[w], 0))
        want = 1 / (1 + np.exp(-(np.concatenate(hidden) @ model.out + model.out_bias)))
        assert s == pytest.approx(want, abs=1e-5)
