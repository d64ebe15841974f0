"""Fingerprints, hard negatives and importance resampling against brute force."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import edits, hard_negatives, resampling, weighted_sampling as ws
from tidewatch.llm.text import Words, buffers


def bag(text):
    return collections.Counter(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def generalised_jaccard(a, b):
    most = sum((a | b).values())
    return sum((a & b).values()) / most if most else 1.0


def slow_signature(text, samples=ws.SAMPLES):
    """One term and one sample at a time, from the definition."""
    data, offsets = buffers(pa.array([text]))
    words = Words(data, offsets)
    count = collections.Counter(words.hash.tolist())
    out = []
    for k in range(samples):
        best = None
        for h, w in count.items():
            term, ks = np.array([h], np.uint64), np.array([k])
            (u1, u2), (u3, u4), (b, _) = (ws._uniforms(term, ws._salts(ks, part)) for part in range(3))
            r, c = -np.log(u1 * u2)[0, 0], -np.log(u3 * u4)[0, 0]
            t = math.floor(math.log(w) / r + b[0, 0])
            rank = math.log(c) - r * (t - b[0, 0] + 1)
            bits = int(ws.mix64(np.array([(h + t * 0xD6E8FEB86659FD93) % 2**64], np.uint64))[0]) & 0xFFFF
            best = min(best or (math.inf, 0), (rank, bits))
        out.append(best[1] if best else 0)
    return out


def test_signatures_from_the_definition():
    texts = ["a b c a b a", "", " \n", "one", "x " * 40 + "y " * 7 + "z", "naïve 東京 東京"]
    data, offsets = buffers(pa.array(texts))
    got = ws.signatures(data, offsets)
    for text, row in zip(texts, got):
        assert row.tolist() == slow_signature(text)
    one = buffers(pa.array([texts[4]]))
    assert (ws.signatures(*one)[0] == got[4]).all()          # whatever stands beside it


def test_collisions_follow_the_generalised_jaccard():
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(rnd.choice(words[:n]) for _ in range(m)) for n, m in itertools.product((5, 20, 60), (10, 40, 200))]
    sig = ws.signatures(*buffers(pa.array(texts)), 4096)
    for i, j in itertools.combinations(range(len(texts)), 2):
        want = generalised_jaccard(bag(texts[i]), bag(texts[j]))
        assert abs((sig[i] == sig[j]).mean() - want) < 0.04


def test_fingerprint_column(odd_docs, no_docs):
    got = ws.fingerprint(odd_docs)
    assert got.columns == [*odd_docs.columns, "fingerprint"] and ws.fingerprint(no_docs).count() == 0
    rows = got.collect()
    assert len(rows) == odd_docs.count()
    by_text = collections.defaultdict(set)
    for r in rows:
        by_text[r["text"]].add(bytes(r["fingerprint"]))
    assert all(len(v) == 1 for v in by_text.values())
    assert by_text[None] == by_text[""] == {bytes(2 * ws.SAMPLES)}
    with pytest.raises(ValueError):
        ws.fingerprint(odd_docs.withColumn("fingerprint", F.lit(1)))


@pytest.mark.parametrize("parts", [1, 7])
def test_edits_against_neighbours(spark, odd_docs, parts):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        docs = odd_docs.unionByName(odd_docs.where("doc_id = 5")).withColumn("fingerprint", F.lit(1)).withColumn("pid", F.lit(9))
        got = edits.edited_fingerprints(docs).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (r[0] is None, -(r[0] or 0)))
    want = []
    for (i, t), (_, n) in zip(rows, rows[1:] + rows[:1]):
        e = edits.edit(t, n)
        assert len(e) <= len(t) and e[:len(t) - len(t) // 3] == t[:len(t) - len(t) // 3]
        sig = ws.signatures(*buffers(pa.array([t, e, n])))
        want.append((-1 if i is None else i, len(t), hashlib.sha256(e.encode()).hexdigest(), sig[0].astype(">u2").tobytes(),
                     sig[1].astype(">u2").tobytes(), float((sig[0] == sig[1]).mean()), float((sig[0] == sig[2]).mean())))
    assert sorted((-1 if r[0] is None else r[0], *r[1:3], bytes(r[3]), bytes(r[4]), *r[5:]) for r in map(tuple, got)) == sorted(want)


def test_edits_of_one_and_of_no_document(spark, no_docs):
    assert edits.edited_fingerprints(no_docs).count() == 0
    one = edits.edited_fingerprints(spark.createDataFrame([(7, "abc def")], "doc_id long, text string")).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abc dab").hexdigest() and one["near_next"] == 1.0


def mined(rows, scale, positives=5, negatives=3):
    """Every pair, in Python integers. rows: (id, label, vector)."""
    sound = []
    for i, label, v in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) or not math.isfinite(x * scale) for x in v):
            continue
        sound.append((i, label, [math.floor(x * scale) for x in v]))
    clip = lambda s: max(-2**63, min(2**63 - 1, s))
    last = lambda i: (i is None, i or 0)
    out = []
    for a, (i, label, v) in enumerate(sound):
        if i is None or i % 3:
            continue
        scored = [(clip(sum(x * y for x, y in zip(v, w))), j, lab) for b, (j, lab, w) in enumerate(sound) if a != b]
        scored.sort(key=lambda s: (-s[0], last(s[1])))
        for p, j, _ in [s for s in scored if s[2] == label][:positives]:
            hits = [s for s in scored if s[2] != label and 50 * p <= 100 * s[0] <= 95 * p][:negatives]
            out += [(i, j, n + 1, k, p, s) for n, (s, k, _) in enumerate(hits)]
    return sorted(out, key=str)


@pytest.mark.parametrize("huge", [False, True])
def test_hard_negatives_against_all_pairs(spark, monkeypatch, huge):
    monkeypatch.setattr(hard_negatives, "SHARD_ROWS", 40)
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 12)
    monkeypatch.setattr(hard_negatives, "TILE_ROWS", 16)
    rng = np.random.default_rng(2)
    base = rng.normal(size=(6, 70))
    rows = [(int(i), int(i % 4), (base[i % 6] + rng.normal(size=70)).tolist()) for i in range(110)]
    rows += [rows[3], rows[3], (3, 2, rows[3][2]), (None, 1, rows[6][2]), (200, None, rows[1][2]), (201, 1, None), (204, 1, [1.0, None]),
             (207, 1, [float("nan")] * 70), (210, 1, [float("inf")] * 70), (213, 2, [0.0] * 70), (216, 1, []), (219, 3, [2.0, 1.0]),
             (222, 0, rows[9][2]), (225, 0, rows[9][2])]
    if huge:
        big = [(300 + 3 * i, i % 2, [x * 10.0 ** e for x in rows[i % 8][2]]) for i, e in enumerate([4, 6, 9, 9, 12, 30, 30, 150, 307])]
        rows = rows[:60] + rows[110:] + big
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, label long, embedding array<double>, row int")
    got = hard_negatives.mine(df, F.col("vec_id") % 3 == 0, F.col("label"))
    assert sorted(map(tuple, got.collect()), key=str) == mined(rows, 256.0)


def test_hard_negatives_of_no_rows(spark):
    none = spark.createDataFrame([], "vec_id long, label long, embedding array<float>")
    assert hard_negatives.mine(none, F.col("vec_id") % 3 == 0, F.col("label")).count() == 0


def test_products_are_exact_at_any_width():
    rng = np.random.default_rng(4)
    for dim, most in [(1, 5), (64, 2**18), (1000, 300), (130, 2**40)]:
        a, b = (rng.integers(-most, most + 1, size=(7, dim)).astype(float) for _ in range(2))
        a[0], b[0] = most, -most
        want = [[sum(int(x) * int(y) for x, y in zip(u, v)) for v in b] for u in a]
        clipped = [[max(-2**63, min(2**63 - 1, x)) for x in row] for row in want]
        assert hard_negatives.scores(a, b, False).tolist() == clipped
        if max(abs(x) for row in want for x in row) < 2**62:
            assert hard_negatives.scores(a, b, True).tolist() == want


def slow_features(text, n):
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())
    runs = [b" ".join(words[i:i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]
    return len(words), [zlib.crc32(r) for r in runs]


def resampled(docs, target, n, buckets, percent, least):
    s, t = collections.Counter(), collections.Counter()
    feats = [slow_features(text, n) for _, text in docs]
    for _, f in feats:
        s.update(x % buckets for x in f)
    for text in target:
        t.update(x % buckets for x in slow_features(text, n)[1])
    ns, nt = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (ns + buckets) / ((s[b] + 1.0) * (nt + buckets)))) for b in range(buckets)]
    rows = []
    for (i, _), (w, f) in zip(docs, feats):
        weight = sum(gain[x % buckets] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), w >= least])
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    many = len(able) * percent // 100
    out = [(*r[:4], i + 1 if i < many else None) for i, r in enumerate(able)] + [(*r[:4], None) for r in rows if not r[4]]
    return sorted(out, key=str)


@pytest.mark.parametrize("n, heavy", [(1, 1000), (1, 4), (2, 1000), (3, 4)])
def test_resampling_against_whole_counts(spark, odd_docs, monkeypatch, n, heavy):
    monkeypatch.setattr(resampling, "HEAVY", heavy)
    rnd = random.Random(n)
    words = ["der", "Die", "das", "x1", "naïve", "ÉTÉ", "z"]
    lines = [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 6))) for _ in range(12)]
    many = [(100 + i, "\n".join(rnd.choice(lines) for _ in range(rnd.randint(0, 9))), "n", i) for i in range(80)]
    many += [many[0], many[0], (100, "other text of a repeated id", "n", 0), (None, lines[3], "n", 1), (101, "a\r\nB\n\n\nc,d", "n", 2)]
    docs = odd_docs.select("doc_id", "text", F.col("lang").alias("key"), F.col("size").alias("rid")).unionByName(
        spark.createDataFrame(many, "doc_id long, text string, key string, rid int"))
    target = spark.createDataFrame([(0, "das x1\nx1 z"), (1, None), (2, lines[2])], "item_id long, text string")
    got = resampling.resample(docs, target, n=n, buckets=97, percent=30, min_words=5)
    want = resampled([(r["doc_id"], r["text"]) for r in docs.collect()], ["das x1\nx1 z", lines[2]], n, 97, 30, 5)
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_resampling_of_no_rows(no_docs, odd_docs):
    target = odd_docs.select("text")
    assert resampling.resample(no_docs, target).count() == 0
    assert resampling.resample(odd_docs, target.limit(0), percent=100, min_words=0).where("rank is null").count() == 0
