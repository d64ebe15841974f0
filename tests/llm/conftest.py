import hashlib
import random
import re

import pytest


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and blank texts, ties, repeated rows, a long text, near copies, a clashing extra column."""
    rnd = random.Random(3)
    vocabulary = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7))) for _ in range(400)]
    body = [rnd.choice(vocabulary) for _ in range(120)]
    near = list(body)
    near[60] = "changed"
    passage = [rnd.choice(vocabulary) for _ in range(60)]
    texts = [None, "", "  \n\t", "one", "one two three", " ".join(body), " ".join(near), " ".join(body),
             " ".join([*(rnd.choice(vocabulary) for _ in range(50)), *passage]),
             " ".join([*passage, *(rnd.choice(vocabulary) for _ in range(50))]),
             " ".join(rnd.choice(vocabulary) for _ in range(4000)), "x" * 20_000, "Mail a.b@c.de, card 4242 4242 4242 4242."]
    rows = [(i, t, ["en", "fr", None][i % 3], ["s0", "s1", None][i % 3], len(t or ""), i) for i, t in enumerate(texts)]
    rows += [rows[5], (None, "no id here", None, None, 10, 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size int")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
