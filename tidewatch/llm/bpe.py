"""Byte-pair encoding whose next merge comes from a segment tree over adjacent pair ranks."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

CACHE_WORDS = 400_000  # known words of a worker
GROUP_BYTES = 2 << 20  # texts whose new words are merged together
LONG_WORD = 65  # letters from which a word is merged by itself
_NONE = 1 << 60
_NONE32 = (1 << 31) - 1
_IDS = 1 << 32
_SPECIAL = "\0\0"
_TOPS = (0xFF, 0xFFFF, 0x10FFFF)


def default_path() -> str:
    """The vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class SegmentTree:
    """Minimum over a row of ranks: the root names the leftmost lowest one; a point update takes log n steps."""

    def __init__(self, ranks: list[int]):
        self.size = 1 << max(1, (len(ranks) - 1).bit_length())
        self.low = [_NONE] * (2 * self.size)
        self.low[self.size:self.size + len(ranks)] = ranks
        for i in range(self.size - 1, 0, -1):
            a, b = self.low[2 * i], self.low[2 * i + 1]
            self.low[i] = a if a <= b else b

    def set(self, at: int, rank: int) -> None:
        low, i = self.low, at + self.size
        low[i] = rank
        while i > 1:
            i >>= 1
            a, b = low[2 * i], low[2 * i + 1]
            low[i] = a if a <= b else b

    def leftmost(self) -> int:
        """Position of the leftmost lowest rank, or -1 if no pair can merge."""
        low = self.low
        if low[1] >= _NONE:
            return -1
        i, want = 1, low[1]
        while i < self.size:
            i = 2 * i if low[2 * i] == want else 2 * i + 1
        return i - self.size


class Tokenizer:
    """Encoder and decoder of a tokenizer file: NFC, white space, lower case, a split pattern, bytes, merges."""

    def __init__(self, path: str, tables: dict | None = None):
        tables = tables or unicode_tables()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self._check(spec)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        self.names = {i: t for t, i in self.ids.items()}
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merge.setdefault((self.ids[a], self.ids[b]), (rank, self.ids[a + b]))
        self.letters = self._byte_letters()
        self.letter_ids = np.array([self.ids[x] for x in self.letters], np.int64)
        self.last_ids = np.array([self.ids[x + self.end] for x in self.letters], np.int64)
        self.levels = np.array([max(1, (n - 2).bit_length()) for n in range(LONG_WORD + 1)])     # of the tree over a word's pairs
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        spaces = spec["normalizer"]["normalizers"][1]["pattern"]["Regex"]
        # small classes match faster: patterns for texts of Latin-1, of the basic plane, and of any letters
        self.split = [re.compile(self._plainly(pattern, tables, top)) for top in _TOPS]
        self.spaces = re.compile(self._plainly(spaces, tables, _TOPS[-1]))
        self.astral = re.compile("[\U00010000-\U0010ffff]")
        self.odd = tables["lower"]
        self.odd_any = re.compile("[" + "".join(map(re.escape, self.odd)) + "Σ]")
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names.update({i: t for t, i in self.added.items()})
        tokens = max(self.names) + 1
        self.name_texts = np.array([self.names.get(i, "") for i in range(tokens)], object)
        self.number_texts = np.array([str(i) for i in range(tokens)], object)
        self.added_split = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) or r"(?!)")
        pairs = np.array([a * _IDS + b for a, b in self.merge], np.int64)
        order = np.argsort(pairs)
        self.pair_keys = pairs[order]
        self.pair_ranks = np.array([r for r, _ in self.merge.values()], np.int32)[order]
        self.pair_ids = np.array([i for _, i in self.merge.values()], np.int64)[order]
        self.ids_of: dict[str, str] = {}
        self.text_of: dict[str, str] = {}

    @staticmethod
    def _plainly(pattern: str, tables: dict, top: int) -> str:
        """The pattern with its named classes written as the code-point ranges up to ``top``."""
        for name in (r"\p{L}", r"\p{N}", r"\s"):
            ranges = "".join(f"\\U{a:08x}-\\U{min(b, top):08x}" for a, b in tables[name] if a <= top)
            pattern = re.sub(r"(\[[^\]]*)" + re.escape(name), lambda m, r=ranges: m[1] + r, pattern)  # inside a class
            pattern = pattern.replace(name, f"[{ranges}]")
        return pattern

    @staticmethod
    def _check(spec: dict) -> None:
        """Refuse a file of another layout than the one built here."""
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        pre = [p["type"] for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
        if kinds != ["NFC", "Replace", "Lowercase"] or pre != ["Split", "ByteLevel"] or spec["model"]["type"] != "BPE":
            raise ValueError("this tokenizer file needs other normalizers, splits or models than are built here")

    @staticmethod
    def _byte_letters() -> list[str]:
        """The printable letter of each byte in byte-level vocabularies: itself, or the next one from 256."""
        # fixed values: the bytes that stand for themselves
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        table, more = {b: chr(b) for b in plain}, 256
        for b in range(256):
            if b not in table:
                table[b] = chr(more)
                more += 1
        return [table[b] for b in range(256)]

    def merge_word(self, first: list[int]) -> list[int]:
        """Token ids of one word from the ids of its letters: one merge at a time, whatever the length."""
        ids = list(first)
        n = len(ids)
        if n < 2:
            return ids
        merge = self.merge
        tree = SegmentTree([merge.get((ids[i], ids[i + 1]), (_NONE,))[0] for i in range(n - 1)])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (i := tree.leftmost()) >= 0:
            j = after[i]
            ids[i] = merge[ids[i], ids[j]][1]
            k = after[i] = after[j]
            ids[j] = -1
            if j < n - 1:
                tree.set(j, _NONE)
            if k < n:
                before[k] = i
                tree.set(i, merge.get((ids[i], ids[k]), (_NONE,))[0])
            else:
                tree.set(i, _NONE)
            if (h := before[i]) >= 0:
                tree.set(h, merge.get((ids[h], ids[i]), (_NONE,))[0])
        return [x for x in ids if x >= 0]

    def _normal(self, text: str) -> str:
        if text.isascii():
            return self.spaces.sub(" ", text).lower()
        text = self.spaces.sub(" ", unicodedata.normalize("NFC", text))
        if self.odd_any.search(text):  # letter by letter: a final sigma is no special case
            return "".join([self.odd.get(c) or c.lower() for c in text])
        return text.lower()

    def _plain(self, text: str) -> list[str]:
        text = self._normal(text)
        try:
            text.encode("latin-1")
            return self.split[0].findall(text)
        except UnicodeEncodeError:
            return self.split[2 if self.astral.search(text) else 1].findall(text)

    def words(self, text: str) -> list[str]:
        """Words of a text in order; a special token stands as a word that starts with NUL NUL."""
        out: list[str] = []
        at = 0
        if any(x in text for x in self.added):
            for m in self.added_split.finditer(text):
                out += self._plain(text[at:m.start()])
                out.append(_SPECIAL + m.group())
                at = m.end()
        return out + self._plain(text[at:] if at else text)

    def learn(self, words: set[str]) -> None:
        """Encode words that are not yet known; the memory of known words is bounded and starts anew when full."""
        new = [w for w in words if w not in self.ids_of]
        if len(self.ids_of) + len(new) > CACHE_WORDS:
            self.ids_of.clear()
            self.text_of.clear()
            new = list(words)
        plain = []
        for w in new:
            if w.startswith(_SPECIAL):
                self._keep([w], np.array([self.added[w[len(_SPECIAL):]]]), np.array([1]))
            else:
                plain.append(w)
        if not plain:
            return
        # all new words in one array of letter ids; the last letter of a word has the end mark
        coded = [w.encode() for w in plain]
        size = np.array([len(c) for c in coded])
        data = np.frombuffer(b"".join(coded), np.uint8)
        end = np.cumsum(size)
        letters = self.letter_ids[data]
        letters[end - 1] = self.last_ids[data[end - 1]]
        level = np.where(size > LONG_WORD, 0, self.levels[np.minimum(size, LONG_WORD)])
        for k in np.unique(level).tolist():
            group = np.flatnonzero(level == k)
            if not k:
                for g in group.tolist():
                    ids = self.merge_word(letters[end[g] - size[g]:end[g]].tolist())
                    self._keep([plain[g]], np.array(ids), np.array([len(ids)]))
                continue
            for i in range(0, len(group), 20_000):
                some = group[i:i + 20_000]
                ids, upto = self.merge_words(letters, end[some] - size[some], size[some], 1 << k)
                self._keep([plain[g] for g in some.tolist()], ids, upto)

    def _keep(self, words: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        """The ids of ``words`` (joined, up to ``ends``) and their names, as texts."""
        numbers, names = self.number_texts[ids].tolist(), self.name_texts[ids].tolist()
        a = 0
        for w, b in zip(words, ends.tolist(), strict=True):
            self.ids_of[w] = " ".join(numbers[a:b])
            self.text_of[w] = " ".join(names[a:b])
            a = b

    def _pair(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged id) of pairs; rank _NONE32 where none merges."""
        key = a.astype(np.int64) * _IDS + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        hit = (self.pair_keys[at] == key) & (a >= 0) & (b >= 0)
        return np.where(hit, self.pair_ranks[at], _NONE32), self.pair_ids[at]

    def merge_words(self, letters: np.ndarray, start: np.ndarray, length: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """``merge_word`` of many words at once: one segment tree of ``size`` leaves a word, side by side in an array.

        Words are runs of ``letters``; returned are the ids of all of them, and where each word's end.
        """
        n = len(start)
        ids = np.full((n, size + 2), -1, np.int64)
        there = np.arange(size + 2) < length[:, None]
        ids[there] = letters[(start[:, None] + np.arange(size + 2))[there]]
        rank, _ = self._pair(ids[:, :-2].ravel(), ids[:, 1:-1].ravel())
        low = np.full((n, 2 * size), _NONE32, np.int32)
        low[:, size:] = rank.reshape(n, size)
        i = size
        while i > 1:
            low[:, i // 2:i] = np.minimum(low[:, i:2 * i:2], low[:, i + 1:2 * i:2])
            i //= 2
        after = np.tile(np.arange(1, size + 3), (n, 1))
        before = np.tile(np.arange(-1, size + 1), (n, 1))
        levels = size.bit_length() - 1

        def put(rows: np.ndarray, at: np.ndarray, value: np.ndarray | int) -> None:
            i = at + size
            low[rows, i] = value
            for _ in range(levels):
                i = i >> 1
                low[rows, i] = np.minimum(low[rows, 2 * i], low[rows, 2 * i + 1])

        rows = np.flatnonzero(low[:, 1] < _NONE32)
        while len(rows):
            want = low[rows, 1]
            i = np.ones(len(rows), np.int64)
            for _ in range(levels):  # down to the leftmost leaf that holds the root's rank
                left = low[rows, 2 * i] == want
                i = 2 * i + ~left
            i -= size
            j = after[rows, i]
            merged = self._pair(ids[rows, i], ids[rows, j])[1]
            ids[rows, i] = merged
            ids[rows, j] = -1
            k = after[rows, j]
            after[rows, i] = k
            inner = j < size
            put(rows[inner], j[inner], _NONE32)
            has_next = k < length[rows]
            before[rows[has_next], k[has_next]] = i[has_next]
            put(rows, i, np.where(has_next, self._pair(merged, ids[rows, np.minimum(k, size + 1)])[0], _NONE32))
            h = before[rows, i]
            has = h >= 0
            put(rows[has], h[has], self._pair(ids[rows[has], h[has]], merged[has])[0])
            rows = rows[low[rows, 1] < _NONE32]
        keep = ids >= 0
        return ids[keep], np.cumsum(keep.sum(1))

    def encode(self, text: str) -> list[int]:
        words = self.words(text)
        self.learn(set(words))
        return [int(i) for w in words for i in self.ids_of[w].split(" ")]

    def decode(self, ids: list[int]) -> str:
        """Token names joined by spaces: the file names no decoder."""
        return " ".join([self.names[i] for i in ids])


@lru_cache
def unicode_tables() -> dict:
    """Letters, numbers and odd lower-case forms as the tokenizers library knows them.

    Its tables follow another Unicode version than Python's, so the driver
    asks it once for the class of every code point; the ranges go to the
    tasks.
    """
    from tokenizers import Regex
    from tokenizers.normalizers import Lowercase
    from tokenizers.pre_tokenizers import Split

    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]

    def ranges(pattern: str) -> list[tuple[int, int]]:
        split, got = Split(Regex(pattern), "removed", invert=True), []
        for i in range(0, len(points), 8192):
            for run, _ in split.pre_tokenize_str("".join(map(chr, points[i:i + 8192]))):
                got += map(ord, run)
        out, at = [], 0
        while at < len(got):
            end = at
            while end + 1 < len(got) and got[end + 1] == got[end] + 1:
                end += 1
            out.append((got[at], got[end]))
            at = end + 1
        return out

    lower = Lowercase()
    odd = {chr(c): low for c in points if (low := lower.normalize_str(chr(c))) != chr(c).lower()}
    return {r"\p{L}": ranges(r"\p{L}+"), r"\p{N}": ranges(r"\p{N}+"), r"\s": ranges(r"\s+"), "lower": odd}


_loaded: dict[str, Tokenizer] = {}


def encode(docs: DataFrame, path: str | None = None, text: str = "text", id: str = "doc_id", lists: bool = False) -> DataFrame:
    """Encode and decode every whole text: (id, n_tokens, ids_sha256, decoded_sha256), with ``lists`` also ids and decoded.

    The digests are of the ids in decimal and of the decoded text. Strings of
    special tokens in a text become those tokens. A null text is an empty one
    and has no tokens. Rows are independent: nothing is shuffled, repeated
    rows give equal results, other columns are ignored. ``path`` must name the
    tokenizer file on every executor.
    """
    path = path or default_path()
    tables = unicode_tables()
    kind = docs.schema[id].dataType.simpleString()

    def group(t: Tokenizer, texts: list[str]) -> Iterator[tuple[str, str]]:
        words = [t.words(x) for x in texts]
        t.learn(set().union(*words))
        ids_of, text_of = t.ids_of.__getitem__, t.text_of.__getitem__
        for w in words:
            yield " ".join(map(ids_of, w)), " ".join(map(text_of, w))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        if path not in _loaded:
            _loaded[path] = Tokenizer(path, tables)
        t = _loaded[path]
        for b in batches:
            done: list[tuple] = []
            texts: list[str] = []
            held = 0
            for i in range(len(b) + 1):
                if i == len(b) or held > GROUP_BYTES:
                    for ids, decoded in group(t, texts):
                        row = (ids.count(" ") + 1 if ids else 0, sha256(ids.encode()).hexdigest(), sha256(decoded.encode()).hexdigest())
                        done.append(row + (([int(k) for k in ids.split(" ")] if ids else [], decoded) if lists else ()))
                    texts, held = [], 0
                if i < len(b):
                    texts.append(b.column(1)[i].as_py() or "")
                    held += len(texts[-1])
            kinds = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.string()]
            names = ["n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]
            wide = 5 if lists else 3
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array([r[c] for r in done], kinds[c]) for c in range(wide)]], names=[id, *names[:wide]])

    schema = f"`{id}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if lists else "")
    return docs.select(id, text).mapInArrow(work, schema)
