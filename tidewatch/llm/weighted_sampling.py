"""Document fingerprints by consistent weighted sampling.

A text is a bag of words, each weighing its number of occurrences. Every
sample k draws for each term a rate r and a level c, both Gamma(2, 1), and an
offset b, uniform, from the term's hash alone (Ioffe 2010). A term of weight w
takes the step t = floor(ln w / r + b) and the rank ln c - r (t - b + 1); the
sample is the (term, t) of least rank. Two texts agree in a sample with a
probability equal to their generalised Jaccard similarity, the sum of the
smaller weights over the sum of the larger ones.

A sample is kept as 16 bits of the hash of (term, t), so unequal samples agree
by chance once in 65,536. These bits replace the lowest bits of the rank's
double, which leaves 36 bits of the rank to decide and lets one minimum carry
both. A text without words has a fingerprint of zeros, which equals that of
other such texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidewatch.llm.text import Words, mix64, slices

SAMPLES = 64
_SLICE = 8           # samples drawn at a time
_TERMS = 32_768      # terms drawn at a time
_U = np.uint64
_HALF = 2.0 ** -32


def _uniforms(terms: np.ndarray, salts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two uniforms in (0, 1) for each (salt, term)."""
    h = mix64(terms[None, :] ^ salts[:, None])
    return ((h >> _U(32)).astype(np.float64) + 0.5) * _HALF, ((h & _U(0xFFFFFFFF)).astype(np.float64) + 0.5) * _HALF


def _salts(samples: np.ndarray, part: int) -> np.ndarray:
    return mix64((samples * 4 + part + 1).astype(_U) * _U(0x9E3779B97F4A7C15))


def ranks(terms: np.ndarray, log_weight: np.ndarray, samples: np.ndarray) -> np.ndarray:
    """(samples x terms) ranks with the sample's 16 bits in their lowest bits."""
    u1, u2 = _uniforms(terms, _salts(samples, 0))
    u3, u4 = _uniforms(terms, _salts(samples, 1))
    b, _ = _uniforms(terms, _salts(samples, 2))
    r = -np.log(u1 * u2)
    t = np.floor(log_weight / r + b)
    rank = np.log(-np.log(u3 * u4)) - r * (t - b + 1.0)
    bits = mix64(terms[None, :] + t.astype(np.int64).astype(_U) * _U(0xD6E8FEB86659FD93)) & _U(0xFFFF)
    raw = rank.view(_U)
    return ((raw & ~_U(0xFFFF)) | bits).view(np.float64)


def signatures(data: np.ndarray, offsets: np.ndarray, samples: int = SAMPLES) -> np.ndarray:
    """(texts x samples) 16-bit samples of the texts in a byte buffer."""
    w = Words(data, offsets)
    n = len(offsets) - 1
    out = np.zeros((n, samples), np.uint16)
    if not len(w.hash):
        return out
    terms, of = np.unique(w.hash, return_inverse=True)
    pair, count = np.unique(w.doc() * len(terms) + of, return_counts=True)
    doc, term = pair // len(terms), pair % len(terms)
    # terms of equal weight share their ranks over all texts of the buffer
    most = int(count.max()) + 1
    weighed, at = np.unique(term * most + count, return_inverse=True)
    hashes, log_weight = terms[weighed // most], np.log((weighed % most).astype(np.float64))
    first = np.concatenate([[0], np.flatnonzero(doc[1:] != doc[:-1]) + 1])
    for k in range(0, samples, _SLICE):
        ks = np.arange(k, min(k + _SLICE, samples))
        rank = np.empty((len(ks), len(weighed)))
        for i in range(0, len(weighed), _TERMS):
            rank[:, i:i + _TERMS] = ranks(hashes[i:i + _TERMS], log_weight[i:i + _TERMS], ks)
        for j in range(len(ks)):
            least = np.minimum.reduceat(rank[j][at], first)
            out[doc[first], k + j] = (least.view(_U) & _U(0xFFFF)).astype(np.uint16)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal samples, row by row."""
    return (a == b).mean(1)


def _packed(sig: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in sig.astype(">u2")], pa.binary())


def unpacked(column, samples: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), ">u2").reshape(-1, samples)


def fingerprint(docs: DataFrame, text: str = "text", out: str = "fingerprint", samples: int = SAMPLES) -> DataFrame:
    """``docs`` with the column ``out``: the fingerprint of the whole ``text`` as binary, two bytes a sample.

    A null text counts as empty. Equal texts have equal fingerprints on any
    machine and in any order. Repeated rows stay; an empty table gives an
    empty table. ``out`` must not be a column of ``docs``.
    """
    if out in docs.columns:
        raise ValueError(f"column {out!r} exists already")
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in slices(batch.column(text)):
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*part.columns, _packed(signatures(data, offsets, samples))], names=schema.names)

    return docs.mapInArrow(run, schema)
