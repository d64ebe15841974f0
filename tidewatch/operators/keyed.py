"""One model's state across batches, shared by the table and stream modes.

``KeyState`` is the whole per-key fold of SURVEY 2.4: requests of a batch
are fitted in order (empty ones counted, not fitted), flags are polled after
each request's last row, the key's first batch reports 0 while the detector
keeps learning, and flags stay set afterwards. The table mode runs it over a
key-partitioned, sorted stream with ``mapInPandas`` (one exchange, one sort,
constant memory per key); the stream mode keeps ``dump()`` in a
``GroupState`` between micro-batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from tidewatch.functions.metrics import CHANGE_PROBABILITY, WARNING_PROBABILITY
from tidewatch.operators.fold import sorted_streams

STATE_SCHEMA = ("first_batch LONG, warning_detected BOOLEAN, change_detected BOOLEAN, "
                "has_detector BOOLEAN, detector ARRAY<DOUBLE>")
OUTPUT_SCHEMA = ("model_id STRING, batch_id LONG, model STRING, axon STRING, n_requests LONG, "
                 "warning_detected BOOLEAN, change_detected BOOLEAN, drift_probability DOUBLE")
OUTPUT_COLUMNS = [c.split()[0] for c in OUTPUT_SCHEMA.split(", ")]


class KeyState:
    __slots__ = ("det", "first", "warn", "chg", "has_det", "any_row")

    def __init__(self, detector: Callable[[], object], saved: tuple | None = None, any_row: bool = False):
        self.det = detector()
        self.any_row = any_row
        if saved is None:
            self.first, self.warn, self.chg, self.has_det = None, False, False, False
        else:
            self.first, self.warn, self.chg, self.has_det, dv = saved
            if self.has_det:
                self.det.load(list(dv))

    def dump(self) -> tuple:
        return (self.first, self.warn, self.chg, self.has_det, self.det.dump())

    def fits(self, xs) -> bool:
        """Whether a request's rows have the model's dimension; others are refused."""
        return not hasattr(self.det, "fits") or xs is None or self.det.fits(xs)

    def request(self, xs) -> tuple[bool, bool]:
        """Fit one request's rows; flags polled after its last row. A row is a
        number (univariate detector) or an array (``vector.VectorDetector``)."""
        w = c = False
        if xs is None or len(xs) == 0:
            return False, False
        self.has_det = True
        det = self.det
        step = det.step
        vec = getattr(det, "vector", False)
        if not vec:                        # a null / NaN input (a row without features) fits nothing
            xs = [x for x in xs if x is not None and x == x]
        if self.any_row:
            for x in xs:
                a, b = step(x if vec else float(x))
                w, c = w or a, c or b
        else:
            for x in xs:
                w, c = step(x if vec else float(x))
        if vec:
            det.end_request()
        return w, c

    def close_batch(self, batch_id: int, w_b: bool, c_b: bool) -> tuple[bool, bool, float]:
        if self.first is None:
            self.first = batch_id
        if batch_id != self.first:           # warm-up: the first batch never alarms
            self.warn, self.chg = self.warn or w_b, self.chg or c_b
        prob = CHANGE_PROBABILITY if self.chg else (WARNING_PROBABILITY if self.warn else 0.0)
        return self.warn, self.chg, prob


def fold_batch_states(requests: DataFrame, detector: Callable[[], object], key: str = "model_id",
                      order: list[str] | None = None, any_row: bool = False) -> DataFrame:
    """Table mode: ``requests`` has ``key, batch_id, model, axon, xs`` plus the
    ``order`` columns; output one state row per (key, batch) with requests."""
    order = order or ["ts", "insert_id"]
    cols = list(dict.fromkeys([key, "batch_id", *order, "model", "axon", "xs"]))
    src = sorted_streams(requests.select(*cols), [key], ["batch_id", *order])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cur_key = cur_batch = None
        st = None
        head = None
        n = 0
        w_b = c_b = False
        for pdf in batches:
            out = []
            keys, bids = pdf[key].tolist(), pdf["batch_id"].tolist()
            models, axons, xss = pdf["model"].tolist(), pdf["axon"].tolist(), pdf["xs"].tolist()
            for i in range(len(keys)):
                k, b = keys[i], bids[i]
                if k == cur_key and not st.fits(xss[i]):
                    continue                  # another dimension: neither fitted nor counted
                if k != cur_key or b != cur_batch:
                    if st is not None:
                        out.append((cur_key, cur_batch, *head, n, *st.close_batch(cur_batch, w_b, c_b)))
                    if k != cur_key:
                        st = KeyState(detector, any_row=any_row)
                    cur_key, cur_batch, head, n, w_b, c_b = k, b, (models[i], axons[i]), 0, False, False
                n += 1
                w, c = st.request(xss[i])
                w_b, c_b = w_b or w, c_b or c
            if out:
                yield pd.DataFrame(out, columns=OUTPUT_COLUMNS)
        if st is not None:
            yield pd.DataFrame([(cur_key, cur_batch, *head, n, *st.close_batch(cur_batch, w_b, c_b))],
                               columns=OUTPUT_COLUMNS)

    return src.mapInPandas(run, OUTPUT_SCHEMA)
