"""Keyed drift state on a Structured Streaming query.

Log lines (any streaming ``value STRING`` source) are parsed with the same
expressions as the table mode, reduced to one row per request carrying its
detector inputs (``xs ARRAY<ARRAY<DOUBLE>>``, the request's whole rows), and folded
per model with ``applyInPandasWithState``. The state is typed (scalars and
``array<double>``), never pickled, and survives restarts through the
checkpoint. The logical batch of a request is the day of its timestamp, so
a stream gives the same states as the table mode on the same data; a
micro-batch may carry several logical batches (they are folded in order).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidewatch.config import LogFormat
from tidewatch.operators import detectors as D
from tidewatch.operators.keyed import OUTPUT_COLUMNS, OUTPUT_SCHEMA, STATE_SCHEMA, KeyState
from tidewatch.operators.vector import any_feature
from tidewatch.plans.inputs import requests_of, with_vector_inputs

REJECT = "reject"            # insert id of a refused request; null in state rows
TAGGED_SCHEMA = f"{OUTPUT_SCHEMA}, {REJECT} STRING"
TAGGED_COLUMNS = [*OUTPUT_COLUMNS, REJECT]


def request_inputs(lines: DataFrame, fmt: LogFormat = LogFormat(), signal: Callable | None = None) -> DataFrame:
    """``model_id, model, axon, insert_id, ts, batch_id, xs`` per request."""
    return with_vector_inputs(requests_of(lines, fmt), signal)


def _update(detector: Callable[[], object], any_row: bool, key: tuple, pdfs: Iterator[pd.DataFrame],
            state: GroupState) -> Iterator[pd.DataFrame]:
    # rows of one key in one micro-batch: bounded by the trigger size
    pdf = pd.concat(list(pdfs), ignore_index=True).sort_values(["batch_id", "ts", "insert_id"], kind="stable")
    st = KeyState(detector, state.get if state.exists else None, any_row)
    out = []
    for batch_id, g in pdf.groupby("batch_id", sort=True):
        w_b = c_b = False
        head, n = None, 0
        for xs, model, axon, insert_id in zip(g["xs"], g["model"], g["axon"], g["insert_id"]):
            if not st.fits(xs):               # another dimension: a reject, neither fitted nor counted
                out.append((key[0], int(batch_id), model, axon, None, None, None, None, insert_id or ""))
                continue
            head = head or (model, axon)
            n += 1
            w, c = st.request(xs)
            w_b, c_b = w_b or w, c_b or c
        if n:
            out.append((key[0], int(batch_id), *head, n, *st.close_batch(int(batch_id), w_b, c_b), None))
    state.update(st.dump())
    yield pd.DataFrame(out, columns=TAGGED_COLUMNS)


def keyed_states(inputs: DataFrame, detector: Callable[[], object], any_row: bool = False) -> DataFrame:
    """Per-model state updates of a streaming request DataFrame (update mode), and
    tagged by ``reject`` the requests whose rows have another length than the model's."""
    return inputs.groupBy("model_id").applyInPandasWithState(
        partial(_update, detector, any_row), TAGGED_SCHEMA, STATE_SCHEMA, "update", GroupStateTimeout.NoTimeout)


def detector_factory(detector) -> Callable[[], object]:
    """``(name, options)`` or a factory -> validated factory of a vector detector: a
    univariate detector runs on every feature and any feature's alarm counts."""
    if not callable(detector):
        name, options = detector
        D.make_detector(name, **options)          # validate on the driver
        detector = partial(D.make_detector, name, **options)
    return detector if getattr(detector(), "vector", False) else any_feature(detector)
