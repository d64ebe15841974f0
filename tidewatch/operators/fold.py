"""Ordered stream fold: a detector per stream key over sorted rows.

Detectors that restart after a change are folded chunk by chunk (``relay``).
For the others (ADWIN, SEED) the input is hash-partitioned by the stream key and sorted inside each
partition (one exchange + one sort, both spillable), then folded with
``mapInPandas``: rows arrive as Arrow batches in sort order, the detector
state of the current key lives in a few Python scalars, and only alarms are
emitted. No group is ever materialised, so a key longer than memory still
streams. Their parallelism comes from keys, and from features when the
detector runs per (key, feature).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators.relay import Relay


def sorted_streams(df: DataFrame, keys: list[str], order: list[str], num_partitions: int | None = None) -> DataFrame:
    parts = df.repartition(num_partitions, *keys) if num_partitions else df.repartition(*keys)
    return parts.sortWithinPartitions(*keys, *order)


def fold_alarms(df: DataFrame, keys: list[str], order: list[str], x: str | list[str],
                detector: Callable[[], object], req: str | None = None,
                carry: list[str] | None = None, poll: str = "request_end") -> DataFrame:
    """Run ``detector()`` over each key's values of ``x`` in ``order``.

    ``x`` may name several columns; the detector then gets ``step(*values)``.
    Output: ``*keys, rn, *carry, warning, change`` for every polled request
    whose flags are set. ``rn`` is the
    1-based position of the polled row among its key's non-null inputs. With ``req`` the flags are
    polled after the last row of each request (``poll="request_end"``) or
    after any row (``poll="any_row"``); without it every row is a request.

    Detectors that restart after a change run through ``relay`` (chunks of the
    global order side by side), others through one task a key.
    """
    if poll not in ("request_end", "any_row"):
        raise ValueError("poll must be 'request_end' or 'any_row'")
    carry = list(carry or [])
    if req and req not in carry:
        carry = [req] + carry
    xcols = [x] if isinstance(x, str) else list(x)
    multi = len(xcols) > 1
    if getattr(detector(), "restarts", False):
        xs = F.array(*[F.col(c).cast("double") for c in xcols]) if multi else F.col(x if isinstance(x, str) else xcols[0])
        run = Relay(df.withColumn("_xs", xs), keys, order, "_xs", detector, req=req, carry=carry, any_row=poll == "any_row")
        return run.alarms().select(*keys, "rn", *carry, "warning", "change")
    cols = list(dict.fromkeys(keys + order + xcols + carry))
    src = sorted_streams(df.select(*cols), keys, order)
    in_fields = {f.name: f for f in src.schema.fields}
    out_schema = T.StructType(
        [in_fields[k] for k in keys] + [T.StructField("rn", T.LongType())]
        + [in_fields[c] for c in carry]
        + [T.StructField("warning", T.BooleanType()), T.StructField("change", T.BooleanType())])
    names = out_schema.names
    any_row = poll == "any_row"
    nk = len(keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cur = object()
        det = None
        rn = 0
        pending = None          # (row tuple) of the open request
        for pdf in batches:
            if pdf.empty:
                continue
            kv = list(zip(*[pdf[k].tolist() for k in keys])) if nk > 1 else pdf[keys[0]].tolist()
            xs = list(zip(*[pdf[c].tolist() for c in xcols])) if multi else pdf[xcols[0]].tolist()
            cv = [pdf[c].tolist() for c in carry]
            rq = pdf[req].tolist() if req else None
            out = []
            for i in range(len(xs)):
                key = kv[i]
                if key != cur:
                    if pending is not None and (pending[-1] or pending[-2]):
                        out.append(pending)
                    pending = None
                    cur, det, rn = key, detector(), 0
                xi = xs[i]
                if not multi and (xi is None or xi != xi):
                    continue                      # null / NaN inputs carry no information: skipped, not counted
                rn += 1
                w, c = det.step(*xi) if multi else det.step(float(xi))
                kt = key if nk > 1 else (key,)
                row = (*kt, rn, *[col[i] for col in cv], w, c)
                if req is None:
                    if w or c:
                        out.append(row)
                    continue
                if pending is not None and pending[nk + 1] != rq[i]:
                    if pending[-1] or pending[-2]:
                        out.append(pending)
                    pending = None
                if any_row and pending is not None:     # OR the flags of the request's rows
                    row = (*row[:-2], row[-2] or pending[-2], row[-1] or pending[-1])
                pending = row
            if out:
                yield pd.DataFrame(out, columns=names)
        if pending is not None and (pending[-1] or pending[-2]):
            yield pd.DataFrame([pending], columns=names)

    return src.mapInPandas(run, out_schema)


def alarms_by(alarms: DataFrame, keys: list[str]) -> DataFrame:
    """Any warning / change per group of alarm rows."""
    return alarms.groupBy(*keys).agg(F.max(F.col("warning").cast("int")).cast("boolean").alias("warning"),
                                     F.max(F.col("change").cast("int")).cast("boolean").alias("change"))
