"""Detector folds over range-partitioned rows, so that no key is bound to one task.

Rows are range-partitioned and sorted by (key, order): a partition is a chunk
of the global order, whatever the sizes of the keys. A key that lies within a
chunk is folded there. A key that goes on over several chunks is folded in
three passes, all with the arithmetic of the sequential fold:

1. every chunk folds its first key from a fresh state (speculation), beside
   all other chunks, and notes where its detectors restart;
2. every chunk that goes on with the key of the chunk before it starts again
   from that chunk's end state, until a restart at a row where the
   speculation restarted too. From there on both runs are equal, so the rest
   of the speculation stands, and with it the chunk's end state;
3. chunks whose entry state the second pass changed (a stretch longer than a
   chunk without a common restart) are folded in order, a task for each such
   key, and only until a chunk's entry state is the one it was folded from.

The second pass leaves nothing to the third where detectors restart at least
about once a chunk. A stretch without restarts is a recurrence over all its
rows and stays one task in the third pass: the rows stream through it, its
memory does not grow.

The chunk table (first and last key of each partition, end states, restarts)
has two rows a partition and goes to the driver; rows and alarms do not.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators.sizes import broadcast_small
from tidewatch.session import scratch_path

ROW, ALARM, HEAD, REJECT, SUMMARY, STATE = range(6)
NO_FEATURE = -1
NOTED = 4096           # restarts of a chunk's run noted, over all features; a run that joins at none of them goes on to the chunk's end


class Segment:
    """One key's rows within a chunk, folded from ``entry`` (None: fresh), beside the speculation ``spec`` if given.

    ``entry``: dim, dumps (a detector state a feature), tail (request, warning,
    change of the request that the chunk before left open). ``spec``: summary
    of the speculative run, at whose restarts a feature's run ends.
    """

    def __init__(self, detector: Callable[[], object], any_row: bool, pid: int, first: bool, key_row: pa.RecordBatch,
                 entry: dict | None = None, spec: dict | None = None, skip: bool = False):
        self.detector, self.any_row, self.pid, self.first, self.key_row, self.skip = detector, any_row, pid, first, key_row, skip
        self.dets: list = []
        self.active: list[int] = []
        self.restarts: list[list[int]] = []
        self.cuts: list[int | None] = []
        self.n = self.steps = self.seq = 0
        self.first_req = self.last_req = self.open_row = self.group = None
        self.last = spec["last"] if spec is not None else None     # whether it ends its chunk; a speculation learns it at its end
        self.keep = False
        self.open: tuple[bool, bool] | None = None       # flags of the request that is not over yet
        self.entry_dim = entry["dim"] if entry else None
        self.tail = entry["tail"] if entry else None
        # a run beside a speculation over another dimension has nothing in common with it
        self.apart = spec is not None and self.entry_dim is not None and spec["dim"] != self.entry_dim
        self.joins = None if spec is None or self.apart else [set(r) for r in spec["restarts"]]
        if self.entry_dim is not None:
            self._create(self.entry_dim)
            for d, v in zip(self.dets, entry["dumps"]):
                d.load(v)

    def _create(self, dim: int) -> None:
        self.dets = [self.detector(f) if getattr(self.detector, "by_feature", False) else self.detector() for f in range(dim)]
        self.active = list(range(dim))
        self.restarts = [[] for _ in range(dim)]
        self.cuts = [None] * dim
        self.noted = max(16, NOTED // dim)

    def over(self) -> bool:
        """All features run as the speculation does from here on."""
        return self.joins is not None and bool(self.dets) and not self.active and self.open is None

    def _step(self, f: int, x) -> tuple[bool, bool, bool]:
        """(warning, change, whether the run joins the speculation here)."""
        w, c = self.dets[f].step(*x) if isinstance(x, list) else self.dets[f].step(x)
        if not c or not getattr(self.dets[f], "restarts", False):     # a window that only shrinks has no common restart
            return w, c, False
        if self.joins is not None:
            return w, c, self.steps in self.joins[f]
        if len(self.restarts[f]) < self.noted:
            self.restarts[f].append(self.steps)
        return w, c, False

    def value(self, i: int, x, req, out: list) -> None:
        """One value (a number, or a list of arguments of the detector); with ``req`` the flags are polled at the end of its request."""
        if x != x:                       # null and NaN carry no information: skipped, not counted
            return
        if not self.dets:
            self._create(1)
        if self.open is not None and req != self.last_req:
            self.end_request(out)
            if self.over():
                return
        self.n += 1
        self.steps += 1
        w, c, joined = self._step(0, x)
        if joined:
            self.active, self.cuts[0] = [], self.n
        if req is None:
            if w or c:
                out.append((i, 0, self.n, w, c))
            return
        if self.any_row:
            if self.open is not None:
                w, c = w or self.open[0], c or self.open[1]
            elif self.first_req is None and self.tail is not None:
                w, c = w or self.tail[1], c or self.tail[2]
        if self.first_req is None:
            self.first_req = req
        self.open, self.open_row, self.last_req = (w, c), i, req

    def end_request(self, out: list) -> None:
        w, c = self.open
        if w or c:
            out.append((self.open_row, 0, self.n, w, c))
        if self.cuts[0] is not None:     # the request in which the runs joined is this run's
            self.cuts[0] = self.n
        self.open = None

    def request(self, i: int, rows: list, out: list) -> bool:
        """One request of whole rows; False, and nothing fitted, if a row's length is not the key's dimension."""
        rows = [v for v in rows if v]
        if rows and not self.dets:
            self._create(len(rows[0]))
        if any(len(v) != len(self.dets) for v in rows):
            return False
        self.n += 1
        flags: dict[int, tuple[bool, bool]] = {}
        joined = []
        for v in rows:
            self.steps += 1
            for f in self.active:
                x = v[f]
                if x is None or x != x:
                    continue
                w, c, joins = self._step(f, x)
                if joins and self.cuts[f] is None:
                    self.cuts[f] = self.n
                    joined.append(f)
                if self.any_row and f in flags:
                    w, c = w or flags[f][0], c or flags[f][1]
                flags[f] = (w, c)
        out.extend((i, f, self.n, w, c) for f, (w, c) in flags.items() if w or c)
        if joined:
            self.active = [f for f in self.active if self.cuts[f] is None]
        return True

    def summary(self) -> dict:
        if self.open is not None and self.cuts[0] is not None:
            self.cuts[0] = self.n
        text = lambda r: None if r is None else str(r)
        return dict(pid=self.pid, first=self.first, n=self.n, dim=len(self.dets) or None, dumps=[d.dump() for d in self.dets],
                    restarts=self.restarts if self.joins is None else [], cuts=self.cuts, apart=self.apart,
                    first_req=text(self.first_req), last_req=text(self.last_req),
                    tail=None if self.open is None else [text(self.last_req), *self.open])


def end_state(spec: dict, run: dict | None, entry: dict | None) -> dict:
    """State after a chunk: of the speculation (``run`` None), or of a run that joined it feature by feature."""
    if run is None or run["dim"] is None:
        end = dict(dim=spec["dim"], dumps=spec["dumps"], tail=spec["tail"])
        if run is not None and entry is not None and spec["dim"] is None:        # nothing but empty requests or nulls
            end = dict(dim=entry["dim"], dumps=entry["dumps"], tail=None)
    elif run["apart"]:
        end = dict(dim=run["dim"], dumps=run["dumps"], tail=run["tail"])
    else:
        dumps = [run["dumps"][f] if cut is None else spec["dumps"][f] for f, cut in enumerate(run["cuts"])]
        tail = run["tail"] if run["tail"] is not None or run["cuts"][0] is None else spec["tail"]
        end = dict(dim=run["dim"], dumps=dumps, tail=tail)
    if spec["first_req"] is None and entry is not None:
        end["tail"] = entry["tail"]
    return end


def entry_state(end: dict, spec: dict) -> dict:
    """What the next chunk starts from; an open request goes on only if the chunk begins with it."""
    tail = end["tail"]
    return dict(end, tail=tail if tail is not None and (spec["first_req"] is None or tail[0] == spec["first_req"]) else None)


def _floats(column: pa.Array) -> list:
    return column.cast(pa.float64()).to_numpy(zero_copy_only=False).tolist()


def _lists(column: pa.Array) -> list:
    """Arrays of numbers, or of such arrays, as lists; null arrays are empty."""
    inner = column.flatten()
    if pa.types.is_list(inner.type) or pa.types.is_large_list(inner.type):
        of = _lists(inner)
    else:
        of = inner.to_pylist() if inner.null_count else inner.to_numpy().tolist()
    ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy())]).tolist()
    return [of[a:b] for a, b in zip(ends[:-1], ends[1:])]


class Fold:
    """What the tasks do: sorted Arrow batches into segments, and segments' results into tagged rows."""

    def __init__(self, keys: list[str], kept: list[str], detector: Callable[[], object], depth: int, req: str | None, any_row: bool,
                 heads_by: str | None, schema: T.StructType, keep_states: bool):
        self.keys, self.kept, self.detector, self.depth = keys, kept, detector, depth
        self.req, self.any_row, self.heads_by, self.schema, self.keep_states = req, any_row, heads_by, schema, keep_states

    def _arrow(self, batch: pa.RecordBatch) -> pa.Schema:
        kinds = {"integer": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}
        given = {f.name: f.type for f in batch.schema}
        return pa.schema([(f.name, given[f.name] if f.name in self.kept or f.name == "_x" else kinds[f.dataType.typeName()])
                          for f in self.schema.fields])

    def _made(self, arrow: pa.Schema, kind: int, seg: Segment, rows: pa.RecordBatch, **cols) -> pa.RecordBatch:
        n = len(rows)
        cols |= {"_kind": pa.array([kind] * n, pa.int32()), "_pid": pa.array([seg.pid] * n, pa.int32()), "_first": pa.array([seg.first] * n)}
        cols |= {c: rows.column(c) for c in self.kept}
        return pa.RecordBatch.from_arrays([cols[f.name] if f.name in cols else pa.nulls(n, f.type) for f in arrow], schema=arrow)

    def _alarms(self, arrow, seg: Segment, rows: pa.RecordBatch, found: list, info: str | None = None) -> Iterator[pa.RecordBatch]:
        if found:
            i, f, n, w, c = zip(*found)
            yield self._made(arrow, ALARM, seg, rows.take(pa.array(i, pa.int64())), _feature=pa.array(f, pa.int32()), _n=pa.array(n, pa.int64()),
                             _warning=pa.array(w), _change=pa.array(c), _info=pa.array([info] * len(i), pa.string()))

    def _counted(self, arrow, kind: int, seg: Segment, rows: pa.RecordBatch, found: list) -> Iterator[pa.RecordBatch]:
        if found:
            i, n = zip(*found)
            yield self._made(arrow, kind, seg, rows.take(pa.array(i, pa.int64())), _feature=pa.array([NO_FEATURE] * len(i), pa.int32()),
                             _n=pa.array(n, pa.int64()))

    def _fold(self, arrow, seg: Segment, batch: pa.RecordBatch, a: int, b: int, xs: list, reqs, groups) -> Iterator[pa.RecordBatch]:
        """Rows a to b of a batch into ``seg``."""
        alarms, heads, rejects = [], [], []
        whole = seg.joins is None          # heads and rejects of a joining run are the speculation's
        for i in range(a, b):
            if seg.over():
                break
            if self.depth < 2:
                seg.value(i, xs[i], reqs and reqs[i], alarms)
            elif not seg.request(i, xs[i], alarms):
                rejects.append((i, 1))
            elif groups is not None:
                if heads and groups[i] == seg.group:
                    heads[-1] = (heads[-1][0], heads[-1][1] + 1)
                else:
                    heads.append((i, 1))
                    seg.group = groups[i]
        yield from self._alarms(arrow, seg, batch, alarms)
        if whole:
            yield from self._counted(arrow, HEAD, seg, batch, heads)
            yield from self._counted(arrow, REJECT, seg, batch, rejects)

    def _walk(self, batches: Iterator[pa.RecordBatch], by: list[str], begin, finish) -> Iterator[pa.RecordBatch]:
        """Segments of rows equal in ``by``: ``begin(batch, row)`` opens one, ``finish(segment, last)`` tells whether to report its end."""
        seg = key = held = arrow = None
        for batch in batches:
            if not len(batch):
                continue
            arrow = arrow or self._arrow(batch)
            a = 0
            if held is not None:           # the open request's last row, for the columns handed through
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
                a, seg.open_row = 1, 0
            ks = list(zip(*[batch.column(c).to_pylist() for c in by]))
            xs = _lists(batch.column("_x")) if self.depth else _floats(batch.column("_x"))
            reqs = batch.column(self.req).to_pylist() if self.req else None
            groups = batch.column(self.heads_by).to_pylist() if self.heads_by else None
            stored = batch.column("_state").is_valid().to_pylist() if "_state" in batch.schema.names else None
            while a < len(ks):
                b = a + 1
                while b < len(ks) and ks[b] == ks[a]:
                    b += 1
                if seg is None or ks[a] != key:
                    if seg is not None:
                        yield from self._end(arrow, seg, batch, False, finish(seg, False))
                    seg, key = begin(batch, a), ks[a]
                    if stored and stored[a]:             # the key's state before these rows: no row of its own
                        a += 1
                        if a == b:
                            continue
                if seg.keep:
                    some = batch.slice(a, b - a)
                    yield self._made(arrow, ROW, seg, some, _x=some.column("_x"), _seq=pa.array(range(seg.seq, seg.seq + b - a), pa.int64()))
                    seg.seq += b - a
                if not seg.skip:
                    yield from self._fold(arrow, seg, batch, a, b, xs, reqs, groups)
                a = b
            held = batch.slice(seg.open_row, 1) if seg.open is not None else None
            if held is not None:
                seg.open_row = 0
        if seg is not None:
            yield from self._end(arrow, seg, held, True, finish(seg, True))

    def _end(self, arrow, seg: Segment, rows: pa.RecordBatch | None, last: bool, report: bool) -> Iterator[pa.RecordBatch]:
        last = seg.last if seg.last is not None else last
        if seg.open is not None and any(seg.open):       # at a chunk's end it holds unless the next chunk goes on with the request
            yield from self._alarms(arrow, seg, rows, [(seg.open_row, 0, seg.n, *seg.open)], "open" if last else None)
        if report:
            yield self._made(arrow, SUMMARY, seg, seg.key_row, _info=pa.array([json.dumps(dict(seg.summary(), last=last))]))
        elif self.keep_states and seg.n and not seg.skip and not seg.first:
            yield self._made(arrow, STATE, seg, seg.key_row, _info=pa.array([json.dumps(end_state(seg.summary(), None, None))]))

    def speculate(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        started = []

        def begin(batch: pa.RecordBatch, row: int) -> Segment:
            pid = batch.column("_pid")[0].as_py()
            state = batch.column("_state")[row].as_py() if "_state" in batch.schema.names else None
            seg = Segment(self.detector, self.any_row, pid, not started, batch.slice(row, 1), state and json.loads(state))
            # the first key may go on from the chunk before: its rows are kept for that
            seg.keep = not started and pid > 0 and state is None
            started.append(True)
            del started[1:]
            return seg

        yield from self._walk(batches, self.keys, begin, lambda seg, last: seg.first or last)

    def again(self, plan: dict):
        """Folds the kept rows of the chunks in ``plan`` (pid: spec, entry or None for the end of the chunk before, used and end of the last run)."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            before: list[dict] = []

            def begin(batch: pa.RecordBatch, row: int) -> Segment:
                pid = batch.column("_pid")[row].as_py()
                p = plan[pid]
                entry = p["entry"] or entry_state(before[0], p["spec"])
                skip = entry == p["used"]
                seg = Segment(self.detector, self.any_row, pid, True, batch.slice(row, 1), entry, p["spec"], skip)
                seg.entry = entry
                return seg

            def finish(seg: Segment, last: bool) -> bool:
                p = plan[seg.pid]
                before[:] = [p["end"] if seg.skip else end_state(p["spec"], seg.summary(), seg.entry)]
                return not seg.skip

            yield from self._walk(batches, ["_pid"], begin, finish)

        return run


class Relay:
    """The three passes over ``df``; ``alarms``, ``heads`` and ``rejects`` give their results.

    ``x``: a column of numbers, of arrays of numbers (the arguments of a
    detector's step), or of arrays of rows (array<array<double>>), where each
    request is one row of ``df`` and a key's first row of numbers fixes its
    dimension. ``detector``: a factory of detectors, given the
    feature's index if it says ``by_feature``; only those that restart after a
    change (``restarts``) can join a speculation. ``carry``: columns handed through. With
    ``heads`` (a column of the order), the first request of each run of its
    values is reported, with the number of the run's requests in the chunk.
    ``states`` (keys, state) of earlier runs are gone on from; with
    ``keep_states`` (or given states) ``states()`` has those of the keys of ``df``.
    """

    def __init__(self, df: DataFrame, keys: list[str], order: list[str], x: str, detector: Callable[[], object], req: str | None = None,
                 carry: list[str] | None = None, any_row: bool = False, heads: str | None = None, states: DataFrame | None = None,
                 keep_states: bool = False):
        self.spark = df.sparkSession
        self.keys = keys
        self.kept = list(dict.fromkeys([*keys, *([req] if req else []), *(carry or []), *([heads, *order] if heads else [])]))
        src = df.select(*dict.fromkeys([*self.kept, *order, x]))
        fields = {f.name: f.dataType for f in src.schema.fields}
        own = lambda name, t: T.StructField(name, t)
        self.schema = T.StructType([
            own("_kind", T.IntegerType()), own("_pid", T.IntegerType()), own("_first", T.BooleanType()), own("_seq", T.LongType()),
            *[own(c, fields[c]) for c in self.kept], own("_x", fields[x]), own("_feature", T.IntegerType()), own("_n", T.LongType()),
            own("_warning", T.BooleanType()), own("_change", T.BooleanType()), own("_info", T.StringType())])
        depth, kind = 0, fields[x]
        while isinstance(kind, T.ArrayType):
            depth, kind = depth + 1, kind.elementType
        self.fold = Fold(keys, self.kept, detector, depth, req, any_row, heads, self.schema, keep_states or states is not None)
        first, extra = [], []
        if states is not None:                # a key's state stands before its rows
            src = src.withColumn("_behind", F.lit(1)).withColumn("_state", F.lit(None).cast("string")).unionByName(
                states.select(*keys, F.col("state").alias("_state"), F.lit(0).alias("_behind")), allowMissingColumns=True)
            first, extra = ["_behind"], ["_state"]
        # the only exchange of rows: chunks of the global order, of about equal size
        ranged = src.repartitionByRange(*keys, *first, *order).sortWithinPartitions(*keys, *first, *order)
        path = scratch_path(self.spark, "relay")
        ranged.select(*self.kept, F.col(x).alias("_x"), *extra, F.spark_partition_id().alias("_pid")).mapInArrow(self.fold.speculate, self.schema).write.parquet(path)
        self.stored = self.spark.read.schema(self.schema).parquet(path)
        self.verdict: dict[int, list] = {}
        self.runs: list[DataFrame] = []
        self.ends: list[tuple] = []              # (key, state) of the keys that a chunk begins or ends with
        self._relay()

    # ------------------------------------------------------------ on the driver: the chunk table

    def _rerun(self, tasks: dict[int, int], plan: dict) -> dict[int, dict]:
        """Runs ``plan``, pids of one task in order; summaries by pid."""
        n = max(tasks.values()) + 1
        of = broadcast_small(self.spark.createDataFrame(list(tasks.items()), "_pid int, _task int"))
        rows = (self.stored.where(F.col("_kind") == ROW).join(of, "_pid").repartitionById(n, F.col("_task"))
                .sortWithinPartitions("_task", "_pid", "_seq"))
        path = scratch_path(self.spark, "relay")
        rows.select(*self.schema.names).mapInArrow(self.fold.again(plan), self.schema).write.parquet(path)
        again = self.spark.read.schema(self.schema).parquet(path)
        self.runs.append(again)
        return {s["pid"]: s for s in self._summaries(again)}

    def _summaries(self, df: DataFrame) -> list[dict]:
        got = df.where(F.col("_kind") == SUMMARY).select("_info", *[F.col(k).alias(f"_k{i}") for i, k in enumerate(self.keys)]).collect()
        return [dict(json.loads(r[0]), key=tuple(r[1:])) for r in got]

    def _relay(self) -> None:
        firsts: dict[int, dict] = {}
        lasts: dict[int, dict] = {}
        for s in self._summaries(self.stored):
            if s["first"]:
                firsts[s["pid"]] = s
            lasts[s["pid"]] = s if s["pid"] not in lasts or not s["first"] else lasts[s["pid"]]
        pids = sorted(firsts)
        chains: list[list[int]] = []             # a chunk that begins a key, then those that go on with it
        for a, b in zip(pids, pids[1:]):
            if lasts[a]["key"] != firsts[b]["key"]:
                continue
            if chains and chains[-1][-1] == a and lasts[a]["first"]:
                chains[-1].append(b)
            else:
                chains.append([a, b])
        spec, second, third = firsts, {}, {}
        if chains:
            second, third = self._redo(chains, spec, lasts)
        self._judge(chains, spec, lasts, second, third)

    def _redo(self, chains: list[list[int]], spec: dict, lasts: dict) -> tuple[dict, dict]:
        """Summaries of the second and third pass by pid."""
        entries = {}
        for chain in chains:
            for a, b in zip(chain, chain[1:]):
                start = lasts[a] if a == chain[0] else spec[a]
                entries[b] = entry_state(end_state(start, None, None), spec[b])
        plan = {b: dict(spec=spec[b], entry=e, used=None, end=None) for b, e in entries.items()}
        second = self._rerun({b: i for i, b in enumerate(sorted(plan))}, plan)
        ends = {b: end_state(spec[b], second[b], entries[b]) for b in entries}

        tasks, plan = {}, {}
        for chain in chains:                     # chunks from the first one with another entry state
            end, wrong = end_state(lasts[chain[0]], None, None), None
            for b in chain[1:]:
                if wrong is None:
                    entry = entry_state(end, spec[b])
                    if entry != entries[b]:
                        wrong = len(set(tasks.values()))
                    end = ends[b]
                if wrong is not None:
                    tasks[b] = wrong
                    plan[b] = dict(spec=spec[b], entry=None if any(t == wrong for x, t in tasks.items() if x != b) else entry,
                                   used=entries[b], end=ends[b])
        return second, self._rerun(tasks, plan) if tasks else {}

    def _judge(self, chains: list[list[int]], spec: dict, lasts: dict, second: dict, third: dict) -> None:
        ends: dict[int, dict] = {}
        # by pid: goes on with the chunk before, rows of the key before it, run that holds, apart, cuts; last request goes on in the next chunk
        for chain in chains:
            base, n, end = 0, lasts[chain[0]]["n"], end_state(lasts[chain[0]], None, None)
            for k, b in enumerate(chain):
                mine = self.verdict.setdefault(b, [False, 0, 0, False, [], False])
                if k:
                    base += n
                    run = third.get(b) or second[b]
                    entry = entry_state(end, spec[b])
                    end = end_state(spec[b], run, entry)
                    n = run["n"] if run["apart"] else spec[b]["n"]
                    mine[:5] = True, base, 2 if b in third else 1, run["apart"], run["cuts"]
                follows = next((spec[c]["first_req"] for c in chain[k + 1:] if spec[c]["first_req"] is not None), None)
                left = (spec[b] if k else lasts[b])["last_req"]
                if follows is not None and follows == left:
                    mine[5] = True
            ends[chain[-1]] = end
        goes_on = {b for chain in chains for b in chain[:-1]}
        for b, first in spec.items():
            last = lasts[b]
            if b in ends:                        # a chain ends with this chunk's first key
                self.ends.append((first["key"], ends[b]))
            elif first["n"] and not (first["last"] and b in goes_on):
                self.ends.append((first["key"], end_state(first, None, None)))
            if not first["last"] and last["n"] and b not in goes_on:
                self.ends.append((last["key"], end_state(last, None, None)))

    # ------------------------------------------------------------ results

    def _valid(self, kind: int) -> DataFrame:
        """Rows of ``kind`` that hold, with ``_n`` counted from the key's first row."""
        rows = self.stored.where(F.col("_kind") == kind).withColumn("_run", F.lit(0))
        if not self.verdict:
            return rows
        for i, run in enumerate(self.runs):
            rows = rows.unionByName(run.where(F.col("_kind") == kind).withColumn("_run", F.lit(i + 1)))
        v = broadcast_small(self.spark.createDataFrame(
            [(b, *v) for b, v in self.verdict.items()], "_pid int, _on boolean, _base long, _holds int, _apart boolean, _cuts array<int>, _goes_on boolean"))
        rows = rows.join(v, "_pid", "left")
        on = F.coalesce(F.col("_on"), F.lit(False)) & F.col("_first")
        cut = F.get(F.col("_cuts"), F.col("_feature")) if kind == ALARM else F.lit(0)
        speculated = ~F.col("_apart") & F.coalesce(F.col("_n") > cut, F.lit(False))
        holds = F.when(on, F.when(F.col("_run") == 0, speculated).otherwise(F.col("_run") == F.col("_holds"))).otherwise(F.lit(True))
        open_ = F.coalesce((F.col("_info") == "open") & F.col("_goes_on"), F.lit(False))
        return rows.where(holds & ~open_).withColumn("_n", F.col("_n") + F.when(on & F.lit(kind == ALARM), F.col("_base")).otherwise(0))

    def alarms(self) -> DataFrame:
        """Kept columns, feature, rn (the row's or request's number within its key), warning, change."""
        return self._valid(ALARM).select(*self.kept, F.col("_feature").alias("feature"), F.col("_n").alias("rn"),
                                         F.col("_warning").alias("warning"), F.col("_change").alias("change"))

    def heads(self) -> DataFrame:
        """Kept columns of the first request of each run of ``heads`` in a chunk, n (its requests)."""
        return self._valid(HEAD).select(*self.kept, F.col("_n").alias("n"))

    def rejects(self) -> DataFrame:
        """Kept columns of the requests with a row of another length than the key's dimension."""
        return self._valid(REJECT).select(*self.kept)

    def states(self) -> DataFrame:
        """``keys, state`` after the rows of ``df``, of the keys that have rows there."""
        whole = self.stored.where(F.col("_kind") == STATE).select(*self.keys, F.col("_info").alias("state"))
        fields = [self.stored.schema[k] for k in self.keys]
        schema = T.StructType([*fields, T.StructField("state", T.StringType())])
        return whole.unionByName(self.spark.createDataFrame([(*k, json.dumps(s)) for k, s in self.ends], schema))
