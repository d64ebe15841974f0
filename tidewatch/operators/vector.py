"""A model's vector detector: one univariate detector per feature.

Detectors are created at the model's first non-empty row, which fixes the
dimension; a request with a row of another length is refused as a whole
(``fits``; a ``dim_mismatch``). Null and NaN cells are skipped. A feature has
the flags of its last update within a request, and a request is polled after
its last row by combining the features:

* ``any``       warning / change if any feature's detector has it (OR)
* ``majority``  change if the share of changed features exceeds ``threshold``;
                the warning answers the change flag
* ``logistic``  each feature votes ``1/(1+exp(age-5))``, age = requests since
                its last change (none yet: 0); change if the mean vote exceeds
                ``threshold``; the warning answers the change flag

The same object runs in the table fold and in the streaming state (it has
``dump``/``load``). For long or hot models prefer the per-feature plans
(``vote_any`` and friends), which split a model by feature.
"""

from __future__ import annotations

import math
from collections.abc import Callable

COMBINE = ("any", "majority", "logistic")


class VectorDetector:
    vector = True
    __slots__ = ("factory", "combine", "threshold", "dets", "dim", "req", "w", "c", "last")

    def __init__(self, factory: Callable[[], object], combine: str = "any", threshold: float = 0.5):
        if combine not in COMBINE:
            raise ValueError(f"combine must be one of {COMBINE}")
        self.factory, self.combine, self.threshold = factory, combine, threshold
        self.dets, self.dim, self.req = None, 0, 0
        self.w, self.c, self.last = [], [], []

    def _create(self, dim: int):
        self.dim = dim
        self.dets = [self.factory() for _ in range(dim)]
        self.w, self.c, self.last = [False] * dim, [False] * dim, [-1] * dim

    def step(self, row):
        if len(row) == 0:                  # a row without features fits nothing
            return self.poll()
        if self.dets is None:               # the first non-empty row fixes the dimension
            self._create(len(row))
        for d, e, i in zip(self.dets, row, range(self.dim)):
            if e is None or e != e:
                continue
            self.w[i], self.c[i] = d.step(float(e))
            if self.c[i]:
                self.last[i] = self.req
        return self.poll()

    def fits(self, rows) -> bool:
        """Whether all non-empty rows have the model's dimension (that of the first one, if none is fixed yet)."""
        sizes = {len(r) for r in rows if len(r)}
        return len(sizes) <= 1 and (not sizes or not self.dim or sizes == {self.dim})

    def end_request(self):
        self.req += 1
        self.w, self.c = [False] * self.dim, [False] * self.dim

    def poll(self) -> tuple[bool, bool]:
        if not self.dim:
            return False, False
        if self.combine == "any":
            return any(self.w), any(self.c)
        if self.combine == "majority":
            hit = sum(self.c) / self.dim > self.threshold
        else:
            votes = [0.0 if a < 0 else 1.0 / (1.0 + math.exp((self.req - a) - 5.0)) for a in self.last]
            hit = sum(votes) / self.dim > self.threshold
        return hit, hit

    def dump(self) -> list[float]:
        out = [float(self.dim), float(self.req)]
        if not self.dim:
            return out
        out += [float(v) for v in self.w] + [float(v) for v in self.c] + [float(v) for v in self.last]
        for d in self.dets:
            s = d.dump()
            out += [float(len(s))] + list(s)
        return out

    def load(self, v) -> None:
        dim, self.req = int(v[0]), int(v[1])
        if not dim:
            return
        self._create(dim)
        k = 2
        self.w = [bool(x) for x in v[k:k + dim]]
        self.c = [bool(x) for x in v[k + dim:k + 2 * dim]]
        self.last = [int(x) for x in v[k + 2 * dim:k + 3 * dim]]
        k += 3 * dim
        for d in self.dets:
            n = int(v[k])
            d.load(list(v[k + 1:k + 1 + n]))
            k += 1 + n


def any_feature(detector: Callable[[], object]):
    """Picklable factory of a vector detector that alarms when any feature's ``detector()`` does."""
    from functools import partial
    return partial(VectorDetector, detector, "any")


def vector_factory(name: str, options: dict | None = None, combine: str = "any", threshold: float = 0.5):
    """Picklable factory of a validated vector detector over univariate ``name``."""
    from functools import partial

    from tidewatch.operators.detectors import make_detector
    make_detector(name, **(options or {}))
    if combine not in COMBINE:
        raise ValueError(f"combine must be one of {COMBINE}")
    return partial(VectorDetector, partial(make_detector, name, **(options or {})), combine, threshold)
