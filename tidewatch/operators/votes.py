"""Votes of per-feature detectors over wide vectors, from their changes alone.

``sampled`` keeps ``k`` features of each model: those with the smallest hashes
of (model, feature), so the sample stays as other features come and go. The
detectors' changes are few; both votes work on them and on nothing that has a
row per (feature, request):

* ``majority``  share of the sampled features that change at a request;
* ``decay``     a feature votes ``1/(1+exp(age-5))``, age = requests since its
                last change (none yet: 0). The mean vote can pass the threshold
                only within ``reach`` requests of some change, so only these
                requests are looked at; the ages of all other features there
                come from a running maximum over changes and such requests.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.ordering import row_index, running
from tidewatch.operators.sizes import broadcast_small


class Panel:
    """Several detectors on every feature: cell i of a vector goes to detector ``i % n``."""

    by_feature = True

    def __init__(self, factories: list[Callable[[], object]]):
        self.factories = factories

    def __call__(self, feature: int):
        return self.factories[feature % len(self.factories)]()

    def spread(self, x: str):
        """Column: requests ``x`` with each cell once for every detector."""
        return F.transform(x, lambda r: F.flatten(F.transform(r, lambda c: F.array_repeat(c, len(self.factories)))))


def feature_sample(requests: DataFrame, key: str, order: list[str], x: str, k: int) -> DataFrame:
    """``key, features``: the ``k`` features (all, if fewer) of each model's dimension that come first by hash, in their own order."""
    first = F.min_by(F.size(F.get(F.col(x), 0)), F.struct(*order))
    dims = requests.where((F.size(x) > 0) & (F.size(F.get(F.col(x), 0)) > 0)).groupBy(key).agg(first.alias("_dim"))
    hashed = F.transform(F.sequence(F.lit(0), F.col("_dim") - 1), lambda i: F.struct(
        F.md5(F.concat_ws(":", F.col(key), i.cast("string"))).alias("h"), i.alias("i")))
    least = F.transform(F.slice(F.array_sort(hashed), 1, k), lambda s: s["i"])
    return dims.select(key, F.array_sort(least).alias("features"))


def sampled(requests: DataFrame, key: str, order: list[str], x: str, k: int) -> DataFrame:
    """``requests`` with rows cut to the model's sampled features, and ``features`` (their indices).

    A request with a row of another dimension keeps it whole, for the fold to refuse; one without rows stays as it is.
    """
    sample = broadcast_small(feature_sample(requests, key, order, x, k))
    cut = F.transform(x, lambda r: F.when(F.size(r) > F.array_max("features"), F.transform("features", lambda i: F.get(r, i))).otherwise(r))
    return requests.join(sample, key, "left").withColumn(x, F.coalesce(cut, F.col(x)))


def cells(requests: DataFrame, key: str, order: list[str], x: str) -> DataFrame:
    """Columns of ``requests`` but ``x``, request (its number within its key), row, feature, x: a row for every cell of its rows."""
    rest = [c for c in requests.columns if c != x]
    numbered = row_index(requests, key, order).withColumnRenamed("rn", "request")
    rows = numbered.select(*rest, "request", F.posexplode(x).alias("row", "_v"))
    return rows.select(*rest, "request", "row", F.posexplode("_v").alias("feature", "x"))


def majority(changes: DataFrame, keys: list[str], n_features, threshold: float) -> DataFrame:
    """``*keys, vote`` where the share of ``n_features`` (a column of ``changes``) that change at a request exceeds ``threshold``."""
    votes = changes.groupBy(*keys).agg((F.count("*") / F.first(n_features)).alias("vote"))
    return votes.where(F.col("vote") > threshold)


def reach(threshold: float) -> int:
    """Age from which a vote, and so the mean of such votes, does not exceed ``threshold``."""
    if not 0.0 < threshold < 1.0:
        raise ValueError("threshold must be in (0, 1)")
    return max(0, math.ceil(5.0 + math.log(1.0 / threshold - 1.0)))


def decay(changes: DataFrame, sizes: DataFrame, key: str, feature: str, request: str, threshold: float) -> DataFrame:
    """``key, request, score`` of the requests whose mean vote exceeds ``threshold``.

    ``changes``: ``key, feature, request`` of every change; ``sizes``: ``key,
    n_features, last`` (the features that vote and the last request).
    """
    small = broadcast_small(sizes.select(key, "n_features", "last"))
    events = changes.select(key, feature, request).join(small, key)
    asked = (events.select(key, "n_features", F.explode(F.sequence(F.col(request), F.least(F.col(request) + reach(threshold), F.col("last")))).alias(request))
             .distinct())
    voters = events.select(key, feature).distinct()          # a feature without a change votes 0
    rows = asked.select(key, request).join(voters, key).select(key, feature, request, F.lit(1).alias("_asks"), F.lit(None).cast("long").alias("_at"))
    rows = rows.unionByName(events.select(key, feature, request, F.lit(0).alias("_asks"), F.col(request).cast("long").alias("_at")))
    ages = running(rows, [key, feature], [request, "_asks"], maxs={"_last": "_at"}).where("_asks = 1")
    last = F.col("_last")
    vote = F.when(last.isNull(), F.lit(0.0)).otherwise(1.0 / (1.0 + F.exp((F.col(request) - last) - 5.0)))
    score = ages.groupBy(key, request).agg(F.sum(vote).alias("_votes")).join(small, key)
    return score.select(key, request, (F.col("_votes") / F.col("n_features")).alias("score")).where(F.col("score") > threshold)
