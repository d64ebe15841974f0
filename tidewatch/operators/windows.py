"""First-alarm forms of CUSUM and DDM as window plans (no Python).

Up to its first alarm a detector has not restarted, so its statistic has a
closed form over running aggregates:

* CUSUM  ``S_t = P_t - min(0, min_{j<=t} P_j)`` with ``P`` the running sum of
  ``x - mean_t - delta`` (Lindley recursion), alarm when ``t >= min_n`` and
  ``S_t > lambda``.
* DDM    running error rate ``p_t`` and ``s_t``; the running minimum of
  ``(p+s, p, s)`` gives ``(pmin, smin)``; warning / change when ``p+s`` passes
  ``pmin + k*smin``.

Running aggregates are chunk-parallel (``ordering.running``), so one
long key is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch import config as C
from tidewatch.operators.ordering import running


def cusum_first_alarm(df: DataFrame, key: str, order: list[str], x: str,
                      o: C.CusumOptions = C.CusumOptions()) -> DataFrame:
    """``key, rn`` of the first CUSUM alarm of each key (keys without alarm absent)."""
    d = running(df.select(key, *order, x), key, order, count="rn", sums={"_cx": x})
    d = d.withColumn("_v", F.col(x) - F.col("_cx") / F.col("rn") - F.lit(o.delta))
    d = running(d, key, order, sums={"_p": "_v"}, min_of_sum={"_pm": "_p"})
    s = F.col("_p") - F.least(F.lit(0.0), F.col("_pm"))
    hits = d.filter((F.col("rn") >= o.min_n) & (s > o.lam))
    return hits.groupBy(key).agg(F.min("rn").alias("rn"))


def ddm_first_alarm(df: DataFrame, key: str, order: list[str], x: str,
                    o: C.DdmOptions = C.DdmOptions()) -> DataFrame:
    """``key, first_warning_rn, first_change_rn`` of DDM before any restart."""
    d = running(df.select(key, *order, x), key, order, count="rn", sums={"_cx": x})
    d = (d.withColumn("_p", F.col("_cx") / F.col("rn"))
          .withColumn("_rad", F.col("_p") * (F.lit(1.0) - F.col("_p")) / F.col("rn"))
          .filter((F.col("rn") >= o.min_n) & (F.col("_rad") >= 0))
          .withColumn("_s", F.sqrt("_rad"))
          .withColumn("_ps", F.struct((F.col("_p") + F.col("_s")).alias("ps"), F.col("_p").alias("p"),
                                      F.col("_s").alias("s"))))
    d = running(d, key, order, mins={"_m": "_ps"})
    ps = F.col("_ps.ps")
    warn = ps > F.col("_m.p") + F.lit(o.warn_level) * F.col("_m.s")
    chg = ps > F.col("_m.p") + F.lit(o.out_level) * F.col("_m.s")
    return d.groupBy(key).agg(F.min(F.when(warn, F.col("rn"))).alias("first_warning_rn"),
                              F.min(F.when(chg, F.col("rn"))).alias("first_change_rn"))
