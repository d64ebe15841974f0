"""DuckDB SQL text for the oracle side of the detector folds.

``recursive_fold`` writes a ``WITH RECURSIVE`` member that carries detector
state from row ``rn`` to ``rn + 1`` of every stream in a CTE with columns
``*keys, rn, x``. After a change the next row starts from the initial state.
The per-detector specs below mirror ``tidewatch.operators.detectors``
expression by expression; constants are exact double literals.
"""

from __future__ import annotations

import math

from tidewatch import config as C
from tidewatch.operators.detectors import ECDD_L


def lit(v) -> str:
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, int):
        return f"CAST({v} AS BIGINT)"
    return f"CAST('{float(v)!r}' AS DOUBLE)"


def recursive_fold(name: str, src: str, keys: list[str], state: list[tuple[str, str]],
                   steps: list[tuple[str, str]], change: str, warning: str = "FALSE",
                   restart: bool = True, xcols: tuple[str, ...] = ("x",)) -> str:
    """CTE ``name`` with columns ``*keys, rn, *state, warning, change``."""
    kl = ", ".join(keys)
    svars = [s for s, _ in state]
    anchor = (f"SELECT {kl}, CAST(0 AS BIGINT) AS rn, "
              + ", ".join(f"{init} AS {v}" for v, init in state)
              + f", FALSE AS warning, FALSE AS change FROM (SELECT DISTINCT {kl} FROM {src}) AS _k")
    prev = ", ".join(
        (f"CASE WHEN f.change THEN {init} ELSE f.{v} END AS p_{v}" if restart else f"f.{v} AS p_{v}")
        for v, init in state)
    on = " AND ".join(f"s.{k} = f.{k}" for k in keys)
    body = (f"SELECT {', '.join('s.' + k for k in keys)}, s.rn, {', '.join('s.' + c for c in xcols)}, {prev} "
            f"FROM {name} AS f JOIN {src} AS s ON {on} AND s.rn = f.rn + 1")
    for v, expr in steps:
        body = f"SELECT *, {expr} AS {v} FROM ({body}) AS _s"
    body = f"SELECT *, {change} AS change FROM ({body}) AS _c"
    body = f"SELECT *, {warning} AS warning FROM ({body}) AS _w"
    cols = ", ".join([*keys, "rn", *svars, "warning", "change"])
    return f"{name} AS ({anchor} UNION ALL SELECT {cols} FROM ({body}) AS _r)"


def cusum(o: C.CusumOptions = C.CusumOptions()):
    state = [("n", lit(0)), ("mean", lit(0.0)), ("cs", lit(0.0))]
    steps = [("n", "p_n + 1"),
             ("mean", "p_mean + (x - p_mean) / n"),
             ("cs", f"greatest({lit(0.0)}, p_cs + x - mean - {lit(o.delta)})")]
    return state, steps, f"n >= {lit(o.min_n)} AND cs > {lit(o.lam)}", "FALSE"


def page_hinkley(o: C.PageHinkleyOptions = C.PageHinkleyOptions()):
    state = [("n", lit(0)), ("mean", lit(0.0)), ("cs", lit(0.0))]
    steps = [("n", "p_n + 1"),
             ("mean", "p_mean + (x - p_mean) / n"),
             ("cs", f"greatest({lit(0.0)}, {lit(o.alpha)} * p_cs + x - mean - {lit(o.delta)})")]
    return state, steps, f"n >= {lit(o.min_n)} AND cs > {lit(o.lam)}", "FALSE"


def gma(o: C.GmaOptions = C.GmaOptions()):
    state = [("n", lit(0)), ("mean", lit(0.0)), ("g", lit(0.0))]
    steps = [("n", "p_n + 1"),
             ("mean", "p_mean + (x - p_mean) / n"),
             ("g", f"{lit(o.alpha)} * p_g + {lit(1.0 - o.alpha)} * (x - mean)")]
    return state, steps, f"n >= {lit(o.min_n)} AND g > {lit(o.lam)}", "FALSE"


def ddm(o: C.DdmOptions = C.DdmOptions()):
    inf = lit(float("inf"))
    state = [("n", lit(0)), ("p", lit(0.0)), ("pmin", inf), ("smin", inf), ("psmin", inf)]
    steps = [("n", "p_n + 1"),
             ("p", "p_p + (x - p_p) / n"),
             ("rad", f"p * ({lit(1.0)} - p) / n"),
             ("ok", f"rad >= {lit(0.0)} AND n >= {lit(o.min_n)}"),
             ("sd", "CASE WHEN ok THEN sqrt(rad) END"),
             ("ps", "p + sd"),
             ("upd", "ok AND ps <= p_psmin"),
             ("pmin", "CASE WHEN upd THEN p ELSE p_pmin END"),
             ("smin", "CASE WHEN upd THEN sd ELSE p_smin END"),
             ("psmin", "CASE WHEN upd THEN ps ELSE p_psmin END")]
    change = f"ok AND ps > pmin + {lit(o.out_level)} * smin"
    warning = f"ok AND NOT change AND ps > pmin + {lit(o.warn_level)} * smin"
    return state, steps, change, warning


def eddm(o: C.EddmOptions = C.EddmOptions()):
    state = [("n", lit(0)), ("last", lit(0)), ("k", lit(0)), ("mean", lit(0.0)), ("m2", lit(0.0)),
             ("m2smax", lit(0.0))]
    steps = [("n", "p_n + 1"),
             ("ev", f"x = {lit(1.0)}"),
             ("k", "CASE WHEN ev THEN p_k + 1 ELSE p_k END"),
             ("dist", "n - p_last"),
             ("last", "CASE WHEN ev THEN n ELSE p_last END"),
             ("dlt", "dist - p_mean"),
             ("mean", "CASE WHEN ev THEN p_mean + dlt / k ELSE p_mean END"),
             ("m2", "CASE WHEN ev THEN p_m2 + dlt * (dist - mean) ELSE p_m2 END"),
             ("sd", f"CASE WHEN m2 > {lit(0.0)} THEN sqrt(m2 / k) ELSE {lit(0.0)} END"),
             ("m2s", f"mean + {lit(2.0)} * sd"),
             ("chk", f"ev AND n >= {lit(o.min_n)}"),
             ("upmax", "chk AND m2s > p_m2smax"),
             ("m2smax", "CASE WHEN upmax THEN m2s ELSE p_m2smax END"),
             ("tst", f"chk AND NOT upmax AND k >= {lit(o.min_events)}")]
    change = f"tst AND m2s / p_m2smax < {lit(o.out_ratio)}"
    warning = f"tst AND NOT change AND m2s / p_m2smax < {lit(o.warn_ratio)}"
    return state, steps, change, warning


def ewma(o: C.EwmaOptions = C.EwmaOptions()):
    a, b, c, d, e = ECDD_L
    c1, oml = o.lam / (2.0 - o.lam), 1.0 - o.lam
    state = [("n", lit(0)), ("sm", lit(0.0)), ("z", lit(0.0))]
    steps = [("n", "p_n + 1"),
             ("sm", "p_sm + x"),
             ("p", "sm / n"),
             ("z", f"p_z + {lit(o.lam)} * (x - p_z)"),
             ("rad", f"p * ({lit(1.0)} - p) * {lit(c1)} * ({lit(1.0)} - pow({lit(oml)}, 2 * n))"),
             ("ok", f"n >= {lit(o.min_n)} AND rad >= {lit(0.0)}"),
             ("sd", "CASE WHEN ok THEN sqrt(rad) END"),
             ("lim", f"{lit(a)} - {lit(b)} * p + {lit(c)} * pow(p, 3) - {lit(d)} * pow(p, 5) + {lit(e)} * pow(p, 7)")]
    change = "ok AND z > p + lim * sd"
    warning = f"ok AND NOT change AND z > p + {lit(0.5)} * lim * sd"
    return state, steps, change, warning


def hddm_a(o: C.HddmAOptions = C.HddmAOptions()):
    ln_d, ln_w = math.log(1.0 / o.drift_conf), math.log(1.0 / o.warn_conf)
    LD, LW, two = lit(ln_d), lit(ln_w), lit(2.0)

    def thr(cut, ln):
        return f"sqrt((nn - {cut}) / ({two} * {cut} * nn) * {ln})"

    state = [("nn", lit(0)), ("ss", lit(0.0)), ("cn", lit(0)), ("cs", lit(0.0)), ("mn", lit(0)), ("ms", lit(0.0))]
    steps = [("nn", "p_nn + 1"),
             ("ss", "p_ss + x"),
             ("mean", "ss / nn"),
             ("eps", f"sqrt({LD} / ({two} * nn))"),
             ("updc", f"p_cn = 0 OR mean + eps <= p_cs / p_cn + sqrt({LD} / ({two} * p_cn))"),
             ("cn", "CASE WHEN updc THEN nn ELSE p_cn END"),
             ("cs", "CASE WHEN updc THEN ss ELSE p_cs END")]
    if o.two_sided:
        steps += [("updm", f"p_mn = 0 OR mean - eps >= p_ms / p_mn - sqrt({LD} / ({two} * p_mn))"),
                  ("mn", "CASE WHEN updm THEN nn ELSE p_mn END"),
                  ("ms", "CASE WHEN updm THEN ss ELSE p_ms END")]
    else:
        steps += [("mn", "p_mn"), ("ms", "p_ms")]
    steps += [("dinc", "mean - cs / cn"),
              ("chg_i", f"nn > cn AND dinc >= {thr('cn', LD)}"),
              ("wrn_i", f"nn > cn AND NOT chg_i AND dinc >= {thr('cn', LW)}")]
    if o.two_sided:
        steps += [("ddec", "ms / mn - mean"),
                  ("chg_d", f"NOT chg_i AND nn > mn AND ddec >= {thr('mn', LD)}"),
                  ("wrn_d", f"NOT chg_i AND nn > mn AND NOT chg_d AND ddec >= {thr('mn', LW)}")]
    else:
        steps += [("chg_d", "FALSE"), ("wrn_d", "FALSE")]
    return state, steps, "chg_i OR chg_d", "NOT change AND (wrn_i OR wrn_d)"


def hddm_w(o: C.HddmWOptions = C.HddmWOptions()):
    if o.two_sided:
        raise ValueError("the SQL form covers the one-sided HDDM_W test")
    oml = 1.0 - o.lam
    L, OML, L2, OML2 = lit(o.lam), lit(oml), lit(o.lam * o.lam), lit(oml * oml)
    HD, HW = lit(math.log(1.0 / o.drift_conf) / 2.0), lit(math.log(1.0 / o.warn_conf) / 2.0)
    state = [("tn", lit(0)), ("tz", lit(0.0)), ("tibc", lit(0.0)), ("iset", "FALSE"), ("iz", lit(0.0)),
             ("iibc", lit(0.0)), ("i2n", lit(0)), ("i2z", lit(0.0)), ("i2ibc", lit(0.0))]
    steps = [("tz", f"CASE WHEN p_tn = 0 THEN x ELSE {L} * x + {OML} * p_tz END"),
             ("tibc", f"CASE WHEN p_tn = 0 THEN {lit(1.0)} ELSE {L2} + {OML2} * p_tibc END"),
             ("tn", "p_tn + 1"),
             ("eps", f"sqrt(tibc * {HD})"),
             ("upd", f"NOT p_iset OR tz + eps <= p_iz + sqrt(p_iibc * {HD})"),
             ("iset", "TRUE"),
             ("iz", "CASE WHEN upd THEN tz ELSE p_iz END"),
             ("iibc", "CASE WHEN upd THEN tibc ELSE p_iibc END"),
             ("i2z", f"CASE WHEN upd THEN {lit(0.0)} WHEN p_i2n = 0 THEN x ELSE {L} * x + {OML} * p_i2z END"),
             ("i2ibc", f"CASE WHEN upd THEN {lit(0.0)} WHEN p_i2n = 0 THEN {lit(1.0)} ELSE {L2} + {OML2} * p_i2ibc END"),
             ("i2n", "CASE WHEN upd THEN 0 ELSE p_i2n + 1 END"),
             ("diff", "i2z - iz"),
             ("ib", "iibc + i2ibc")]
    change = f"i2n > 0 AND diff > sqrt(ib * {HD})"
    warning = f"i2n > 0 AND NOT change AND diff > sqrt(ib * {HW})"
    return state, steps, change, warning


SPECS = {
    "CUSUM": (cusum, C.CusumOptions),
    "PAGE_HINKLEY": (page_hinkley, C.PageHinkleyOptions),
    "GEOMETRIC_MOVING_AVERAGE": (gma, C.GmaOptions),
    "DDM": (ddm, C.DdmOptions),
    "EDDM": (eddm, C.EddmOptions),
    "EWMA": (ewma, C.EwmaOptions),
    "HDDM_A": (hddm_a, C.HddmAOptions),
    "HDDM_W": (hddm_w, C.HddmWOptions),
}


def detector_fold(name: str, src: str, keys: list[str], detector: str, **options) -> str:
    fn, opts = SPECS[detector]
    state, steps, change, warning = fn(opts(**options))
    return recursive_fold(name, src, keys, state, steps, change, warning)


def seqdrift1_fold(name: str, src: str, keys: list[str], o: C.SeqDrift1Options = C.SeqDrift1Options()) -> str:
    """Fold over block rows ``*keys, rn, n, sx, sxx`` (no restart: the left
    reservoir is replaced by the newest block on a change)."""
    qd, qw = lit(math.log(4.0 / o.delta)), lit(math.log(4.0 / o.warn_delta))

    def bound(q):
        return f"{lit(2.0)} / ({lit(3.0)} * m) * ({q} + sqrt({q} * {q} + {lit(18.0)} * var * m * {q}))"

    state = [("ln", lit(0)), ("ls", lit(0.0)), ("lq", lit(0.0))]
    steps = [("first", "p_ln = 0"),
             ("ntot", "p_ln + n"),
             ("mu", "(p_ls + sx) / ntot"),
             ("var", f"greatest((p_lq + sxx) / ntot - mu * mu, {lit(0.0)})"),
             ("m", f"CASE WHEN first THEN NULL ELSE {lit(1.0)} / ({lit(1.0)} / p_ln + {lit(1.0)} / n) END"),
             ("diff", "CASE WHEN first THEN NULL ELSE abs(p_ls / p_ln - sx / n) END"),
             ("chg", f"NOT first AND diff > {bound(qd)}"),
             ("wrn", f"NOT first AND NOT chg AND diff > {bound(qw)}"),
             ("ln", "CASE WHEN first OR chg THEN n ELSE ntot END"),
             ("ls", "CASE WHEN first OR chg THEN sx ELSE p_ls + sx END"),
             ("lq", "CASE WHEN first OR chg THEN sxx ELSE p_lq + sxx END")]
    return recursive_fold(name, src, keys, state, steps, "chg", "wrn", restart=False, xcols=("n", "sx", "sxx"))
