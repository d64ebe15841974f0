"""DuckDB oracle text for every registered query that SQL can express.

The oracles compute the expected rows straight from `events` (they do not
repeat the log parser): the planted log cases are a function of
``event_id % 10``, the signals and the detector folds are re-derived in SQL
(``WITH RECURSIVE`` for folds with restarts).
"""

from __future__ import annotations

from tidewatch.config import SEVERITY_ORDER
from tidewatch.plans import queries as Q
from tidewatch import config as C
from tidewatch.operators.kl import chi2_95
from tidewatch.plans.sqlfold import detector_fold, lit, seqdrift1_fold

D0, D1 = lit(0.0), lit(1.0)

EV = f"""ev AS (
  SELECT event_id, ts, user_id, event_type AS model_id, value,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         ts >= TIMESTAMP '2024-01-16 00:00:00' AS d,
         CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS BIGINT) AS batch_id,
         'ax-' || CAST(user_id % 3 AS VARCHAR) AS axon,
         'model-' || event_type AS model
  FROM events),
sig0 AS (
  SELECT *,
    value / {lit(100.0)} + CASE WHEN d THEN {D1} ELSE {D0} END AS s,
    CASE WHEN value > CASE WHEN d THEN {lit(50.0)} ELSE {lit(100.0)} END THEN {D1} ELSE {D0} END AS b,
    least(value / {lit(500.0)} + CASE WHEN d THEN {lit(0.4)} ELSE {D0} END, {D1}) AS u
  FROM ev)"""

SIG = EV + """,
sig AS (SELECT *, row_number() OVER (PARTITION BY model_id ORDER BY ts, event_id) AS rn FROM sig0)"""

GOOD = EV + """,
good AS (SELECT *, row_number() OVER (PARTITION BY model_id ORDER BY ts, event_id) AS rn
         FROM sig0 WHERE event_id % 10 < 4 {extra})"""

UPTO = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


FEATURES = ["s", f"user_id / {lit(100.0)}", f"k / {lit(100.0)}"]   # the cells of a request, the shift planted in the first


def _prob(warn: str, chg: str) -> str:
    return f"CASE WHEN {chg} THEN {lit(0.9)} WHEN {warn} THEN {lit(0.8)} ELSE {D0} END"


def _states_sql(rows: str, detector: str, signals: list[str], opts: dict, meta: bool) -> str:
    """CTEs fold, ba, grid, st over a row CTE with model_id, rn, batch_id, ts; a fold per model and signal."""
    fold = detector_fold("fold", "src", ["model_id", "feature_idx"], detector, **opts)
    src = " UNION ALL ".join(f"SELECT model_id, {i} AS feature_idx, rn, {x} AS x FROM {rows}" for i, x in enumerate(signals))
    meta_cols = ", arg_min(model, ts) AS model, arg_min(axon, ts) AS axon" if meta else ""
    return f""",
src AS ({src}),
{fold},
ba AS (SELECT g.model_id, g.batch_id, bool_or(f.warning) AS warning, bool_or(f.change) AS change
       FROM fold AS f JOIN {rows} AS g ON f.model_id = g.model_id AND f.rn = g.rn
       WHERE f.rn > 0 AND (f.warning OR f.change) GROUP BY g.model_id, g.batch_id),
grid AS (SELECT model_id, batch_id, count(*) AS n_requests{meta_cols} FROM {rows} GROUP BY model_id, batch_id){LATCH}"""


LATCH = f""",
gf AS (SELECT *, min(batch_id) OVER (PARTITION BY model_id) AS fb FROM grid),
lt AS (
  SELECT gf.* EXCLUDE (fb),
    max(CASE WHEN gf.batch_id > gf.fb AND coalesce(ba.warning, FALSE) THEN 1 ELSE 0 END)
      OVER (PARTITION BY gf.model_id ORDER BY gf.batch_id {UPTO}) = 1 AS warning_detected,
    max(CASE WHEN gf.batch_id > gf.fb AND coalesce(ba.change, FALSE) THEN 1 ELSE 0 END)
      OVER (PARTITION BY gf.model_id ORDER BY gf.batch_id {UPTO}) = 1 AS change_detected
  FROM gf LEFT JOIN ba ON gf.model_id = ba.model_id AND gf.batch_id = ba.batch_id),
st AS (SELECT *, {_prob('warning_detected', 'change_detected')} AS drift_probability FROM lt)"""


def _flagship(extra: str = "") -> str:
    det, opts = Q.FLAGSHIP
    return "WITH RECURSIVE " + GOOD.format(extra=extra) + _states_sql("good", det, FEATURES, opts, meta=True)


BATCH_TIME = "strftime(DATE '1970-01-01' + CAST(batch_id AS INTEGER), '%Y-%m-%d') || ' 00:00:00'"
STATE_ROWS = f"SELECT model_id, axon, drift_probability, {BATCH_TIME} AS timestamp FROM st"


def _detector_sql(name: str) -> str:
    det, signal, opts = Q.DETECTOR_QUERIES[name]
    fold = detector_fold("fold", "src", ["model_id"], det, **opts)
    return (f"WITH RECURSIVE {SIG},\nsrc AS (SELECT model_id, rn, {signal} AS x FROM sig),\n{fold}\n"
            "SELECT model_id, rn, warning, change FROM fold WHERE rn > 0 AND (warning OR change)")


def _feature_rows(binary: bool) -> str:
    parts = []
    for i, expr in enumerate(["s", f"user_id / {lit(100.0)}", f"k / {lit(100.0)}"]):
        x = f"CASE WHEN {expr} > {D1} THEN {D1} ELSE {D0} END" if binary else expr
        parts.append(f"SELECT model_id, rn, (rn - 1) // {Q.ROWS_PER_REQUEST} AS req_id, "
                     f"CAST({i} AS BIGINT) AS feature_idx, {x} AS x FROM sig")
    return "fl AS (" + " UNION ALL ".join(parts) + ")"


def _feature_sql(name: str) -> str:
    det, binary, opts = Q.FEATURE_QUERIES[name]
    if det == "ADWIN":
        return None
    fold = detector_fold("fold", "fl", ["model_id", "feature_idx"], det, **opts)
    return (f"WITH RECURSIVE {SIG},\n{_feature_rows(binary)},\n{fold}\n"
            "SELECT model_id, feature_idx, rn, warning, change FROM fold WHERE rn > 0 AND (warning OR change)")


def _feature_end_flags() -> str:
    """CTE ``ef``: per (model, feature, request) flags polled at the request's last row."""
    det, opts = Q.VOTE_DETECTOR
    fold = detector_fold("fold", "fl", ["model_id", "feature_idx"], det, **opts)
    return (f"WITH RECURSIVE {SIG},\n{_feature_rows(False)},\n{fold},\n"
            "ends AS (SELECT model_id, feature_idx, req_id, max(rn) AS rn FROM fl GROUP BY ALL),\n"
            "ef AS (SELECT e.model_id, e.feature_idx, e.req_id, f.warning, f.change FROM ends AS e JOIN fold AS f "
            "ON e.model_id = f.model_id AND e.feature_idx = f.feature_idx AND e.rn = f.rn)\n")


def _adwin_sql(src_rows: str, keys: list[str], delta: float, clock: int = 32, min_side: int = 5) -> str:
    """Exact ADWIN oracle: sequential prefix sums by recursion, then a second
    recursion over (check time, window start) with list functions."""
    kl = ", ".join(keys)
    on = " AND ".join(f"s.{k} = f.{k}" for k in keys)
    on2 = " AND ".join(f"l.{k} = c.{k}" for k in keys)
    two, three = lit(2.0), lit(3.0)
    return f"""src AS ({src_rows}),
pre AS (
  SELECT {kl}, CAST(0 AS BIGINT) AS rn, {D0} AS ps, {D0} AS qs FROM (SELECT DISTINCT {kl} FROM src) AS _k
  UNION ALL
  SELECT {', '.join('s.' + k for k in keys)}, s.rn, f.ps + s.x, f.qs + s.x * s.x
  FROM pre AS f JOIN src AS s ON {on} AND s.rn = f.rn + 1),
lists AS (SELECT {kl}, list(ps ORDER BY rn) AS P, list(qs ORDER BY rn) AS Q, max(rn) AS tmax FROM pre GROUP BY ALL),
chk AS (
  SELECT {kl}, CAST({clock} AS BIGINT) AS t, CAST(0 AS BIGINT) AS st, FALSE AS cut, tmax FROM lists WHERE tmax >= {clock}
  UNION ALL
  SELECT c.{', c.'.join(keys)},
    CASE WHEN c2.j IS NULL THEN c.t + {clock} ELSE c.t END,
    coalesce(c2.j, c.st), c2.j IS NOT NULL, c.tmax
  FROM chk AS c JOIN lists AS l ON {on2}
  CROSS JOIN LATERAL (
    SELECT CASE WHEN c.t - c.st < {2 * min_side} THEN NULL ELSE list_last(list_filter(
      range(c.st + {min_side}, c.t - {min_side} + 1),
      lambda j: abs((l.P[j + 1] - l.P[c.st + 1]) / (j - c.st) - (l.P[c.t + 1] - l.P[j + 1]) / (c.t - j)) >
        sqrt({two} * ({D1} / (j - c.st) + {D1} / (c.t - j))
             * greatest((l.Q[c.t + 1] - l.Q[c.st + 1]) / (c.t - c.st)
                        - ((l.P[c.t + 1] - l.P[c.st + 1]) / (c.t - c.st)) * ((l.P[c.t + 1] - l.P[c.st + 1]) / (c.t - c.st)), {D0})
             * ln({two} * ln(c.t - c.st) / {lit(delta)}))
        + {two} * ({D1} / (j - c.st) + {D1} / (c.t - j)) / {three} * ln({two} * ln(c.t - c.st) / {lit(delta)})
    )) END AS j) AS c2
  WHERE c.t <= c.tmax AND (c2.j IS NOT NULL OR c.t + {clock} <= c.tmax))
"""


def _adwin_det_sql() -> str:
    det, signal, opts = Q.DETECTOR_QUERIES["det_adwin"]
    body = _adwin_sql(f"SELECT model_id, rn, {signal} AS x FROM sig", ["model_id"], opts["delta"])
    return (f"WITH RECURSIVE {SIG},\n{body}"
            "SELECT DISTINCT model_id, t AS rn, FALSE AS warning, TRUE AS change FROM chk WHERE cut")


def _adwin_feat_sql() -> str:
    det, binary, opts = Q.FEATURE_QUERIES["feat_adwin"]
    body = _adwin_sql("SELECT model_id, feature_idx, rn, x FROM fl", ["model_id", "feature_idx"], opts["delta"])
    return (f"WITH RECURSIVE {SIG},\n{_feature_rows(binary)},\n{body}"
            "SELECT DISTINCT model_id, feature_idx, t AS rn, FALSE AS warning, TRUE AS change FROM chk WHERE cut")


def _seqdrift1_ctes(src: str, keys: list[str], o: C.SeqDrift1Options) -> str:
    """CTEs to ``sq`` (keys, rn, warning, change) over a row CTE with keys, rn, x."""
    kl = ", ".join(keys)
    return f"""blocks AS (SELECT {kl}, (rn - 1) // {o.block} AS block, count(*) AS n, sum(x) AS sx,
                  sum(x * x) AS sxx, max(rn) AS end_rn FROM {src} GROUP BY ALL HAVING count(*) = {o.block}),
bsrc AS (SELECT {kl}, block + 1 AS rn, n, sx, sxx, end_rn FROM blocks),
{seqdrift1_fold("sqf", "bsrc", keys, o)},
sq AS (SELECT {", ".join("f." + k for k in keys)}, b.end_rn AS rn, f.warning, f.change FROM sqf AS f JOIN bsrc AS b
       ON {" AND ".join(f"f.{k} = b.{k}" for k in keys)} AND f.rn = b.rn)"""


def _seqdrift1_sql() -> str:
    _, signal, opts = Q.BLOCK_QUERIES["det_seqdrift1"]
    return (f"WITH RECURSIVE {SIG},\nsrc AS (SELECT model_id, rn, {signal} AS x FROM sig),\n"
            + _seqdrift1_ctes("src", ["model_id"], C.SeqDrift1Options(**opts))
            + "\nSELECT model_id, rn, warning, change FROM sq WHERE warning OR change")


def _seed_ctes(src: str, keys: list[str], o: C.SeedOptions) -> str:
    """CTEs to ``sd`` (keys, rn of a change): SEED as a recursion over (blocks taken, window of blocks): add a
    block, cut while a border qualifies, and merge neighbours after every ``compress`` blocks, one action a step."""
    one, two, three, kl = D1, lit(2.0), lit(3.0), ", ".join(keys)
    n0, s0 = "list_sum(list_transform(b[1:j], lambda x: x.n))", "list_sum(list_transform(b[1:j], lambda x: x.s))"
    inv = f"({one} / {n0} + {one} / (nn - {n0}))"
    border = (f"abs({s0} / {n0} - (ss - {s0}) / (nn - {n0})) > sqrt({two} * {inv} * v * dd) + {two} * {inv} / {three} * dd")
    near = (f"abs(b[i + 1].s / b[i + 1].n - b[i + 2].s / b[i + 2].n) < "
            f"{lit(o.eps_prime)} * ({one} + {lit(o.alpha)} * (len(b) - 2 - i))")
    return f"""blk AS (SELECT {kl}, (rn - 1) // {o.block} AS k, CAST(count(*) AS DOUBLE) AS n, sum(x) AS s, sum(x * x) AS q
        FROM {src} GROUP BY ALL HAVING count(*) = {o.block}),
bls AS (SELECT {kl}, list({{'n': n, 's': s, 'q': q}} ORDER BY k) AS bl FROM blk GROUP BY {kl}),
run AS (
  SELECT {kl}, bl, CAST(1 AS BIGINT) AS t, bl[1:1] AS b, 'cut' AS mode, CAST(0 AS BIGINT) AS i, FALSE AS chg FROM bls
  UNION ALL
  SELECT {kl}, bl, CASE WHEN mode = 'add' THEN t + 1 ELSE t END,
    CASE WHEN mode = 'add' THEN list_append(b, bl[t + 1]) WHEN best IS NOT NULL THEN b[best + 1:]
         WHEN merge THEN list_concat(list_append(b[1:i], {{'n': b[i + 1].n + b[i + 2].n, 's': b[i + 1].s + b[i + 2].s,
                                                            'q': b[i + 1].q + b[i + 2].q}}), b[i + 3:])
         ELSE b END,
    CASE WHEN mode = 'add' OR best IS NOT NULL THEN 'cut'
         WHEN mode = 'cut' AND t % {o.compress} = 0 THEN 'merge'
         WHEN mode = 'merge' AND i < len(b) - 1 THEN 'merge' ELSE 'add' END,
    CASE WHEN mode = 'merge' AND NOT merge THEN i + 1 WHEN mode = 'merge' THEN i ELSE 0 END,
    best IS NOT NULL
  FROM (
    SELECT *, CASE WHEN mode = 'cut' AND len(b) >= 2 THEN list_max(list_filter(range(1, len(b)), lambda j: {border})) END AS best,
      mode = 'merge' AND i < len(b) - 1 AND {near} AS merge
    FROM (SELECT *, greatest(qq / nn - (ss / nn) * (ss / nn), {D0}) AS v, ln({two} * ln(nn) / {lit(o.delta)}) AS dd
      FROM (SELECT *, list_sum(list_transform(b, lambda x: x.n)) AS nn, list_sum(list_transform(b, lambda x: x.s)) AS ss,
                   list_sum(list_transform(b, lambda x: x.q)) AS qq FROM run WHERE mode <> 'add' OR t < len(bl)) AS r1) AS r2) AS r3),
sd AS (SELECT DISTINCT {kl}, t * {o.block} AS rn FROM run WHERE chg)"""


def _seed_sql() -> str:
    _, signal, opts = Q.BLOCK_QUERIES["det_seed"]
    return (f"WITH RECURSIVE {SIG},\nsrc AS (SELECT model_id, rn, {signal} AS x FROM sig),\n"
            + _seed_ctes("src", ["model_id"], C.SeedOptions(**opts)) + "\nSELECT model_id, rn, FALSE AS warning, TRUE AS change FROM sd")


def _adwin_blocks_sql() -> str:
    """ADWIN on the histogram of blocks: add a block, merge while a size has too many buckets, cut while a border qualifies."""
    _, signal, opts = Q.BLOCK_QUERIES["det_adwin_histogram"]
    o = C.AdwinOptions(**opts)
    one, two, three = D1, lit(2.0), lit(3.0)
    n0, s0 = "list_sum(list_transform(b[1:j], lambda x: x.n))", "list_sum(list_transform(b[1:j], lambda x: x.s))"
    inv = f"({one} / {n0} + {one} / (nn - {n0}))"
    border = (f"{n0} >= {o.min_side} AND nn - {n0} >= {o.min_side} AND "
              f"abs({s0} / {n0} - (ss - {s0}) / (nn - {n0})) > sqrt({two} * {inv} * v * dd) + {two} * {inv} / {three} * dd")
    full = f"list_filter(ns, lambda z: len(list_filter(ns, lambda y: y = z)) > {o.buckets})"
    merged = "{'n': b[p].n + b[p + 1].n, 's': b[p].s + b[p + 1].s, 'q': b[p].q + b[p + 1].q}"
    return f"""WITH RECURSIVE {SIG},
blk AS (SELECT model_id, (rn - 1) // {o.clock} AS k, CAST(count(*) AS DOUBLE) AS n, sum({signal}) AS s, sum({signal} * {signal}) AS q
        FROM sig GROUP BY ALL HAVING count(*) = {o.clock}),
bls AS (SELECT model_id, list({{'n': n, 's': s, 'q': q}} ORDER BY k) AS bl FROM blk GROUP BY model_id),
run AS (
  SELECT model_id, bl, CAST(1 AS BIGINT) AS t, bl[1:1] AS b, 'merge' AS mode, FALSE AS chg FROM bls
  UNION ALL
  SELECT model_id, bl, CASE WHEN mode = 'add' THEN t + 1 ELSE t END,
    CASE WHEN mode = 'add' THEN list_append(b, bl[t + 1])
         WHEN mode = 'merge' AND p IS NOT NULL THEN list_concat(list_append(b[1:p - 1], {merged}), b[p + 2:])
         WHEN best IS NOT NULL THEN b[best + 1:] ELSE b END,
    CASE WHEN mode = 'add' OR p IS NOT NULL THEN 'merge' WHEN mode = 'merge' OR best IS NOT NULL THEN 'cut' ELSE 'add' END,
    best IS NOT NULL
  FROM (
    SELECT *, CASE WHEN mode = 'merge' THEN list_position(ns, list_min({full})) END AS p,
      CASE WHEN mode = 'cut' AND len(b) >= 2 AND nn >= {2 * o.min_side} THEN list_max(list_filter(range(1, len(b)), lambda j: {border})) END AS best
    FROM (SELECT *, greatest(qq / nn - (ss / nn) * (ss / nn), {D0}) AS v, ln({two} * ln(nn) / {lit(o.delta)}) AS dd
      FROM (SELECT *, list_transform(b, lambda x: x.n) AS ns, list_sum(list_transform(b, lambda x: x.n)) AS nn,
                   list_sum(list_transform(b, lambda x: x.s)) AS ss, list_sum(list_transform(b, lambda x: x.q)) AS qq
            FROM run WHERE mode <> 'add' OR t < len(bl)) AS r1) AS r2) AS r3)
SELECT DISTINCT model_id, t * {o.clock} AS rn, FALSE AS warning, TRUE AS change FROM run WHERE chg"""


WIDE = f"""wv AS (SELECT vec_id, 'wide-' || CAST(vec_id % 2 AS VARCHAR) AS model_id, vec_id // 40 AS batch_id, embedding,
  row_number() OVER (PARTITION BY vec_id % 2 ORDER BY vec_id) AS rn FROM embeddings),
wc AS (SELECT *, unnest(embedding) AS c, unnest(range(len(embedding))) AS i FROM wv),
ws AS (SELECT model_id, i FROM (SELECT DISTINCT model_id, i FROM wc)
       QUALIFY row_number() OVER (PARTITION BY model_id ORDER BY md5(model_id || ':' || CAST(i AS VARCHAR))) <= {Q.SAMPLE}),
wide AS (SELECT model_id, i AS feature_idx, rn, batch_id,
  least(greatest({lit(0.25)} + CAST(c AS DOUBLE) + CASE WHEN (vec_id % 400 >= 200 AND i % 2 = 0)
    OR (vec_id % 400 >= 160 AND vec_id % 400 < 200 AND i = 1) THEN {lit(0.75)} ELSE {D0} END, {D0}), {D1}) AS x
  FROM wc JOIN ws USING (model_id, i)),
wn AS (SELECT model_id, CAST(count(DISTINCT i) AS BIGINT) AS n_features FROM ws GROUP BY model_id)"""


def _panel_sql() -> str:
    """All detectors of the panel over the sampled features; a vote a request, latched per batch."""
    keys = ["model_id", "feature_idx"]
    ctes, changes = [], []
    for name, opts in Q.PANEL.items():
        if name == "ADWIN":
            ctes.append(_adwin_sql("SELECT model_id, feature_idx, rn, x FROM wide", keys, opts["delta"]))
            changes.append("SELECT DISTINCT 'ADWIN' AS detector, model_id, feature_idx, t AS rn FROM chk WHERE cut")
        elif name == "SEED":
            ctes.append(_seed_ctes("wide", keys, C.SeedOptions(**opts)))
            changes.append("SELECT 'SEED', model_id, feature_idx, rn FROM sd")
        elif name == "SEQ1":
            ctes.append(_seqdrift1_ctes("wide", keys, C.SeqDrift1Options(**opts)))
            changes.append("SELECT 'SEQ1', model_id, feature_idx, rn FROM sq WHERE change")
        else:
            ctes.append(detector_fold(f"f_{name.lower()}", "wide", keys, name, **opts))
            changes.append(f"SELECT '{name}' AS detector, model_id, feature_idx, rn FROM f_{name.lower()} WHERE change")
    names = ", ".join(f"'{n}'" for n in Q.PANEL)
    return f"""WITH RECURSIVE {WIDE},
{", ".join(ctes)},
ch AS ({" UNION ALL ".join(changes)}),
votes AS (SELECT detector, model_id, rn FROM ch JOIN wn USING (model_id) GROUP BY detector, model_id, rn, n_features
          HAVING count(*) / n_features > {lit(Q.MAJORITY)}),
ba AS (SELECT DISTINCT detector, model_id, batch_id FROM votes JOIN wv USING (model_id, rn)),
grid AS (SELECT DISTINCT unnest([{names}]) AS detector, model_id, batch_id FROM wv),
lt AS (SELECT g.*, min(batch_id) OVER (PARTITION BY detector, model_id) AS fb, ba.batch_id IS NOT NULL AS alarm
       FROM grid AS g LEFT JOIN ba USING (detector, model_id, batch_id)),
st AS (SELECT detector, model_id, batch_id, max(CASE WHEN alarm AND batch_id > fb THEN 1 ELSE 0 END)
         OVER (PARTITION BY detector, model_id ORDER BY batch_id {UPTO}) = 1 AS change_detected FROM lt)
SELECT *, CASE WHEN change_detected THEN {lit(0.9)} ELSE {D0} END AS drift_probability FROM st"""


def _decay_wide_sql() -> str:
    fold = detector_fold("fold", "wide", ["model_id", "feature_idx"], "CUSUM", **Q.PANEL["CUSUM"])
    return f"""WITH RECURSIVE {WIDE},
{fold},
l AS (SELECT w.model_id, w.feature_idx, w.rn, last_value(CASE WHEN f.change THEN f.rn END IGNORE NULLS)
        OVER (PARTITION BY w.model_id, w.feature_idx ORDER BY w.rn {UPTO}) AS la
      FROM wide AS w JOIN fold AS f USING (model_id, feature_idx, rn)),
v AS (SELECT model_id, rn, avg(CASE WHEN la IS NULL THEN {D0} ELSE {D1} / ({D1} + exp((rn - la) - {lit(5.0)})) END) AS score
      FROM l GROUP BY model_id, rn)
SELECT model_id, rn AS req_id, round(score, 6) AS score FROM v WHERE score > {lit(Q.DECAY_THRESHOLD)}"""


def _kl_sql(name: str, signal: str = "s") -> str:
    o = C.KlOptions(**Q.KL_QUERIES[name])
    K, W = o.bins, o.window
    width = (o.hi - o.lo) / K
    counts = ", ".join(f"sum(CASE WHEN bin = {b} THEN 1 ELSE 0 END) AS c{b}" for b in range(K))
    pcols = ", ".join(f"p.c{b} AS p{b}" for b in range(K))
    half = lit(0.5 * K)
    terms = []
    for b in range(K):
        p = f"((CAST(p{b} AS DOUBLE) + {lit(0.5)}) / (CAST(pn AS DOUBLE) + {half}))"
        q = f"((CAST(c{b} AS DOUBLE) + {lit(0.5)}) / (CAST(n AS DOUBLE) + {half}))"
        terms.append(f"{p} * ln({p} / {q})")
    kl = " + ".join(terms)
    thr = chi2_95(K - 1)
    change = "FALSE" if thr == float("inf") else f"{lit(2.0 * W)} * ({kl}) > {lit(thr)}"
    return f"""WITH {SIG},
bb AS (SELECT model_id, (rn - 1) // {W} AS win,
       least(greatest(floor(({signal} - {lit(o.lo)}) / {lit(width)}), 0), {K - 1}) AS bin FROM sig),
c AS (SELECT model_id, win, count(*) AS n, {counts} FROM bb GROUP BY model_id, win),
j AS (SELECT c.*, p.n AS pn, {pcols} FROM c JOIN c AS p ON c.model_id = p.model_id AND c.win = p.win + 1)
SELECT model_id, win, round({kl}, 6) AS kl, {change} AS change FROM j"""


def _kl_vector_sql(rows: str) -> str:
    """CTE ``kv``: full windows of the whole-vector KL detector over a row CTE with model_id, rn, batch_id."""
    o = C.KlOptions(**Q.KL_QUERIES["kl_10_5"])
    K, W = o.bins, o.window
    width = (o.hi - o.lo) / K
    counts = ", ".join(f"sum(CASE WHEN bin = {b} THEN 1 ELSE 0 END) AS c{b}" for b in range(K))
    half = lit(0.5 * K)
    terms = []
    for b in range(K):
        p = f"((CAST(p.c{b} AS DOUBLE) + {lit(0.5)}) / (CAST(p.n AS DOUBLE) + {half}))"
        q = f"((CAST(c.c{b} AS DOUBLE) + {lit(0.5)}) / (CAST(c.n AS DOUBLE) + {half}))"
        terms.append(f"{p} * ln({p} / {q})")
    cells = " UNION ALL ".join(f"SELECT model_id, rn, batch_id, {i} AS f, {x} AS x FROM {rows}" for i, x in enumerate(
        ["s", f"user_id / {lit(100.0)}", f"k / {lit(100.0)}"]))
    return f""",
cells AS ({cells}),
bb AS (SELECT model_id, (rn - 1) // {W} AS win, f, batch_id,
       least(greatest(floor((x - {lit(o.lo)}) / {lit(width)}), 0), {K - 1}) AS bin FROM cells),
c AS (SELECT model_id, win, f, count(*) AS n, max(batch_id) AS batch_id, {counts} FROM bb GROUP BY model_id, win, f
      HAVING count(*) = {W}),
kf AS (SELECT c.model_id, c.win, c.batch_id, {lit(2.0 * W)} * ({" + ".join(terms)}) > {lit(chi2_95(K - 1))} AS ch
      FROM c JOIN c AS p ON c.model_id = p.model_id AND c.f = p.f AND c.win = p.win + 1),
kv AS (SELECT model_id, win, max(batch_id) AS batch_id, count(*) FILTER (WHERE ch) AS n_changed, bool_or(ch) AS change
      FROM kf GROUP BY model_id, win)"""


def _kl_kmeans_sql(window: int = 10, bins: int = 5) -> str:
    """k-means of the previous window by recursion: labels, means, labels, until the labels stay."""
    def dist(r: str, q: str) -> str:
        return " + ".join(f"({r}[{d}] - {q}[{d}]) * ({r}[{d}] - {q}[{d}])" for d in (1, 2, 3))

    def labels(x: str, c: str) -> str:
        near = f"list_transform({c}, lambda q: {dist('r', 'q')})"
        return f"list_transform({x}, lambda r: list_position({near}, list_min({near})))"

    means = ("list_transform(c, lambda q, j: CASE WHEN list_contains(lab, j) THEN list_transform([1, 2, 3], lambda d: "
             "list_reduce(list_transform(list_filter(ref, lambda r, i: lab[i] = j), lambda r: r[d]), lambda a, b: a + b) "
             "/ len(list_filter(lab, lambda l: l = j))) ELSE q END)")
    quantiles = "[" + ", ".join(lit(chi2_95(i)) for i in range(1, bins)) + "]"
    half = lit(0.5)
    share = "(len(list_filter({l}, lambda l: l = j)) + " + half + ") / (len({l}) + " + half + " * len(c))"
    p, q = share.format(l="lab"), share.format(l="cl")
    return f"""WITH RECURSIVE {SIG},
w AS (SELECT model_id, (rn - 1) // {window} AS win, list([s, user_id / {lit(100.0)}, k / {lit(100.0)}] ORDER BY rn) AS pts
      FROM sig GROUP BY ALL),
pr AS (SELECT a.model_id, a.win, b.pts AS ref, a.pts AS cur FROM w AS a JOIN w AS b
       ON a.model_id = b.model_id AND a.win = b.win + 1),
st AS (SELECT *, list_filter(ref, lambda r, i: list_position(ref, r) = i)[1:{bins}] AS c FROM pr),
km AS (
  SELECT model_id, win, ref, cur, c, {labels('ref', 'c')} AS lab, FALSE AS done FROM st
  UNION ALL
  SELECT model_id, win, ref, cur, c2, lab2, lab2 = lab FROM (
    SELECT *, {labels('ref', 'c2')} AS lab2 FROM (SELECT *, {means} AS c2 FROM km WHERE NOT done) AS m) AS n),
f AS (SELECT model_id, win, c, lab, {labels('cur', 'c')} AS cl FROM km WHERE done),
d AS (SELECT model_id, win, len(c) AS cells, list_reduce(list_transform(range(1, len(c) + 1),
        lambda j: ({p}) * ln(({p}) / ({q}))), lambda a, b: a + b) AS kl FROM f)
SELECT model_id, win, round(kl, 6) AS kl, cells > 1 AND {lit(2.0 * window)} * kl > {quantiles}[cells - 1] AS change FROM d"""


INS = "'ins-' || CAST(event_id AS VARCHAR)"
GOOD_BY_INSERT = f"""WITH {EV},
good AS (SELECT *, row_number() OVER (PARTITION BY model_id ORDER BY ts, {INS}) AS rn
         FROM sig0 WHERE event_id % 10 < 4)"""


def _sev_list() -> str:
    return "[" + ", ".join(f"'{s}'" for s in SEVERITY_ORDER) + "]"


def oracles() -> dict[str, str]:
    o: dict[str, str] = {}
    o["log_parse_requests"] = f"""WITH {EV}
SELECT model_id, model, axon, 'ins-' || CAST(event_id AS VARCHAR) AS insert_id,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS timestamp, CAST(1 AS BIGINT) AS n_rows,
       value AS f0, CAST(user_id AS DOUBLE) AS f1, CAST(k AS DOUBLE) AS f2
FROM ev WHERE event_id % 10 < 4"""
    o["log_reject_report"] = """SELECT CASE event_id % 10 WHEN 9 THEN 'bad_json' WHEN 8 THEN 'not_predict_or_proxy'
  WHEN 7 THEN 'not_predict_or_proxy' WHEN 6 THEN 'no_request_marker' WHEN 5 THEN 'no_request_marker'
  ELSE 'bad_vector' END AS reason, count(*) AS n
FROM events WHERE event_id % 10 >= 4 GROUP BY 1"""
    o["stream_rejects"] = o["log_reject_report"]
    o["log_message_rejects"] = """WITH l AS (
  SELECT event_id, event_id % 5 = 0 AS empty FROM events
  UNION ALL SELECT event_id, event_id % 3 = 0 FROM events WHERE event_id % 5 <> 0)
SELECT CASE WHEN empty THEN 'null_line' WHEN event_id % 10 = 9 THEN 'bad_json' WHEN event_id % 10 IN (7, 8) THEN 'not_predict_or_proxy'
  WHEN event_id % 10 = 6 THEN 'no_request_marker' ELSE 'bad_vector' END AS reason, count(*) AS n
FROM l WHERE empty OR event_id % 10 >= 4 GROUP BY 1"""
    o["log_parse_file_lines"] = f"""WITH {EV}
SELECT model, CAST(0 AS BIGINT) AS timestamp, value AS f0, CAST(user_id AS DOUBLE) AS f1, CAST(k AS DOUBLE) AS f2
FROM ev WHERE event_id % 10 IN (0, 1, 2, 3, 7)"""
    o["log_parse_responses"] = """SELECT 'ins-' || CAST(event_id AS VARCHAR) AS insert_id,
  CASE WHEN event_id % 10 = 5 THEN '{\\"score\\": ' || CAST(event_id AS VARCHAR) || '}' ELSE '{}' END AS response
FROM events"""
    o["log_prefilter_predict"] = """SELECT 'ins-' || CAST(event_id AS VARCHAR) AS insert_id FROM events
WHERE event_id % 3 = 0 AND event_id % 10 NOT IN (5, 6, 8)"""
    n = len(SEVERITY_ORDER)
    warn = SEVERITY_ORDER.index("WARNING")
    o["log_severity_filter"] = f"""SELECT 'ins-' || CAST(event_id AS VARCHAR) AS insert_id,
  list_extract({_sev_list()}, CAST(event_id % {n} + 1 AS INTEGER)) AS severity
FROM events WHERE event_id % 7 <> 0 AND event_id % 11 <> 0 AND event_id % {n} >= {warn} AND event_id % 10 <> 6"""
    o["vector_dims"] = """SELECT 'ins-' || CAST(event_id AS VARCHAR) AS insert_id, CAST(3 AS BIGINT) AS dim
FROM events WHERE event_id % 10 < 4"""
    o["vector_explode"] = f"""WITH {EV}
SELECT 'ins-' || CAST(event_id AS VARCHAR) AS insert_id, CAST(0 AS BIGINT) AS row_idx, CAST(0 AS BIGINT) AS feature_idx, value AS x FROM ev WHERE event_id % 10 < 4
UNION ALL SELECT 'ins-' || CAST(event_id AS VARCHAR), 0, 1, CAST(user_id AS DOUBLE) FROM ev WHERE event_id % 10 < 4
UNION ALL SELECT 'ins-' || CAST(event_id AS VARCHAR), 0, 2, CAST(k AS DOUBLE) FROM ev WHERE event_id % 10 < 4"""

    flag = _flagship()
    o["state_batches"] = flag + "\nSELECT model_id, batch_id, warning_detected, change_detected, drift_probability FROM st"
    o["stream_state"] = o["state_batches"]
    o["state_rows"] = flag + "\n" + STATE_ROWS
    g = Q.GATEWAY
    o["metric_lines"] = flag + f"""
SELECT 'http://{g['gateway']}.{g['namespace']}.svc.cluster.local:{g['port']}/metrics/job/' || model_id || '/pod/' AS url,
  replace('{Q.METRIC}_' || axon, '-', '__') || ' ' || CAST(drift_probability AS VARCHAR) || chr(10) AS line FROM st"""
    o["state_snapshot_all_keys"] = _flagship("AND NOT (model_id = 'error' AND batch_id % 2 = 0)") + f""",
s2 AS (SELECT model_id, batch_id, axon, drift_probability, TRUE AS has FROM st),
firsts AS (SELECT model_id, min(batch_id) AS fb FROM s2 GROUP BY model_id),
lastb AS (SELECT max(batch_id) AS lb FROM s2),
spine AS (SELECT model_id, unnest(range(fb, lb + 1)) AS batch_id FROM firsts, lastb),
j AS (SELECT sp.model_id, sp.batch_id, s2.axon, s2.drift_probability, s2.has
      FROM spine AS sp LEFT JOIN s2 ON sp.model_id = s2.model_id AND sp.batch_id = s2.batch_id)
SELECT model_id, batch_id,
  last_value(axon IGNORE NULLS) OVER (PARTITION BY model_id ORDER BY batch_id {UPTO}) AS axon,
  last_value(drift_probability IGNORE NULLS) OVER (PARTITION BY model_id ORDER BY batch_id {UPTO}) AS drift_probability,
  has IS NULL AS idle
FROM j"""
    days = "(batch_id - (SELECT min(batch_id) FROM ev))"
    o["stream_state_chunked"] = o["state_batches"]
    o["stream_snapshot_all_keys"] = _flagship(f"AND NOT (model_id = 'error' AND {days} // {Q.STREAM_DAYS} = 1)") + f""",
s2 AS (SELECT model_id, batch_id, axon, drift_probability, CAST(least({days} // {Q.STREAM_DAYS}, 2) AS BIGINT) AS epoch FROM st),
idle AS (SELECT e.epoch, m.model_id FROM (SELECT DISTINCT epoch FROM s2) AS e, (SELECT DISTINCT model_id FROM s2) AS m
         WHERE NOT EXISTS (SELECT 1 FROM s2 WHERE s2.epoch = e.epoch AND s2.model_id = m.model_id))
SELECT epoch, model_id, batch_id, axon, drift_probability FROM s2
UNION ALL
SELECT i.epoch, i.model_id, max(s2.batch_id), arg_max(s2.axon, s2.batch_id), arg_max(s2.drift_probability, s2.batch_id)
FROM idle AS i JOIN s2 ON s2.model_id = i.model_id AND s2.epoch < i.epoch GROUP BY i.epoch, i.model_id"""
    o["state_metadata_first"] = "WITH " + GOOD.format(extra="") + """
SELECT model_id, batch_id, arg_min(model, ts) AS model, arg_min(axon, ts) AS axon, count(*) AS n_requests
FROM good GROUP BY model_id, batch_id"""
    latch = "WITH RECURSIVE " + SIG + _states_sql("sig", "EDDM", ["b"], {}, meta=False)
    o["state_latch"] = latch + "\nSELECT model_id, batch_id, warning_detected, change_detected FROM st"
    o["score_map"] = latch + "\nSELECT model_id, batch_id, drift_probability FROM st"

    o["kl_vector_10_5"] = f"WITH {SIG}" + _kl_vector_sql("sig") + "\nSELECT * FROM kv"
    o["job_kl_states"] = GOOD_BY_INSERT + _kl_vector_sql("good") + """,
ba AS (SELECT model_id, batch_id, TRUE AS warning, TRUE AS change FROM kv WHERE change GROUP BY model_id, batch_id),
grid AS (SELECT model_id, batch_id, arg_min(axon, rn) AS axon FROM good GROUP BY model_id, batch_id)""" + LATCH + "\n" + STATE_ROWS
    o["kl_kmeans_10_5"] = _kl_kmeans_sql()
    o["state_expired"] = (o["job_kl_states"].replace(STATE_ROWS, f"SELECT * FROM ({STATE_ROWS})")
                          + f" WHERE CAST(timestamp AS TIMESTAMP) >= TIMESTAMP '{Q.RETENTION_ASOF}' - INTERVAL {Q.EXPIRY_SECONDS} SECOND")
    o["log_dim_mismatch"] = GOOD_BY_INSERT + f""",
d AS (SELECT *, CASE WHEN event_id % 10 = 3 THEN 4 ELSE 3 END AS dim FROM good)
SELECT d.model_id, {INS} AS insert_id, 'dim_mismatch' AS reason
FROM d JOIN (SELECT model_id, dim FROM d WHERE rn = 1) AS f ON d.model_id = f.model_id WHERE d.dim <> f.dim"""

    for name in Q.DETECTOR_QUERIES:
        o[name] = _adwin_det_sql() if name == "det_adwin" else _detector_sql(name)
    for name in Q.FEATURE_QUERIES:
        o[name] = _adwin_feat_sql() if name == "feat_adwin" else _feature_sql(name)

    o["det_seed"] = _seed_sql()
    o["det_seqdrift1"] = _seqdrift1_sql()
    o["det_adwin_histogram"] = _adwin_blocks_sql()
    for name in Q.KL_QUERIES:
        o[name] = _kl_sql(name)
    o["vote_warning_equals_change"] = ("SELECT model_id, win, change AS warning, change FROM ("
                                       + _kl_sql("kl_10_5") + ") AS k WHERE change")
    o["cusum_first_alarm"] = f"""WITH {SIG},
c AS (SELECT model_id, rn, s, sum(s) OVER (PARTITION BY model_id ORDER BY rn {UPTO}) AS cx FROM sig),
v AS (SELECT *, s - cx / rn - {lit(0.005)} AS v FROM c),
p AS (SELECT *, sum(v) OVER (PARTITION BY model_id ORDER BY rn {UPTO}) AS p FROM v),
pm AS (SELECT *, min(p) OVER (PARTITION BY model_id ORDER BY rn {UPTO}) AS pm FROM p)
SELECT model_id, min(rn) AS rn FROM pm WHERE rn >= 30 AND p - least({D0}, pm) > {lit(50.0)} GROUP BY model_id"""
    o["ddm_first_alarm"] = f"""WITH {SIG},
c AS (SELECT model_id, rn, sum(b) OVER (PARTITION BY model_id ORDER BY rn {UPTO}) AS cx FROM sig),
q AS (SELECT *, cx / rn AS p FROM c),
r AS (SELECT *, p * ({D1} - p) / rn AS rad FROM q),
s AS (SELECT *, p + sqrt(rad) AS ps, sqrt(rad) AS sd FROM r WHERE rn >= 30 AND rad >= {D0}),
m AS (SELECT *, min({{'ps': ps, 'p': p, 's': sd}}) OVER (PARTITION BY model_id ORDER BY rn {UPTO}) AS mm FROM s)
SELECT model_id,
  min(rn) FILTER (WHERE ps > mm.p + {lit(2.0)} * mm.s) AS first_warning_rn,
  min(rn) FILTER (WHERE ps > mm.p + {lit(3.0)} * mm.s) AS first_change_rn
FROM m GROUP BY model_id"""
    o["poll_request_end"] = f"""WITH RECURSIVE {SIG},
src AS (SELECT model_id, rn, b AS x FROM sig),
{detector_fold('fold', 'src', ['model_id'], 'EWMA')},
ends AS (SELECT model_id, (rn - 1) // {Q.ROWS_PER_REQUEST} AS req_id, max(rn) AS rn FROM sig GROUP BY ALL)
SELECT e.model_id, e.req_id, f.warning, f.change FROM ends AS e JOIN fold AS f ON e.model_id = f.model_id AND e.rn = f.rn
WHERE f.warning OR f.change"""
    o["vote_any"] = _feature_end_flags() + """SELECT model_id, req_id, bool_or(warning) AS warning, bool_or(change) AS change
FROM ef WHERE warning OR change GROUP BY model_id, req_id"""
    o["vote_majority"] = _feature_end_flags() + f""", nf AS (SELECT model_id, max(feature_idx) + 1 AS n_features FROM fl GROUP BY model_id),
v AS (SELECT model_id, req_id, count(*) AS n_changed FROM ef WHERE change GROUP BY model_id, req_id)
SELECT v.model_id, v.req_id, round(n_changed / n_features, 6) AS vote FROM v JOIN nf ON v.model_id = nf.model_id
WHERE n_changed / n_features > {lit(Q.VOTE_THRESHOLD)}"""
    o["vote_logistic_decay"] = _feature_end_flags() + f""", reqs AS (SELECT DISTINCT model_id, feature_idx, req_id FROM fl),
j AS (SELECT r.*, CASE WHEN ef.change THEN r.req_id END AS alarm_req FROM reqs AS r LEFT JOIN ef
      ON r.model_id = ef.model_id AND r.feature_idx = ef.feature_idx AND r.req_id = ef.req_id),
l AS (SELECT *, last_value(alarm_req IGNORE NULLS) OVER (PARTITION BY model_id, feature_idx ORDER BY req_id {UPTO}) AS la FROM j),
pv AS (SELECT model_id, req_id, avg(CASE WHEN la IS NULL THEN {D0} ELSE {D1} / ({D1} + exp((req_id - la) - {lit(5.0)})) END) AS score
       FROM l GROUP BY model_id, req_id)
SELECT model_id, req_id, round(score, 6) AS score FROM pv WHERE score > {lit(Q.VOTE_THRESHOLD)}"""

    o["vote_majority_detectors"] = _panel_sql()
    o["vote_decay_wide"] = _decay_wide_sql()
    o["state_recent_first"] = flag + "\n" + STATE_ROWS
    o["state_retention"] = flag + f""",
sr AS ({STATE_ROWS})
SELECT * FROM sr WHERE NOT (axon = '{Q.RETENTION_AXON}'
  AND CAST(timestamp AS TIMESTAMP) < TIMESTAMP '{Q.RETENTION_ASOF}' - INTERVAL 10 MINUTE)"""
    o["state_count"] = flag + f",\nsr AS ({STATE_ROWS})\nSELECT count(*) AS n FROM sr"
    o["state_latest"] = flag + f""",
sr AS ({STATE_ROWS})
SELECT model_id, axon, drift_probability, timestamp FROM (
  SELECT *, row_number() OVER (PARTITION BY model_id ORDER BY timestamp DESC) AS r FROM sr) WHERE r = 1"""
    return {k: v for k, v in o.items() if v}
