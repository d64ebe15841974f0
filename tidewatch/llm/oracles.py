"""DuckDB SQL for the queries that SQL can express."""

WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

VECTOR_LINKS = """
WITH RECURSIVE rows_ AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings),
v AS (
  SELECT r, embedding::DOUBLE[] AS e FROM rows_
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.r AS u, b.r AS w FROM v a JOIN v b ON a.r <> b.r AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (
  SELECT r, r AS t FROM rows_ UNION SELECT reach.r, links.w FROM reach JOIN links ON links.u = reach.t
), part AS (SELECT reach.r, min(vec_id) AS component_id FROM reach JOIN rows_ ON rows_.r = reach.t GROUP BY reach.r),
counts AS (SELECT u AS r, count(*) AS n FROM links GROUP BY u)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM rows_ JOIN part USING (r) LEFT JOIN counts USING (r)
"""

JACCARD_GROUPS = f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS} AS ws FROM documents),
grams AS (
  SELECT DISTINCT doc_id, md5(CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[p:p+4], ' ') END) AS g
  FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 4, 1))) AS p FROM w WHERE len(ws) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT u, v FROM shared JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v
          WHERE 5 * shared.n >= 4 * (x.n + y.n - shared.n)),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, links.v FROM reach JOIN links ON links.u = reach.r),
counts AS (SELECT u AS doc_id, count(*) AS n FROM links GROUP BY u)
SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_links, min(r) AS class_id
FROM reach LEFT JOIN counts USING (doc_id) GROUP BY doc_id
"""

TOP_PRODUCTS = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS z FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, list_inner_product(q.z::DOUBLE[], c.z::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.r <> q.r
), ranked AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

MIX = f"""
WITH q AS (SELECT doc_id, max(quality) AS quality FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
d AS (
  SELECT doc_id, source, len({WORDS})::BIGINT AS size,
         -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(md5(text), '') || ':'
           || row_number() OVER (PARTITION BY doc_id, source, text)), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
           / CASE quality WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 ELSE 1.0 END AS key
  FROM documents LEFT JOIN q USING (doc_id)
), s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (
  SELECT *, [5.0::DOUBLE, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w, 2.0::DOUBLE * source_size AS most FROM s0
), s2 AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(most) OVER before, 0))
            / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS level,
         row_number() OVER (ORDER BY most / w, source NULLS LAST) AS nth
  FROM s1 WINDOW before AS (ORDER BY most / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), s3 AS (SELECT *, min(CASE WHEN most > w * level THEN nth END) OVER () AS free FROM s2),
s4 AS (SELECT *, CASE WHEN free IS NULL OR nth < free THEN most ELSE w * max(CASE WHEN nth = free THEN level END) OVER () END AS target FROM s3),
t AS (
  SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS e,
         sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto
  FROM d JOIN s4 ON d.source IS NOT DISTINCT FROM s4.source
), u AS (
  SELECT *, (e + CASE WHEN upto - size / 2 <= target - e * source_size AND target - e * source_size > 0 THEN 1 ELSE 0 END)::BIGINT AS epochs FROM t
)
SELECT doc_id, size, source_size, target::DOUBLE AS target, (epochs * size)::BIGINT AS taken, epochs FROM u
"""

REPEATS = f"""
WITH w AS (SELECT doc_id, {WORDS} AS ws FROM documents),
win AS (SELECT doc_id, p, md5(array_to_string(ws[p:p+34], ' ')) AS h
        FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 34)) AS p FROM w WHERE len(ws) >= 35)),
twice AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(p, p + 34)) AS i FROM win SEMI JOIN twice USING (h)),
words AS (SELECT doc_id, unnest(ws) AS x, unnest(generate_series(1, len(ws))) AS i FROM w),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""

HARD_NEGATIVES = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS z
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.r, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.z, b.z)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.r <> b.r
), pos AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS nth FROM pairs WHERE same QUALIFY nth <= 5
), neg AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.r, p.nth ORDER BY n.score DESC, n.vec_id)::INT AS rank
  FROM pos p JOIN pairs n ON p.r = n.r AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 3
"""

RESAMPLED = """
WITH table_rows AS (
  SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS crc
  FROM (SELECT unnest(range(256))::BIGINT AS n)
), d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents
), b AS (
  SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w FROM benchmark
), f AS (SELECT r, unnest(ws) AS w FROM d),
words AS (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM f UNION SELECT w FROM b)),
hashed AS (
  SELECT w, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, len(h), 2), lambda i: ('0x' || h[i:i+1])::BIGINT)),
    lambda c, x: xor(crc[(xor(c, x) & 255) + 1], c >> 8))) % 10000 AS bucket FROM words, table_rows
), s AS (SELECT bucket, count(*) AS s FROM f JOIN hashed USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM b JOIN hashed USING (w) GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM f) + 10000)::DOUBLE
    / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM b) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM (SELECT DISTINCT bucket FROM hashed) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)
), sums AS (SELECT r, count(*) AS n, sum(gain)::BIGINT AS gain FROM f JOIN hashed USING (w) JOIN gains USING (bucket) GROUP BY r),
weights AS (
  SELECT d.r, doc_id, coalesce(n, 0) AS n_features, CASE WHEN n > 0 THEN floor(gain::DOUBLE / n)::BIGINT ELSE 0 END AS weight,
         ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
  FROM d LEFT JOIN sums USING (r)
), scored AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM weights),
ranked AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features) AS rank FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score,
       CASE WHEN rank <= (SELECT 10 * count(*) // 100 FROM ranked) THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (r)
"""
