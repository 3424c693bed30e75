"""DuckDB SQL for the corpus queries that SQL can express."""

MIX = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), quality AS (
  SELECT doc_id, min(quality) AS q FROM labels WHERE quality IS NOT NULL GROUP BY doc_id
), keyed AS (
  SELECT d.*, row_number() OVER () AS nr,
    -ln((('0x' || substr(md5('mix:' || coalesce(d.doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
      / CASE q WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 ELSE 1.0 END AS key
  FROM docs d LEFT JOIN quality USING (doc_id)
), sources AS (
  SELECT source, source_size, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w
  FROM (SELECT source, sum(size)::DOUBLE AS source_size FROM docs GROUP BY source)
), share(step, source, source_size, w, target, fixed) AS (
  SELECT 0, source, source_size, w, 0.0::DOUBLE, false FROM sources
  UNION ALL
  SELECT step + 1, source, source_size, w, least(proposed, 2 * source_size),
         fixed OR proposed >= 2 * source_size
  FROM (
    SELECT *, CASE WHEN fixed THEN 2 * source_size ELSE
      (1.5 * sum(source_size) OVER () - coalesce(sum(2 * source_size) FILTER (fixed) OVER (), 0)) * w
        / sum(w) FILTER (NOT fixed) OVER () END AS proposed
    FROM share WHERE step < 40
  )
), plan AS (
  SELECT source, source_size, target,
    CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM share WHERE step = 40
), placed AS (
  SELECT k.*, p.source_size, p.target, p.epochs, p.target - p.epochs * p.source_size AS rest,
    sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size, nr) - size AS start
  FROM keyed k JOIN plan p ON k.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
  (size * (epochs + CASE WHEN start + size / 2.0 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed
"""

VECTORS = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), reached(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
)
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e
LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) c ON c.a = e.vec_id
LEFT JOIN (SELECT a, min(b)::BIGINT AS component_id FROM reached GROUP BY a) r ON r.a = e.vec_id
"""

WARC = """
WITH records AS (
  SELECT page_id AS key, octet_length(encode(
    'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '')
    || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: '
    || octet_length(encode(coalesce(html, '')))::VARCHAR || chr(13) || chr(10) || chr(13) || chr(10)
    || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10)))::BIGINT AS length
  FROM pages WHERE page_id IS NOT NULL
), placed AS (
  SELECT *, (sum(length) OVER (PARTITION BY key // 4096 ORDER BY key) - length)::BIGINT AS start FROM records
)
SELECT key // 4096 AS archive, (key % 4096)::INTEGER AS slot, key,
  CASE WHEN key % 101 = 11 THEN 'missing' WHEN key % 97 = 5 THEN 'changed' ELSE 'resized' END AS fault, start AS byte_offset, length,
  CASE WHEN key % 101 = 11 THEN NULL WHEN key % 97 = 5 THEN length ELSE length - 3 END AS replica_length
FROM placed WHERE key % 101 = 11 OR key % 97 = 5 OR key % 89 = 7
UNION ALL
SELECT -((key + 4096) // 4096), (4095 - key % 4096)::INTEGER, -key - 1, 'extra', NULL, NULL, length
FROM records WHERE key % 103 = 13
"""

COLLOCATIONS = r"""
WITH doc AS (
            SELECT coalesce(lang, 'und') AS lang,
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
        piece AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM doc),
        worded AS (SELECT lang, [x FOR x IN regexp_split_to_array(p, '[\x20\x09]+') IF x <> ''] AS w FROM piece),
        gram AS (
            SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase
            FROM worded, (VALUES (1), (2), (3), (4)) AS sizes(k)),
        f AS (SELECT lang, phrase, k, count(*) AS f FROM gram GROUP BY ALL HAVING count(*) >= 30),
        total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM worded GROUP BY 1),
        cut AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS c FROM f WHERE k > 1),
        part AS (
            SELECT lang, phrase, a, c, array_to_string(w[1:c], ' ') AS one, array_to_string(w[c + 1:k], ' ') AS two FROM cut),
        scored AS (
            SELECT part.lang, part.phrase, a, c, x.f AS l, y.f AS r, (2000000::HUGEINT * a) // (x.f + y.f) AS score
            FROM part JOIN f x ON x.lang = part.lang AND x.phrase = one JOIN f y ON y.lang = part.lang AND y.phrase = two),
        lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
        longer AS (SELECT lang, k, f, string_split(phrase, ' ') AS w, unnest(range(2, k)) AS m FROM f WHERE k > 2),
        inside AS (
            SELECT lang, f, unnest([array_to_string(w[i:i + m - 1], ' ') FOR i IN range(1, k - m + 2)]) AS phrase FROM longer),
        most AS (SELECT lang, phrase, max(f) AS most FROM inside GROUP BY 1, 2),
        ranked AS (
            SELECT lowest.lang, row_number() OVER (PARTITION BY lowest.lang ORDER BY score DESC, a DESC, lowest.phrase) AS rank,
                lowest.phrase, a, l, r, n, CAST(score AS BIGINT) AS score
            FROM lowest JOIN total ON total.lang = lowest.lang
            LEFT JOIN most ON most.lang = lowest.lang AND most.phrase = lowest.phrase
            WHERE most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * a)
        SELECT * FROM ranked WHERE rank <= 2000
"""

ORACLES: dict[str, str] = {
    "op7_source_mix": MIX,
    "op9_warc_fixity": WARC,
    "op10_multi_index": VECTORS,
    "op12_collocations": COLLOCATIONS,
}
