"""The queries SQL can express, in the SQL of DuckDB."""

from __future__ import annotations

# Components by links(a, b) of nodes(id): the smallest id that can be reached.
_REACH = r"""
ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
    SELECT id, id AS seen FROM nodes
    UNION
    SELECT reach.id, ways.b FROM reach JOIN ways ON reach.seen = ways.a),
parts AS (SELECT id, min(seen) AS component_id FROM reach GROUP BY id)
"""

OP2 = rf"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + least(len(w), 5) - 1], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS m
    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (
    SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
    WHERE 100 * m >= 85 * (p.n + q.n - m)),
nodes AS (SELECT doc_id AS id FROM documents),
{_REACH}
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN parts ON id = doc_id LEFT JOIN sizes USING (doc_id)
"""

OP6 = r"""
WITH words AS (
    SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
windows AS (
    SELECT doc_id, i, array_to_string(w[i : i + 49], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words)),
firsts AS (SELECT s, min(doc_id) AS first_id FROM windows GROUP BY s),
gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS place
    FROM windows JOIN firsts USING (s) WHERE first_id < doc_id),
each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM words),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS rest, count(*) AS n
    FROM each ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""

OP1 = r"""
WITH sized AS (
    SELECT doc_id, coalesce('0' || source, '1') AS source,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
    FROM documents),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size, 2.0::DOUBLE * sum(size) AS most,
           [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY encode(source)) - 1) % 3 + 1]::DOUBLE AS weight
    FROM sized GROUP BY source),
-- Sources in the order in which a rising level limits them, and the level that results if the first ones are limited.
filled AS (
    SELECT *, row_number() OVER o AS i,
           coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS given,
           sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free
    FROM sources WINDOW o AS (ORDER BY most / weight, source)),
levels AS (
    SELECT *, (1.5::DOUBLE * (SELECT sum(size) FROM sized) - given) / free AS level FROM filled),
level AS (SELECT level FROM levels WHERE most >= weight * level ORDER BY i LIMIT 1),
targets AS (
    SELECT source, source_size, least(most, weight * (SELECT level FROM level)) AS target,
           ('0x' || left(md5(source || '/17'), 6))::BIGINT AS offset_units
    FROM sources),
steps AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size * 16777216)::BIGINT ELSE 0 END AS step
    FROM sized JOIN targets USING (source)),
summed AS (
    SELECT *, offset_units + step * (row_number() OVER (PARTITION BY source ORDER BY size, doc_id) - 1) AS start
    FROM steps)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * (((start + step) >> 24) - (start >> 24)))::BIGINT AS taken
FROM summed
"""

OP8 = rf"""
WITH RECURSIVE vectors AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
      AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
links AS (
    SELECT x.vec_id AS a, y.vec_id AS b
    FROM vectors x JOIN vectors y ON x.label = y.label AND x.vec_id < y.vec_id AND len(x.v) = len(y.v)
    WHERE list_cosine_similarity(x.v, y.v) >= 0.98),
nodes AS (SELECT vec_id AS id FROM embeddings),
{_REACH},
counts AS (SELECT a AS id, count(*) AS n FROM ways GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN parts ON parts.id = vec_id LEFT JOIN counts ON counts.id = vec_id
"""

OP5 = r"""
WITH lists AS (
    SELECT doc_id, coalesce(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
    FROM documents),
words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS place, unnest(w) AS word FROM lists),
pairs AS (SELECT *, lag(word) OVER (PARTITION BY doc_id ORDER BY place) AS before FROM words),
alone AS (SELECT word, count(*) AS n FROM words GROUP BY word),
together AS (SELECT before, word, count(*) AS n FROM pairs WHERE before IS NOT NULL GROUP BY ALL),
terms AS (
    SELECT doc_id, CASE
        WHEN pairs.before IS NULL THEN ln(alone.n / (SELECT count(*) FROM words))
        WHEN together.n >= 2 THEN ln(together.n / earlier.n)
        ELSE ln(0.4::DOUBLE * alone.n / (SELECT count(*) FROM words)) END AS term
    FROM pairs JOIN alone USING (word) LEFT JOIN alone earlier ON earlier.word = before
         LEFT JOIN together ON together.before = pairs.before AND together.word = pairs.word),
sums AS (SELECT doc_id, sum(round(term * 1000000)::BIGINT)::BIGINT AS log_score FROM terms GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(log_score, 0) AS log_score,
       CASE WHEN len(w) > 0 THEN log_score / len(w) / 1000000.0::DOUBLE END AS mean_log_score
FROM lists LEFT JOIN sums USING (doc_id)
"""

OP11 = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(
        text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
    SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS g FROM (
        SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM lists, (VALUES (1), (2), (3)) sizes(k))),
counts AS (SELECT lang, g, k, count(*) AS f FROM grams GROUP BY lang, g, k),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
found AS (SELECT *, string_split(g, ' ') AS w FROM counts WHERE k > 1 AND f >= 10),
longer AS (
    SELECT lang, part, max(f) AS most FROM (
        SELECT lang, f, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS part FROM found WHERE k = 3)
    GROUP BY lang, part),
parts AS (
    SELECT lang, g, f AS a, i, array_to_string(w[1:i], ' ') AS head, array_to_string(w[i + 1 : k], ' ') AS rest
    FROM (SELECT *, unnest(range(1, k)) AS i FROM found)),
cuts AS (
    SELECT parts.*, x.f AS l, y.f AS r, (1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS score
    FROM parts JOIN counts x ON x.lang = parts.lang AND x.g = head JOIN counts y ON y.lang = parts.lang AND y.g = rest),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, i) = 1),
ranked AS (
    SELECT best.lang, best.g AS phrase, a, l, r, score::BIGINT AS score,
           row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, a DESC, encode(best.g)) AS rank
    FROM best LEFT JOIN longer ON longer.lang = best.lang AND longer.part = best.g
    WHERE best.a > 2 * coalesce(most, 0))
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

OP13 = r"""
WITH vectors AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
    SELECT a.vec_id AS anchor_id, x.vec_id, x.label = a.label AS same, list_dot_product(a.v, x.v)::BIGINT AS score
    FROM vectors a JOIN vectors x ON x.vec_id <> a.vec_id AND len(x.v) = len(a.v)
    WHERE a.vec_id % 100 = 0),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""


def statements() -> dict[str, str]:
    return {
        "op1_systematic": OP1,
        "op5_backoff": OP5,
        "op8_multi_index": OP8,
        "op2_minmax": OP2,
        "op6_seeds": OP6,
        "op11_streams": OP11,
        "op13_hilbert": OP13,
    }
