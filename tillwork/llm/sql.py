"""DuckDB SQL for the corpus queries that SQL can express, written from their definitions."""

from __future__ import annotations

from tillwork.llm.licences import TEMPLATES

_VALUES = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in TEMPLATES.items())

LICENCES = rf"""
WITH texts AS (SELECT row_number() OVER () AS row, doc_id,
                      regexp_replace(lower(text), '[^\p{{L}}\p{{N}}\n]+', ' ', 'g') AS text
               FROM documents WHERE text IS NOT NULL),
lines AS (SELECT row, doc_id, 'line' AS kind, unnest(string_split(text, chr(10))) AS unit,
                 generate_subscripts(string_split(text, chr(10)), 1) - 1 AS place FROM texts),
parts AS (SELECT row, doc_id, regexp_split_to_array(text, '\n *\n[ \n]*') AS list, text FROM texts),
paragraphs AS (SELECT row, doc_id, 'paragraph' AS kind, unnest(list) AS unit,
                      generate_subscripts(list, 1) - 1 AS place FROM parts),
units AS (SELECT * FROM lines
          UNION ALL SELECT * FROM paragraphs WHERE contains(unit, chr(10))
          UNION ALL SELECT row, doc_id, 'text', text, 0 FROM parts WHERE len(list) > 1),
words AS (SELECT row, doc_id, kind, place,
                 list_filter(regexp_split_to_array(unit, '[ \n]+'), lambda w: w <> '') AS w FROM units),
grams AS (SELECT row, doc_id, kind, place, len(w) - 1 AS n,
                 unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g
          FROM words WHERE len(w) > 1),
counted AS (SELECT row, doc_id, kind, place, n, g, count(*) AS c FROM grams GROUP BY ALL),
notices(licence, notice) AS (VALUES {_VALUES}),
t_words AS (SELECT licence, list_filter(regexp_split_to_array(
                regexp_replace(lower(notice), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' '), lambda w: w <> '') AS w FROM notices),
t_grams AS (SELECT licence, len(w) - 1 AS t,
                   unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM t_words),
t_counted AS (SELECT licence, t, g, count(*) AS tc FROM t_grams GROUP BY ALL),
scored AS (SELECT row, doc_id, kind, place, n, licence, 2 * sum(least(c, tc)) / (n + t) AS dice
           FROM counted JOIN t_counted USING (g) GROUP BY row, doc_id, kind, place, n, licence, t
           HAVING 2 * sum(least(c, tc)) / (n + t) >= 0.8),
ranked AS (SELECT *, row_number() OVER (PARTITION BY row, kind, place ORDER BY dice DESC, licence) AS k FROM scored)
SELECT doc_id, kind, CAST(place AS INTEGER) AS place, CAST(n AS INTEGER) AS n_bigrams, licence,
       round(CAST(dice AS DOUBLE), 6) AS dice FROM ranked WHERE k = 1
"""

VECTORS = """
WITH RECURSIVE good AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) > 0),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM good x JOIN good y ON x.label = y.label AND x.vec_id <> y.vec_id
          WHERE list_cosine_similarity(x.v, y.v) >= 0.98),
reached(vec_id, other) AS (SELECT vec_id, vec_id FROM embeddings
                           UNION SELECT r.vec_id, l.b FROM reached r JOIN links l ON r.other = l.a)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE a = e.vec_id) AS n_links, min(other) AS component_id,
       e.vec_id = min(other) AS kept
FROM embeddings e JOIN reached r USING (vec_id) GROUP BY e.vec_id
"""

TOP_VECTORS = """
WITH good AS (
    SELECT vec_id, row_number() OVER () AS row,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (SELECT q.row AS q_row, q.vec_id AS query_id, c.row, c.vec_id,
                  CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
           FROM good q JOIN good c ON q.row <> c.row WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY q_row ORDER BY score DESC, vec_id NULLS LAST, row) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

COLLOCATIONS = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (SELECT lang, unnest(list_transform(range(1, CAST(len(w) - k + 2 AS BIGINT)), lambda i: list_slice(w, i, i + k - 1))) AS p
          FROM words, (VALUES (1), (2), (3), (4)) AS lengths(k)),
f AS (SELECT lang, p, count(*) AS a FROM grams GROUP BY lang, p),
n AS (SELECT lang, sum(a) AS n FROM f WHERE len(p) = 1 GROUP BY lang),
candidates AS (SELECT * FROM f WHERE len(p) > 1 AND a >= 30),
cuts AS (SELECT c.lang, c.p, c.a, k, x.a AS l, y.a AS r,
                CAST((CAST(2000000 AS HUGEINT) * c.a) // (CAST(x.a AS HUGEINT) + y.a) AS BIGINT) AS score
         FROM (SELECT *, unnest(range(1, len(p))) AS k FROM candidates) c
         JOIN f x ON x.lang = c.lang AND x.p = list_slice(c.p, 1, k)
         JOIN f y ON y.lang = c.lang AND y.p = list_slice(c.p, k + 1, len(c.p))),
cheapest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
spans(begin, size) AS (VALUES (1, 2), (2, 2), (3, 2), (1, 3), (2, 3)),
inside AS (SELECT lang, list_slice(p, begin, begin + size - 1) AS p, max(a) AS longer
           FROM candidates, spans WHERE size < len(p) AND begin + size - 1 <= len(p) GROUP BY ALL),
kept AS (SELECT c.* FROM cheapest c LEFT JOIN inside i ON i.lang = c.lang AND i.p = c.p
         WHERE 100 * coalesce(longer, 0) < 80 * a),
named AS (SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, score FROM kept),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM named)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""
