"""SQL for DuckDB with the results of the queries that SQL can express."""

from __future__ import annotations

from leakscope.llm import mixing

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE_WORDS = r"[^\x20\x09-\x0D]+"

_JACCARD = rf"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '{_SPACE_WORDS}') AS w FROM documents),
s AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 3), ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 3) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o
      FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 100 * o >= 85 * (x.n + y.n - o)),
r AS (SELECT doc_id, doc_id AS reached FROM d UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.reached)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reached) AS component_id,
       (SELECT count(*) FROM l WHERE l.a = d.doc_id) AS n_links
FROM d JOIN r USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id
"""

_WINDOWS = r"""
WITH i AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
i2 AS (SELECT item, least(len(w), 10) AS n, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS place
       FROM i WHERE len(w) > 0),
win AS (SELECT DISTINCT item, n, array_to_string(list_slice(w, place, place + n - 1), ' ') AS g FROM i2),
d AS (SELECT doc_id, regexp_extract_all(coalesce(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ''),
          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
spans AS (SELECT DISTINCT n FROM win),
d2 AS (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS place FROM d, spans WHERE len(w) >= n),
hit AS (SELECT doc_id, place, win.n AS n, item FROM d2 JOIN win
        ON win.n = d2.n AND win.g = array_to_string(list_slice(w, place, place + d2.n - 1), ' ')),
word AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
             SELECT doc_id, unnest(range(place, place + n)) AS p FROM (SELECT DISTINCT doc_id, place, n FROM hit)) GROUP BY 1),
item AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
         FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN word USING (doc_id) LEFT JOIN item USING (doc_id)
"""

_MIX = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_SPACE_WORDS}')) AS size,
                  substring(md5(concat_ws('|', '{mixing.SEED}', coalesce(CAST(doc_id AS VARCHAR), 'null'),
                                          md5(coalesce(text, '')))), 1, 16) AS draw FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
      FROM d GROUP BY source),
f AS (SELECT *, 2 * source_size AS cap, sum(source_size) OVER () * 1.5 AS budget,
             coalesce(sum(2 * source_size) OVER (ORDER BY 2 * source_size / weight, source NULLS LAST
                                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled,
             sum(weight) OVER (ORDER BY 2 * source_size / weight, source NULLS LAST
                               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open FROM s),
v AS (SELECT max(CASE WHEN cap > weight * (CAST(budget - filled AS DOUBLE) / open)
                      THEN CAST(budget - filled AS DOUBLE) / open END) AS level FROM f),
t AS (SELECT source, source_size, CAST(budget AS DOUBLE) AS budget,
             least(CAST(cap AS DOUBLE), weight * coalesce(level, CAST('infinity' AS DOUBLE))) AS target FROM f, v),
q AS (SELECT d.*, source_size, target, budget,
             sum(size) OVER (PARTITION BY d.source ORDER BY draw, doc_id) AS ahead
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source WHERE size > 0),
c AS (SELECT q.*, copy, CAST(ahead + copy * source_size AS DOUBLE) / target AS finish
      FROM q, (VALUES (0), (1)) AS v(copy)),
u AS (SELECT *, sum(size) OVER (ORDER BY finish, source NULLS FIRST, copy, ahead) AS used FROM c)
SELECT doc_id, size, source_size, target, CAST(sum(CASE WHEN used <= budget THEN size ELSE 0 END) AS BIGINT) AS taken
FROM u GROUP BY doc_id, size, source_size, target
UNION ALL
SELECT doc_id, size, source_size, target, 0 FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source WHERE size = 0
"""

_CHAT = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
           UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
k AS (SELECT *, length(regexp_replace(text, '%|<\|', '\0##', 'g')) AS own,
             len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + 1 AS tokens FROM c),
o AS (SELECT *, row_number() OVER w AS place, sum(tokens) OVER w - tokens AS before
      FROM k WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)),
s AS (SELECT *, place = 1 AND role = 'system' AS is_system FROM o),
g AS (SELECT *, greatest((896 - sum(CASE WHEN is_system THEN tokens ELSE 0 END) OVER (PARTITION BY conv_id)) // 2, 1)
                AS step FROM s),
t AS (SELECT *, before // step AS span, 2 + length(regexp_replace(replace(role, chr(10), '   '),
                '%25|%|<\||\|>', '\0##', 'g')) + 3 + 8 AS mark FROM g),
v AS (SELECT conv_id, span, min(before) AS start FROM t GROUP BY ALL),
f AS (SELECT t.conv_id, sum(own + mark) AS formatted_chars FROM t JOIN v ON v.conv_id = t.conv_id
      AND (v.span = t.span OR v.span > t.span AND (is_system OR start - before <= 128)) GROUP BY 1),
a AS (SELECT conv_id, count(*) AS n_turns,
             sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
             coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY place), '') AS learned
      FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars FROM a JOIN f USING (conv_id)
"""

_HARD_NEGATIVES = """
WITH r AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
               AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id,
          CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
      FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score,
          s.score AS negative_score,
          row_number() OVER (PARTITION BY anchor_id, p.id ORDER BY s.score DESC, s.id) AS place
      FROM p JOIN s USING (anchor_id)
      WHERE NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE place <= 5
"""

SQL: dict[str, str] = {
    "op3_jaccard_join": _JACCARD,
    "op5_source_mix": _MIX,
    "op6_decontamination": _WINDOWS,
    "op8_chat_format": _CHAT,
    "op12_hard_negatives": _HARD_NEGATIVES,
}
