"""SQL twins of the operators that SQL can express, for DuckDB over the whole tables."""

from __future__ import annotations

import string

from packetloom.llm import embeddings, licenses, line_dedup
from packetloom.llm.decontamination import WINDOW


def _words(text: str) -> str:
    lower = f"translate(coalesce({text}, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    return f"regexp_extract_all({lower}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"


CONTAMINATION = f"""
WITH item AS (SELECT item_id, {_words('text')} AS w FROM benchmark),
cut AS (SELECT item_id, w, least(len(w), {WINDOW}) AS n, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS i FROM item WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS words FROM cut),
doc AS (SELECT doc_id, {_words('text')} AS w FROM documents),
place AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM win) WHERE len(w) >= n),
found AS (SELECT doc_id, i, n, item_id FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS words FROM place) JOIN win USING (n, words)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY 1),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)"""

_CONTROL = "\\### Assistant: </turn> ok"
_ESCAPED = "replace(replace(replace(text, '\\', '\\\\'), '###', '\\h'), '</turn>', '\\t')"
CHAT = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '{_CONTROL}'), (-7, 1, 'assistant', '{_CONTROL}'))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('### ' || role || ': ' || {_ESCAPED} || '</turn>' || chr(10))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id"""

VECTORS = f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
near AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id
         AND list_cosine_similarity(a.e, b.e) >= {embeddings.COSINE}),
reach(vec_id, low) AS (SELECT vec_id, vec_id FROM v UNION SELECT near.y, reach.low FROM reach JOIN near ON near.x = reach.vec_id)
SELECT v.vec_id, (SELECT count(*) FROM near WHERE x = v.vec_id) AS n_links, min(low) AS component_id, v.vec_id = min(low) AS kept
FROM v JOIN reach USING (vec_id) GROUP BY v.vec_id"""

_ROWS = [(t, label, True) for t, label in licenses.PHRASES.items()] + [(t, label, False) for label, ts in licenses.TEXTS.items() for t in ts]
_VALUES = ", ".join("({}, '{}', '{}', {})".format(i, t.replace("'", "''"), label, phrase) for i, (t, label, phrase) in enumerate(_ROWS))
LICENSES = f"""
WITH template(t, text, label, phrase) AS (VALUES {_VALUES}),
listed AS (SELECT t, label, phrase, {_words('text')} AS w FROM template),
pair AS (SELECT t, label, phrase, len(w) AS n, j - 1 AS j, w[j] AS a, w[j + 1] AS b FROM (SELECT *, unnest(range(1, len(w))) AS j FROM listed)),
doc AS (SELECT doc_id, {_words('text')} AS w FROM documents),
vote AS (SELECT doc_id, t, label, phrase, n, i - 1 - j AS diagonal, j
         FROM (SELECT doc_id, i, w[i] AS a, w[i + 1] AS b FROM (SELECT *, unnest(range(1, len(w))) AS i FROM doc)) JOIN pair USING (a, b)),
line AS (SELECT doc_id, t, label, phrase, n, diagonal, list(DISTINCT j) AS js FROM vote GROUP BY ALL),
whole AS (SELECT doc_id, label, phrase, diagonal AS first, 1.0 AS share FROM line WHERE phrase AND len(js) = n - 1),
step AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY doc_id, t ORDER BY diagonal) > {licenses.NEAR} THEN 1 ELSE 0 END AS fresh
         FROM line WHERE NOT phrase),
grouped AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, t ORDER BY diagonal) AS g FROM step),
merged AS (SELECT doc_id, t, label, n, g, len(list_distinct(flatten(list(js)))) AS votes,
                  max(diagonal + list_max(js) + 2) - min(diagonal + list_min(js)) AS span
           FROM grouped GROUP BY doc_id, t, label, n, g),
-- groups that cover their template but spread too far: their best stretch, from any vote on
wide AS (SELECT doc_id, t, label, n, g FROM merged WHERE span > {licenses.STRETCH} * n AND votes >= {licenses.COVERED} * (n - 1)),
spot AS (SELECT wide.*, diagonal + j AS pos, j FROM (SELECT doc_id, t, g, diagonal, unnest(js) AS j FROM grouped) JOIN wide USING (doc_id, t, g)),
stretch AS (
    SELECT x.doc_id, x.t, x.label, x.n, x.g, x.pos, count(DISTINCT y.j) AS votes, max(y.pos - x.pos) + 2 AS span
    FROM spot x JOIN spot y ON x.doc_id = y.doc_id AND x.t = y.t AND x.g = y.g
         AND y.pos BETWEEN x.pos AND x.pos + CAST(floor({licenses.STRETCH} * x.n) AS INT) - {licenses.GRAM}
    GROUP BY ALL),
best AS (SELECT * FROM stretch QUALIFY row_number() OVER (PARTITION BY doc_id, t, g ORDER BY votes DESC, pos DESC, span DESC) = 1),
tight AS (SELECT doc_id, label, n, votes, span FROM merged ANTI JOIN wide USING (doc_id, t, g)
          UNION ALL SELECT doc_id, label, n, votes, span FROM best),
found AS (SELECT * FROM whole UNION ALL
          SELECT doc_id, label, FALSE, NULL, votes / (n - 1) FROM tight
          WHERE votes / (n - 1) >= {licenses.COVERED} AND span <= {licenses.STRETCH} * n),
marks AS (SELECT doc_id, count(first) AS n_base, min(first) AS first_word, max(first) AS last_word,
                 array_to_string(list_sort(list(DISTINCT label) FILTER (phrase)), ',') AS base_labels,
                 array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(share) AS score
          FROM found GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
       coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM doc LEFT JOIN marks USING (doc_id)"""

_BLANK = " || ".join(f"chr({c})" for c in (32, 9, 10, 11, 12, 13))
LINES = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (SELECT r, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM doc),
keyed AS (SELECT *, translate(trim(line, {_BLANK}), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS key FROM line),
often AS (SELECT key FROM keyed WHERE length(key) >= {line_dedup.MIN_CHARS} GROUP BY key HAVING count(DISTINCT r) >= {line_dedup.MIN_DOCS}),
kept AS (SELECT r, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS text FROM keyed ANTI JOIN often USING (key) GROUP BY r)
SELECT doc_id, CAST(len(lines) AS BIGINT) AS n_lines, len(lines) - coalesce(n, 0) AS n_dropped, sha256(coalesce(text, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (r)"""

ORACLE = {
    "op3_license_scan": LICENSES, "op4_embedding_dedup": VECTORS, "op5_chat_format": CHAT, "op6_contamination": CONTAMINATION,
    "op11_line_dedup": LINES,
}
