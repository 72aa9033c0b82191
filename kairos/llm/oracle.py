"""DuckDB SQL of the operators that SQL can express (checked on the given tables)."""

from __future__ import annotations

import re

from kairos.llm.chat_tree import CONTROLS

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP1 = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 2), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3]) END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY 1),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id, doc_id AS r FROM documents
  UNION SELECT reach.doc_id, both_ways.b FROM reach JOIN both_ways ON reach.r = both_ways.a)
SELECT d.doc_id, coalesce(max(n), 0)::BIGINT AS n_shingles, min(r) AS component_id
FROM documents d JOIN reach USING (doc_id) LEFT JOIN sizes USING (doc_id) GROUP BY 1
"""

_ESCAPED = "|".join([r"\\", *map(re.escape, CONTROLS)]).replace("'", "''")


def _escaped_chars(x: str) -> str:
    return f"length({x}) + len(regexp_extract_all({x}, '{_ESCAPED}'))"


OP7 = rf"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
convs AS (
  SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS learnt,
    sum(12 + {_escaped_chars('role')} + len(regexp_extract_all(role, chr(10))) + 1 + {_escaped_chars('text')} + 11) AS chars
  FROM rows GROUP BY 1)
SELECT conv_id, n_turns, turns_sha256, length(learnt) AS loss_chars, sha256(learnt) AS loss_sha256, chars::BIGINT AS formatted_chars FROM convs
"""

OP9 = r"""
WITH cut AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
lines AS (SELECT doc_id, unnest(range(0, len(ls))) AS i, unnest(ls) AS line FROM cut),
sets AS (
  SELECT * FROM (SELECT doc_id, i, list_distinct(list_filter(
    string_split(replace(replace(line, chr(9), ' '), chr(13), ' '), ' '), lambda x: x <> '')) AS w FROM lines) WHERE len(w) > 0),
toks AS (SELECT doc_id, i, len(w) AS n, unnest(w) AS t FROM sets),
df AS (SELECT t, count(*) AS c FROM toks GROUP BY 1),
prefix AS (
  SELECT doc_id, i, n, t FROM toks JOIN df USING (t)
  QUALIFY row_number() OVER (PARTITION BY doc_id, i ORDER BY c, t) <= n - (4 * n + 4) // 5 + 1),
met AS (
  SELECT DISTINCT a.doc_id, a.i, b.doc_id AS e, b.i AS ei FROM prefix a JOIN prefix b ON a.t = b.t
  WHERE (b.doc_id < a.doc_id OR b.doc_id = a.doc_id AND b.i < a.i) AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n),
gone AS (
  SELECT DISTINCT m.doc_id, m.i FROM met m JOIN sets x ON x.doc_id = m.doc_id AND x.i = m.i JOIN sets y ON y.doc_id = e AND y.i = ei
  WHERE 9 * len(list_intersect(x.w, y.w)) >= 4 * (len(x.w) + len(y.w))),
kept AS (
  SELECT l.doc_id, count(*) AS n_lines, count(g.i) AS n_removed, coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (g.i IS NULL), '') AS text
  FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i GROUP BY 1)
SELECT d.doc_id, coalesce(k.n_lines, 0)::BIGINT AS n_lines, coalesce(k.n_removed, 0)::BIGINT AS n_removed, k.text
FROM documents d LEFT JOIN kept k USING (doc_id)
"""

OP11 = r"""
WITH pieces AS (
  SELECT lang, piece FROM (
    SELECT coalesce(lang, 'und') AS lang,
      unnest(regexp_split_to_array(translate(coalesce(text, ''), '@U', '@L'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
ws AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
counted AS (
  SELECT lang, n, phrase, count(*) AS f FROM (
    SELECT lang, 1 AS n, unnest(w) AS phrase FROM ws
    UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM ws
    UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM ws)
  GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE n = 1 GROUP BY 1),
cand AS (SELECT lang, n AS len, phrase, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE n > 1 AND f >= 10),
inside AS (
  SELECT lang, part, max(a) AS longer FROM (
    SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS part FROM cand WHERE len = 3) GROUP BY 1, 2),
cuts AS (
  SELECT lang, len, phrase, a, w, unnest(range(1, len)) AS k FROM cand),
sides AS (
  SELECT c.lang, c.len, c.phrase, c.a, c.k, x.f AS l, y.f AS r, ((1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c
  JOIN counted x ON x.lang = c.lang AND x.n = c.k AND x.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN counted y ON y.lang = c.lang AND y.n = c.len - c.k AND y.phrase = array_to_string(c.w[c.k + 1:c.len], ' ')),
lowest AS (SELECT * FROM sides QUALIFY row_number() OVER (PARTITION BY lang, phrase, len ORDER BY score, k) = 1)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank, s.phrase, a, l, r, t.n, score
FROM lowest s JOIN totals t ON t.lang = s.lang LEFT JOIN inside i ON s.len = 2 AND i.lang = s.lang AND i.part = s.phrase
WHERE i.longer IS NULL OR 100 * i.longer < 50 * a
QUALIFY rank <= 2000
""".replace("@U", _UPPER).replace("@L", _LOWER)

OP12 = r"""
WITH RECURSIVE sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM sizes GROUP BY 1),
weighed AS (SELECT *, [5, 2, 1][place % 3 + 1]::BIGINT AS weight FROM src),
-- ascending caps per weight: a source is full if its cap is at most its share of what the sources before it leave
filled AS (
  SELECT *, (SELECT sum(source_size) FROM weighed)::DOUBLE AS total,
    coalesce(sum(3 * source_size) OVER before, 0) AS used, (SELECT sum(weight) FROM weighed) - coalesce(sum(weight) OVER before, 0) AS w_left
  FROM weighed WINDOW before AS (ORDER BY source_size::DOUBLE / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
flagged AS (SELECT *, 3 * source_size * w_left <= weight * (total - used) AS is_full FROM filled),
open AS (SELECT sum(weight)::DOUBLE AS w FROM flagged WHERE NOT is_full),
capped AS (SELECT coalesce(sum(3 * source_size), 0)::DOUBLE AS c FROM flagged WHERE is_full),
targets AS (
  SELECT source, source_size, place, CASE WHEN is_full THEN (3 * source_size)::DOUBLE
    ELSE weight::DOUBLE * (total - (SELECT c FROM capped)) / (SELECT w FROM open) END AS target FROM flagged),
docs AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.place, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS e,
    CASE WHEN d.size < 16 THEN d.size ELSE length(bin(d.size)) * 8 + ((d.size >> (length(bin(d.size)) - 4)) & 7) END AS class,
    (('0x' || md5(coalesce(d.doc_id::VARCHAR, '') || ':' || d.size || ':0')[1:13])::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM sizes d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
parts AS (SELECT *, floor(e)::BIGINT AS sure, floor((e - floor(e)) * 1073741824)::BIGINT AS part FROM docs),
classes AS (
  SELECT place, class, count(*) AS n, sum(part)::DOUBLE / 1073741824 AS wanted, sum(part::HUGEINT * size)::DOUBLE / 1073741824 AS words,
    row_number() OVER (PARTITION BY place ORDER BY class DESC) AS i
  FROM parts WHERE part > 0 AND size > 0 GROUP BY 1, 2),
taken AS (
  SELECT place, 0::BIGINT AS i, 0::BIGINT AS class, 0::BIGINT AS take, 0::DOUBLE AS carry FROM targets
  UNION ALL
  SELECT place, i, class, take, carry + words - take * (words / wanted) FROM (
    SELECT c.place, c.i, c.class, c.words, c.wanted, t.carry,
      least(c.n, greatest(0, floor((c.words + t.carry) / (c.words / c.wanted) + 0.5)::BIGINT)) AS take
    FROM taken t JOIN classes c ON c.place = t.place AND c.i = t.i + 1)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY place, class
    ORDER BY (u / (1 - u)) / ((part / 1073741824::DOUBLE) / (1 - part / 1073741824::DOUBLE)), doc_id, size) AS rn
  FROM parts WHERE part > 0 AND size > 0)
SELECT doc_id, size, source_size, target, size * (sure + CASE WHEN rn <= take THEN 1 ELSE 0 END)::BIGINT AS taken
FROM ranked JOIN taken USING (place, class) WHERE i > 0
UNION ALL SELECT doc_id, size, source_size, target, size * sure FROM parts WHERE NOT (part > 0 AND size > 0)
"""

OP13 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '@U', '@L'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
occ AS (SELECT d, lang, source, unnest(ts) AS term FROM docs),
kept AS (SELECT lang, term FROM occ GROUP BY 1, 2 HAVING count(DISTINCT d) >= 3),
vs AS (SELECT lang, count(*) AS v FROM kept GROUP BY 1),
counts AS (SELECT lang, source, term, count(*) AS c FROM occ JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
grps AS (
  SELECT g.lang, g.source, coalesce(v, 0) AS v, coalesce(n, 0) AS n FROM (SELECT DISTINCT lang, source FROM docs) g
  LEFT JOIN vs USING (lang) LEFT JOIN (SELECT lang, source, sum(c) AS n FROM counts GROUP BY 1, 2) USING (lang, source)),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c, 0) AS c, 1 + (1000000000::HUGEINT * (coalesce(c, 0) + 1)) // (g.n + g.v)::HUGEINT AS p
  FROM grps g JOIN kept k ON k.lang = g.lang LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
q AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(c) + 1)::HUGEINT) // (sum(sum(c)) OVER (PARTITION BY lang) + count(*) OVER (PARTITION BY lang))::HUGEINT AS q
  FROM counts GROUP BY 1, 2),
pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM grps a JOIN grps b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS other, sum(((x.p - y.p) * (x.p - y.p)) // y.p) AS value
             FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY 1, 2, 3) s
    ON s.lang = a.lang AND s.source = a.source AND s.other = b.source),
term AS (
  SELECT p.lang, source, p.term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM pair
UNION ALL
SELECT lang, source, 'term', item, value, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM term) WHERE rank <= 200
""".replace("@U", _UPPER).replace("@L", _LOWER)

ORACLE_SQL: dict[str, str] = {"op1_ngram_jaccard_join": OP1, "op7_chat_format": OP7, "op9_line_dedup": OP9, "op11_collocations": OP11,
                              "op12_source_mix": OP12, "op13_source_divergence": OP13}
