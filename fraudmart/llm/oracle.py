"""DuckDB SQL twins of the document queries that SQL can express.

They state results by definition (all windows, all pairs that share a word
sequence, one global order), not by the operators' methods. Learned models,
token ids and the look-behind patterns of the pseudonyms have no twin; tests
compare those with brute force.
"""

from __future__ import annotations

from fraudmart.llm.license_scan import NOTICES

W = r"'[^\x20\x09-\x0D]+'"

SQL: dict[str, str] = {}

SQL["op3_decontamination"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS ws FROM documents),
i AS (SELECT * FROM (SELECT DISTINCT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS ws
                     FROM benchmark) WHERE len(ws) >= 8),
j AS (SELECT row_number() OVER () AS q, item_id, ws, least(len(ws), 13) AS size,
             CASE WHEN len(ws) >= 13 THEN 2 ELSE 2 * len(ws) // 13 END AS allowed FROM i),
d4 AS (SELECT r, p, ws[p:p+3] AS k FROM (SELECT r, ws, unnest(range(1, len(ws) - 2)) AS p FROM d WHERE len(ws) > 3)),
j4 AS (SELECT q, p, ws[p:p+3] AS k FROM (SELECT q, ws, unnest(range(1, len(ws) - 2)) AS p FROM j)),
aligned AS (SELECT DISTINCT d4.r, j4.q, d4.p - j4.p AS diag FROM d4 JOIN j4 USING (k)),
cells AS (SELECT a.r, a.q, a.diag, k, d.doc_id, j.item_id, j.size, j.allowed,
                 CASE WHEN diag + k BETWEEN 1 AND len(d.ws) THEN (d.ws[diag + k] = j.ws[k])::INT END AS eq
          FROM (SELECT a.*, unnest(range(1, len(j.ws) + 1)) AS k FROM aligned a JOIN j USING (q)) a
          JOIN d USING (r) JOIN j USING (q)),
runs AS (SELECT *, sum(eq) OVER w AS same, count(eq) OVER w AS inside
         FROM cells WINDOW w AS (PARTITION BY r, q, diag ORDER BY k ROWS BETWEEN 12 PRECEDING AND CURRENT ROW)),
short AS (SELECT r, q, diag, sum(eq) AS same, count(eq) AS inside FROM cells WHERE size < 13 GROUP BY ALL),
good AS (SELECT DISTINCT r, q, diag FROM runs WHERE size = 13 AND inside = 13 AND 13 - same <= allowed
         UNION SELECT s.r, s.q, s.diag FROM short s JOIN j USING (q) WHERE s.inside = j.size AND j.size - s.same <= j.allowed),
full_match AS (SELECT c.doc_id, c.item_id, c.r, c.q, c.diag, sum(c.eq) AS n_equal
               FROM cells c JOIN good USING (r, q, diag) GROUP BY ALL)
SELECT doc_id, item_id, doc_start, item_start, n_equal FROM (
  SELECT doc_id, item_id, greatest(diag, 0)::INT AS doc_start, greatest(-diag, 0)::INT AS item_start, n_equal::INT AS n_equal,
         row_number() OVER (PARTITION BY doc_id, item_id
                            ORDER BY n_equal DESC, greatest(diag, 0), greatest(-diag, 0)) AS rn
  FROM full_match) WHERE rn = 1
"""

SQL["op4_near_duplicates"] = rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
                               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {W}) AS ws FROM documents),
s AS (SELECT DISTINCT r, g FROM (
        SELECT r, ws[p:p+2] AS g FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS p FROM d WHERE len(ws) >= 3)
        UNION ALL SELECT r, ws FROM d WHERE len(ws) BETWEEN 1 AND 2)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY 1),
both_in AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.r <> b.r GROUP BY 1, 2),
links AS (SELECT dx.doc_id AS x, dy.doc_id AS y FROM both_in JOIN n nx ON nx.r = x JOIN n ny ON ny.r = y
          JOIN d dx ON dx.r = x JOIN d dy ON dy.r = y
          WHERE 100 * c >= 85 * (nx.n + ny.n - c) AND dx.doc_id <> dy.doc_id),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
low AS (SELECT x, min(y) AS y FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(low.y, d.doc_id)) AS component_id,
       coalesce(low.y, d.doc_id) >= d.doc_id AS kept
FROM d LEFT JOIN n USING (r) LEFT JOIN low ON low.x = d.doc_id
"""

SQL["op5_line_cleaning"] = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, regexp_extract_all(t, {W}) AS ws FROM d),
win AS (SELECT r, p, ws[p:p+2] AS k FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS p FROM w WHERE len(ws) >= 3)),
rep AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, k) AS c FROM win) WHERE c > 1),
cov AS (SELECT r, count(DISTINCT p + o) AS n FROM rep, (VALUES (0), (1), (2)) v(o) GROUP BY r),
l AS (SELECT r, line, len(regexp_extract_all(line, {W})) AS n FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d)),
lines AS (SELECT r, count(*) - count(DISTINCT line) AS dups, coalesce(sum(n) FILTER (
    100 * len(regexp_extract_all(line, '[!?#*$%&|<>=_~^{{}}\[\]\\]')) > 100 * n
    OR (n >= 25 AND NOT regexp_matches(line, '[.!?:;,…。！？]'))
    OR len(regexp_extract_all(line, '[|»›•·→]')) >= 3
    OR (n <= 8 AND regexp_matches(lower(line), 'skip to content|back to top|next page|previous page|read more|click here|sign in|sign up|log in|main menu|site map|share this|home page|load more'))
    OR (n <= 12 AND regexp_matches(lower(line), 'lorem ipsum|enable javascript|cookie policy|privacy policy|terms of use|terms of service|accept cookies|all rights reserved'))
  ), 0) AS lost FROM l WHERE n > 0 GROUP BY r),
b AS (SELECT d.doc_id, len(w.ws) AS n_words, len(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, coalesce(lines.dups, 0) AS n_dup_lines,
             coalesce(cov.n, 0) AS n_repeat_words, coalesce(lost, 0)::BIGINT AS lost_words
      FROM d JOIN w USING (r) LEFT JOIN cov USING (r) LEFT JOIN lines USING (r))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * lost_words <= 50 * n_words AS kept
FROM b
"""

SQL["op7_source_mixing"] = rf"""
WITH s AS (SELECT doc_id, source, coalesce('=' || source, '') AS skey, len(regexp_extract_all(coalesce(text, ''), {W})) AS size
           FROM documents),
rows_ AS (SELECT *, row_number() OVER (PARTITION BY doc_id, skey, size) AS copy FROM s),
src AS (SELECT skey, source, sum(size)::BIGINT AS source_size,
               (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS weight FROM s GROUP BY skey, source),
total AS (SELECT sum(size)::BIGINT AS t FROM s),
fill AS (SELECT *, coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, skey
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS c,
                sum(weight) OVER (ORDER BY 3 * source_size / weight, skey
                     ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::HUGEINT AS w FROM src),
full_ AS (SELECT fill.*, 3 * source_size * w < weight * (t - c) AS is_full FROM fill, total),
open_ AS (SELECT (t - coalesce(sum(3 * source_size) FILTER (is_full), 0))::HUGEINT AS left_over,
                 coalesce(sum(weight) FILTER (NOT is_full), 0)::HUGEINT AS w FROM full_, total GROUP BY t),
aim AS (SELECT skey, source_size, CASE WHEN is_full THEN (3 * source_size)::DOUBLE
                                       ELSE (weight * left_over)::DOUBLE / greatest(open_.w, 1)::DOUBLE END AS target
        FROM full_, open_),
offers AS (SELECT r.*, pass, ('0x' || substr(md5(concat_ws(':', pass, doc_id, size, copy)), 1, 15))::BIGINT AS key
           FROM rows_ r, (VALUES (0), (1), (2)) v(pass)),
timed AS (SELECT o.*, (pass * source_size + sum(size) OVER (PARTITION BY o.skey, pass ORDER BY key, doc_id, size, copy
                        ROWS UNBOUNDED PRECEDING))::DOUBLE / target AS finish
          FROM offers o JOIN aim USING (skey) WHERE target > 0),
run AS (SELECT *, sum(size) OVER (ORDER BY finish, skey, pass, key, doc_id, size, copy ROWS UNBOUNDED PRECEDING) AS upto FROM timed),
taken AS (SELECT doc_id, skey, size, copy, count(*) AS times FROM run, total WHERE upto <= t GROUP BY 1, 2, 3, 4)
SELECT r.doc_id, r.size, aim.source_size, aim.target, r.size * coalesce(taken.times, 0) AS taken, r.source
FROM rows_ r JOIN aim USING (skey)
LEFT JOIN taken ON taken.doc_id IS NOT DISTINCT FROM r.doc_id AND taken.skey = r.skey AND taken.size = r.size AND taken.copy = r.copy
"""

_VALUES = ", ".join("('{}', '{}')".format(k, t.replace("'", "''")) for k, v in NOTICES.items() for t in v)

SQL["op8_license_scan"] = rf"""
WITH notices(license_id, t) AS (VALUES {_VALUES}),
units AS (SELECT doc_id, generate_subscripts(ls, 1) AS line, unnest(ls) AS t
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
          UNION ALL SELECT doc_id, 0, text FROM documents WHERE contains(text, chr(10))),
uw AS (SELECT doc_id, line, regexp_extract_all(lower(t), '[\p{{L}}\p{{N}}]+') AS ws FROM units),
nw AS (SELECT license_id, regexp_extract_all(lower(t), '[\p{{L}}\p{{N}}]+') AS ws FROM notices),
ug AS (SELECT doc_id, line, CASE WHEN len(ws) = 1 THEN [ws] ELSE list_distinct(list_transform(range(1, len(ws)), lambda p: ws[p:p+1])) END AS g
       FROM uw WHERE len(ws) > 0),
ng AS (SELECT license_id, CASE WHEN len(ws) = 1 THEN [ws] ELSE list_distinct(list_transform(range(1, len(ws)), lambda p: ws[p:p+1])) END AS g
       FROM nw),
pairs AS (SELECT doc_id, line, license_id, 2 * len(list_intersect(ug.g, ng.g)) / (len(ug.g) + len(ng.g)) AS dice
          FROM ug JOIN ng ON len(ug.g) <= 2 * len(ng.g) AND len(ng.g) <= 2 * len(ug.g))
SELECT doc_id, line::INT AS line, license_id, max(dice) AS dice FROM pairs WHERE 100 * dice >= 80 GROUP BY 1, 2, 3
"""

SQL["op13_phrase_collocations"] = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM d),
places AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w WHERE len(ws) > 0),
grams AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
          FROM places, (VALUES (1), (2), (3), (4)) v(k) WHERE i + k - 1 <= len(ws)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND f >= 30),
cut AS (SELECT c.lang, c.phrase, c.a, cut, l.f AS l, r.f AS r, ((2000000::HUGEINT * c.a) // (l.f + r.f))::BIGINT AS score
        FROM (SELECT *, unnest(range(1, k)) AS cut FROM cand) c
        JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1:c.cut], ' ')
        JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[c.cut + 1:], ' ')),
weak AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (SELECT DISTINCT s.lang, s.phrase FROM cand s JOIN cand g ON g.lang = s.lang AND g.k > s.k
           AND contains(' ' || g.phrase || ' ', ' ' || s.phrase || ' ') AND 100::HUGEINT * g.a >= 80::HUGEINT * s.a),
kept AS (SELECT * FROM weak ANTI JOIN inside USING (lang, phrase))
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) JOIN n USING (lang)
WHERE rank <= 2000
"""
