"""DuckDB SQL of the queries that SQL can express. Thresholds are written out
here and not imported, so that the check is independent of the code."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op10_quality_rules"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
lines AS (
  SELECT r, unnest(string_split(t, chr(10))) AS l FROM d),
line_counts AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines
  FROM lines WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
grams AS (
  SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
  FROM (SELECT r, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM w)),
twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM grams)
  WHERE c > 1),
covered AS (
  SELECT r, count(DISTINCT p) AS n
  FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r),
m AS (
  SELECT w.r, doc_id, t, len(ws) AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(covered.n, 0) AS n_repeat_words,
         length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper,
         length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS n_latin,
         length(regexp_replace(t, '[\x00-\x40\x5B-\x60\x7B-\x7F]', '', 'g')) AS n_letters
  FROM w LEFT JOIN line_counts USING (r) LEFT JOIN covered ON covered.r = w.r),
f AS (
  SELECT *,
      CASE WHEN n_words < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words AND n_words > 0 THEN 4 ELSE 0 END
    + CASE WHEN n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words)
           THEN 8 ELSE 0 END
    + CASE WHEN n_lines > 3 AND 100 * n_dup_lines > 70 * n_lines THEN 16 ELSE 0 END
    + CASE WHEN 2 * n_latin > word_chars AND 100 * n_upper > 80 * n_latin THEN 32 ELSE 0 END
    + CASE WHEN n_words > 0 AND 100 * n_letters < 30 * word_chars THEN 64 ELSE 0 END AS failed
  FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
       n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       failed = 0 AS kept, failed::BIGINT AS failed, 2 AS policy
FROM f
"""

ORACLES["op4_source_mixing"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce('=' || source, '') AS k, coalesce(doc_id::VARCHAR, '') AS id,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS n
  FROM documents),
s AS (SELECT k, sum(n)::BIGINT AS t FROM d GROUP BY k),
p AS (SELECT k, t, ln(t / (SELECT sum(t)::DOUBLE FROM s)) AS lp FROM s WHERE t > 0),
bisect(step, lo, hi) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT step + 1, CASE WHEN r > 2.0 THEN (lo + hi) / 2 ELSE lo END,
         CASE WHEN r > 2.0 THEN hi ELSE (lo + hi) / 2 END
  FROM (SELECT step, lo, hi, (SELECT max(exp(((lo + hi) / 2 - 1.0) * lp))
                                   / min(exp(((lo + hi) / 2 - 1.0) * lp)) FROM p) AS r
        FROM bisect WHERE step < 50)),
a AS (
  SELECT CASE WHEN (SELECT max(exp(-lp)) / min(exp(-lp)) FROM p) > 2.0
              THEN (SELECT hi FROM bisect WHERE step = 50) ELSE 0.0 END AS a),
w AS (
  SELECT k, t, e / sum(e) OVER () AS weight
  FROM (SELECT s.k, s.t, coalesce(exp((SELECT a FROM a) * lp), 0.0) AS e
        FROM s LEFT JOIN p ON p.k = s.k)),
q AS (
  SELECT k, t, weight,
         coalesce(round(weight * (SELECT max(t / weight) FROM w WHERE weight > 0)), 0)::BIGINT
           AS quota,
         greatest(1, ceil(t / 65536.0))::BIGINT AS blocks
  FROM w),
dealt AS (
  SELECT d.*, q.t, q.quota, q.weight,
         ('0x' || substr(md5(id || '|mix-1'), 1, 12))::BIGINT % blocks AS block
  FROM d JOIN q USING (k)),
passes AS (
  SELECT k, block, t, quota, b, unnest(generate_series(0,
         CASE WHEN t > 0 THEN ceil(quota / t)::BIGINT - 1 ELSE 0 END)) AS pass
  FROM (SELECT k, block, any_value(t) AS t, any_value(quota) AS quota, sum(n)::BIGINT AS b
        FROM dealt GROUP BY k, block)
  WHERE quota > 0 OR t = 0),
ordered AS (
  SELECT *, quota - pass * t AS rest,
         coalesce(sum(b) OVER (PARTITION BY k, pass
           ORDER BY md5(k || '|' || pass || '|' || block || '|mix-1'), block
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM passes),
taken AS (
  SELECT *, CASE WHEN t > 0 THEN (pass * t + before) / quota ELSE 0.0 END AS slot
  FROM ordered WHERE before < rest OR t = 0 OR (b = 0 AND pass = 0)),
r AS (
  SELECT doc_id, source, dealt.weight, dealt.block, pass, slot, n, dealt.k, b, before, rest,
         md5(id || '|' || pass || '|mix-1') AS key
  FROM dealt JOIN taken ON taken.k = dealt.k AND taken.block = dealt.block),
seen AS (
  SELECT *, coalesce(sum(n) OVER (PARTITION BY k, pass, block ORDER BY key
           RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP), 0) AS ahead
  FROM r)
SELECT doc_id, source, round(weight, 9) AS weight, pass::INTEGER AS pass, block,
       round(slot, 9) AS slot, key AS order_key
FROM seen WHERE before + b <= rest OR ahead < rest - before OR (b = 0 AND pass = 0)
"""

ORACLES["op11_collocations"] = r"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS p, piece FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)),
listed AS (SELECT lang, p, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
one AS (SELECT lang, unnest(ws) AS phrase FROM listed),
two AS (
  SELECT lang, ws[i] AS w1, ws[i + 1] AS w2
  FROM (SELECT lang, ws, unnest(generate_series(1, len(ws) - 1)) AS i FROM listed)),
three AS (
  SELECT lang, ws[i] AS w1, ws[i + 1] AS w2, ws[i + 2] AS w3
  FROM (SELECT lang, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM listed)),
f1 AS (SELECT lang, phrase AS w, count(*) AS f FROM one GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, count(*) AS f FROM two GROUP BY ALL),
f3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM three GROUP BY ALL HAVING count(*) >= 10),
total AS (SELECT lang, count(*) AS n FROM one GROUP BY lang),
inside AS (
  SELECT lang, a, b, max(f) AS f FROM (
    SELECT lang, w1 AS a, w2 AS b, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3)
  GROUP BY lang, a, b),
c2 AS (
  SELECT f2.lang, f2.w1 || ' ' || f2.w2 AS phrase, f2.f AS a, x.f AS l, y.f AS r,
         1000000::HUGEINT * f2.f * f2.f // (x.f::HUGEINT * y.f) AS score
  FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.w = f2.w1
          JOIN f1 y ON y.lang = f2.lang AND y.w = f2.w2
          LEFT JOIN inside i ON i.lang = f2.lang AND i.a = f2.w1 AND i.b = f2.w2
  WHERE f2.f >= 10 AND 100 * coalesce(i.f, 0) < 50 * f2.f),
c3 AS (
  SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3 AS phrase, f3.f AS a,
         x1.f AS l1, y1.f AS r1, x2.f AS l2, y2.f AS r2,
         1000000::HUGEINT * f3.f * f3.f // (x1.f::HUGEINT * y1.f) AS s1,
         1000000::HUGEINT * f3.f * f3.f // (x2.f::HUGEINT * y2.f) AS s2
  FROM f3 JOIN f1 x1 ON x1.lang = f3.lang AND x1.w = f3.w1
          JOIN f2 y1 ON y1.lang = f3.lang AND y1.w1 = f3.w2 AND y1.w2 = f3.w3
          JOIN f2 x2 ON x2.lang = f3.lang AND x2.w1 = f3.w1 AND x2.w2 = f3.w2
          JOIN f1 y2 ON y2.lang = f3.lang AND y2.w = f3.w3),
c AS (
  SELECT lang, phrase, a, l, r, score FROM c2
  UNION ALL
  SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END,
         CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2) FROM c3),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM c)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000"""
