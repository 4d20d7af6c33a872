"""DuckDB twins of the registered queries, where SQL can express them."""

from __future__ import annotations

#: Words of a text, as a list.
_WORDS = "regexp_extract_all(coalesce({}, ''), '[^\\x20\\x09-\\x0D]+')"

#: op12 by plain counting: every phrase of one to five words in a table, cuts by joins.
OP12 = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
         string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[.,;:!?\x0A-\x0D]') AS pieces
  FROM documents),
p AS (SELECT row_number() OVER () AS pid, lang, regexp_extract_all(piece, '[^ \x09]+') AS ws FROM (SELECT lang, unnest(pieces) AS piece FROM d)),
t AS (SELECT pid, lang, unnest(ws) AS w, unnest(range(len(ws))) AS pos FROM p),
o AS (
  SELECT lang, w AS a, lead(w, 1) OVER s AS b, lead(w, 2) OVER s AS c, lead(w, 3) OVER s AS d, lead(w, 4) OVER s AS e
  FROM t WINDOW s AS (PARTITION BY pid ORDER BY pos)),
f AS (
  SELECT lang, k, g, count(*) AS f FROM (
    SELECT lang, 1 AS k, a AS g FROM o
    UNION ALL SELECT lang, 2, a || ' ' || b FROM o WHERE b IS NOT NULL
    UNION ALL SELECT lang, 3, a || ' ' || b || ' ' || c FROM o WHERE c IS NOT NULL
    UNION ALL SELECT lang, 4, a || ' ' || b || ' ' || c || ' ' || d FROM o WHERE d IS NOT NULL
    UNION ALL SELECT lang, 5, a || ' ' || b || ' ' || c || ' ' || d || ' ' || e FROM o WHERE e IS NOT NULL) GROUP BY ALL),
n AS (SELECT lang, sum(f)::HUGEINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, g, f AS a, string_split(g, ' ') AS ws FROM f WHERE k >= 2 AND f >= 100),
halves AS (
  SELECT lang, g, a, j, array_to_string(ws[1:j], ' ') AS first_part, array_to_string(ws[j + 1:k], ' ') AS rest
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c)),
best AS (
  SELECT h.lang, h.g, h.a, x.f AS l, y.f AS r, n.n, (1000::HUGEINT * h.a * n.n) // (x.f::HUGEINT * y.f::HUGEINT) AS score
  FROM halves h JOIN f x ON x.lang = h.lang AND x.g = h.first_part JOIN f y ON y.lang = h.lang AND y.g = h.rest JOIN n ON n.lang = h.lang
  QUALIFY row_number() OVER (PARTITION BY h.lang, h.g ORDER BY score, j) = 1),
inside AS (
  SELECT lang, g, max(a) AS longest FROM (
    SELECT lang, a, array_to_string(ws[s:s + m - 1], ' ') AS g
    FROM (SELECT *, unnest(range(1, k - m + 2)) AS s FROM (SELECT *, unnest(range(2, k)) AS m FROM c))) GROUP BY ALL),
kept AS (
  SELECT b.lang, b.g AS phrase, a, l, r, n, score FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.g = b.g
  WHERE i.longest IS NULL OR 100 * i.longest < 100 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
       phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM kept QUALIFY rank <= 2000"""

OP8 = f"""
WITH d AS (
  SELECT doc_id, source, len({_WORDS.format('text')}) AS size FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3, 1, 2][((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1)::INT] AS weight
  FROM d GROUP BY source),
-- sources in the order in which a rising water level fills them
o AS (
  SELECT *, coalesce(sum(source_size) OVER w, 0)::DOUBLE * 2.0 AS before_cap,
         sum(weight) OVER (ORDER BY source_size::DOUBLE / weight, source IS NULL, source
                           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS w_rest,
         (sum(source_size) OVER ())::DOUBLE * 1.5 AS total
  FROM s WINDOW w AS (ORDER BY source_size::DOUBLE / weight, source IS NULL, source
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (
  SELECT min_by((total - before_cap, w_rest), source_size::DOUBLE / weight)
         FILTER (WHERE (total - before_cap) * weight / w_rest <= source_size * 2.0::DOUBLE) AS level FROM o),
t AS (
  SELECT o.*, CASE WHEN level IS NULL OR level[1] * weight / level[2] > source_size * 2.0::DOUBLE
                   THEN source_size * 2.0::DOUBLE ELSE level[1] * weight / level[2] END AS target
  FROM o, l),
x AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
h AS (SELECT *, md5('mix-1:' || coalesce(doc_id::VARCHAR, '-')) AS h FROM d),
c AS (
  SELECT h.doc_id, h.size, x.source_size, x.target, x.whole,
         floor(x.target)::BIGINT - x.whole * x.source_size AS extra,
         count(*) OVER (PARTITION BY h.source, h, h.doc_id, h.size) AS m,
         (sum(h.size) OVER (PARTITION BY h.source ORDER BY h, h.doc_id, h.size
                            RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS upto
  FROM h JOIN x ON h.source IS NOT DISTINCT FROM x.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (whole * size + CASE WHEN upto <= extra THEN size WHEN upto - m * size >= extra THEN 0
                            ELSE (extra - (upto - m * size)) // m END)::BIGINT AS taken
FROM c"""

_FEATURES = (("f_symbols", 50, False), ("f_upper", 50, False), ("f_word_len", 100, True), ("f_dup_lines", 200, False),
             ("f_repeats", 150, False))
_FENCED = " AND ".join(
    f"coalesce({c} <= coalesce(own.hi_{c}, la.hi_{c}, ev.hi_{c}), true)"
    + (f" AND coalesce({c} >= coalesce(own.lo_{c}, la.lo_{c}, ev.lo_{c}), true)" if low else "")
    for c, _, low in _FEATURES)
_PIVOT = ", ".join(f"max(CASE WHEN feature = '{c}' THEN {x} END) AS {x}_{c}" for c, _, _ in _FEATURES for x in ("lo", "hi"))
_FLOOR = "CASE feature " + " ".join(f"WHEN '{c}' THEN {r}" for c, r, _ in _FEATURES) + " END"
_STACK = " UNION ALL ".join(f"SELECT lang, source, '{c}' AS feature, {c} AS x FROM f WHERE NOT base_failed" for c, _, _ in _FEATURES)

OP1 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t,
         {_WORDS.format('text')} AS w FROM documents),
g AS (
  SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM g) WHERE n > 1),
r AS (SELECT rid, count(DISTINCT i + k) AS n FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY rid),
b AS (
  SELECT d.*, len(w)::BIGINT AS n_words,
         (length(t) - len(regexp_extract_all(t, '[ 	-
]')))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) AS l,
         coalesce(r.n, 0)::BIGINT AS n_repeat_words,
         len(regexp_extract_all(t, '\p{{Lu}}')) AS upper_chars
  FROM d LEFT JOIN r USING (rid)),
c AS (
  SELECT *, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b),
f AS (
  SELECT *, coalesce(1000 * n_symbols // nullif(n_words, 0), 0) AS f_symbols,
         coalesce(1000 * upper_chars // nullif(word_chars, 0), 0) AS f_upper,
         coalesce(100 * word_chars // nullif(n_words, 0), 0) AS f_word_len,
         coalesce(1000 * n_dup_lines // nullif(len(l), 0), 0) AS f_dup_lines,
         coalesce(1000 * n_repeat_words // nullif(n_words, 0), 0) AS f_repeats FROM c),
x AS (SELECT *, greatest(0, length(bin(x)) - 6) AS e FROM ({_STACK})),
k AS (SELECT lang, source, feature, e * 32 + (x >> e) AS bucket, count(*) AS n FROM x GROUP BY ALL),
s AS (
  SELECT 2 AS level, lang, source, feature, bucket, n FROM k
  UNION ALL SELECT 1, lang, NULL, feature, bucket, sum(n) FROM k GROUP BY lang, feature, bucket
  UNION ALL SELECT 0, NULL, NULL, feature, bucket, sum(n) FROM k GROUP BY feature, bucket),
u AS (
  SELECT *, sum(n) OVER (PARTITION BY level, lang, source, feature ORDER BY bucket) AS up,
         sum(n) OVER (PARTITION BY level, lang, source, feature) AS total,
         (bucket - 32 * greatest(0, bucket // 32 - 1)) << greatest(0, bucket // 32 - 1) AS low FROM s),
q AS (
  SELECT level, lang, source, feature, max(total) AS docs,
         min(low) FILTER (WHERE up * 100 >= total * 25) AS q25, min(low) FILTER (WHERE up * 100 >= total * 75) AS q75
  FROM u GROUP BY ALL),
z AS (SELECT *, q25 - 3 * greatest(q75 - q25, {_FLOOR}) AS lo, q75 + 3 * greatest(q75 - q25, {_FLOOR}) AS hi FROM q),
p AS (SELECT level, lang, source, max(docs) AS docs, {_PIVOT} FROM z GROUP BY level, lang, source)
SELECT f.doc_id, n_words, f.word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {_FENCED} AS kept
FROM f
LEFT JOIN p own ON own.level = 2 AND own.docs >= 50 AND own.lang IS NOT DISTINCT FROM f.lang AND own.source IS NOT DISTINCT FROM f.source
LEFT JOIN p la ON la.level = 1 AND la.docs >= 50 AND la.lang IS NOT DISTINCT FROM f.lang
LEFT JOIN p ev ON ev.level = 0"""

ORACLE = {"op12_stream_collocations": OP12, "op1_quality_sketch": OP1, "op8_water_filling": OP8}
