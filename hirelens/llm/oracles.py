"""Results of the operators in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

OP3 = r"""
WITH lowered AS (
    SELECT row_number() OVER () AS r, doc_id,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
d AS (SELECT r, doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered),
b AS (SELECT item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, w[i:i + 9] AS g FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s(i) WHERE len(w) > 0),
lens AS (SELECT DISTINCT len(g) AS n FROM win),
places AS (SELECT r, i, n, w[i:i + n - 1] AS g FROM d, lens, unnest(range(1, len(w) - n + 2)) AS s(i)),
met AS (SELECT p.r, p.i, p.n, win.item_id FROM places p JOIN win ON win.g = p.g),
hit AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, i + k AS pos FROM met, unnest(range(0, n)) AS s(k)) GROUP BY r),
items AS (SELECT r, count(DISTINCT item_id) AS n_items,
        list_aggregate(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), 'string_agg', ',') AS ids FROM met GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""

OP4 = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (SELECT r, i, array_to_string(w[i:i + 7], ' ') AS g FROM d, unnest(range(1, len(w) - 6)) AS s(i)),
again AS (SELECT r, i FROM grams QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
repeated AS (SELECT r, count(*) AS n FROM (SELECT DISTINCT r, i + k AS pos FROM again, unnest(range(0, 8)) AS s(k)) GROUP BY r),
lines AS (SELECT r, l FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
line_counts AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines FROM lines GROUP BY r),
c AS (
    SELECT r, doc_id, lang, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS BIGINT) AS n_capitals,
        CAST(length(t) - length(replace(t, '!', '')) AS BIGINT) AS n_shouts,
        CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
    FROM d LEFT JOIN repeated USING (r) LEFT JOIN line_counts USING (r)),
ratios AS (
    SELECT r, lang, 'symbols' AS rule, n_symbols AS a, n_words AS b FROM c
    UNION ALL SELECT r, lang, 'dup_lines', n_dup_lines, n_lines FROM c
    UNION ALL SELECT r, lang, 'repeats', n_repeat_words, n_words FROM c
    UNION ALL SELECT r, lang, 'capitals', n_capitals, word_chars FROM c
    UNION ALL SELECT r, lang, 'shouts', n_shouts, n_words FROM c),
path AS (SELECT rule, t, floor(middle * pow(2, (16 - t) / 4.0::DOUBLE)) AS cut
    FROM (VALUES ('symbols', 100), ('dup_lines', 300), ('repeats', 200), ('capitals', 250), ('shouts', 50)) AS v(rule, middle), unnest(range(0, 33)) AS s(t)),
steps AS (SELECT r, coalesce(lang, '') AS lang, rule, CASE WHEN b > 0 THEN least((a * 1000 + b - 1) // b, 20000) ELSE 0 END AS pos FROM ratios),
levels AS (SELECT r, lang, min(coalesce(t, 33)) AS level
    FROM (SELECT steps.r, steps.lang, steps.rule, min(t) AS t FROM steps LEFT JOIN path ON path.rule = steps.rule AND cut < pos GROUP BY ALL) GROUP BY ALL),
holdouts AS (SELECT levels.lang, level, quality FROM levels JOIN c USING (r) JOIN labels USING (doc_id) WHERE quality IS NOT NULL),
langs AS (SELECT lang, count(*) FILTER (quality = 1) AS n FROM holdouts GROUP BY lang),
strata AS (SELECT lang, CASE WHEN pow(0.95, n) > 0.05 / (SELECT count(*) FROM langs) THEN '(pool)' ELSE lang END AS stratum FROM langs),
hist AS (SELECT stratum, level, count(*) FILTER (quality = 1) AS good, count(*) FILTER (quality <> 1) AS bad FROM holdouts JOIN strata USING (lang) GROUP BY ALL),
tails AS (
    SELECT stratum, level, sum(good) OVER every AS n_good, sum(bad) OVER every AS n_bad, sum(good) OVER upto AS good_out, sum(bad) OVER upto AS bad_out
    FROM hist WINDOW every AS (PARTITION BY stratum), upto AS (PARTITION BY stratum ORDER BY level)),
totals AS (SELECT stratum, sum(good) AS n FROM hist GROUP BY stratum),
cdf AS (
    SELECT stratum, i, sum(exp(lgamma(n + 1) - CASE WHEN i > 0 THEN lgamma(i + 1) ELSE 0 END - lgamma(n - i + 1)
        + i * ln(0.05) + (n - i) * ln(0.95))) OVER (PARTITION BY stratum ORDER BY i) AS p
    FROM totals, unnest(range(0, CAST(floor(n * 0.05) AS BIGINT) + 1)) AS s(i)),
limits AS (SELECT stratum, max(i) AS k FROM cdf WHERE p <= 0.05 / (SELECT count(*) FROM langs) GROUP BY stratum),
gains AS (SELECT stratum, level, bad_out / greatest(n_bad, 1) - good_out / greatest(n_good, 1) AS gain
    FROM tails JOIN limits USING (stratum) WHERE good_out <= k AND level < 33),
cuts AS (SELECT stratum, arg_min(level, (-gain, level)) AS cut FROM gains WHERE gain > 0 GROUP BY stratum),
broken AS (SELECT r FROM levels JOIN strata USING (lang) JOIN cuts USING (stratum) WHERE level <= cut)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND broken.r IS NULL AS kept
FROM c LEFT JOIN broken USING (r)
"""

OP6 = r"""
WITH d AS (
    SELECT doc_id, source, coalesce(text, '') AS t, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
        (CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 12)) AS BIGINT) + 0.5::DOUBLE)
            / 281474976710656::DOUBLE AS u FROM documents),
m AS (SELECT *, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS symbols FROM d),
w AS (SELECT doc_id, source, size, -ln(u) / CASE WHEN 100 * symbols <= size THEN 1.0::DOUBLE WHEN 100 * symbols <= 5 * size THEN 0.75
        WHEN 100 * symbols <= 20 * size THEN 0.5 ELSE 0.25 END AS key FROM m),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM w GROUP BY source),
units AS (SELECT *, 3 * source_size AS top, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS unit FROM s),
shares AS (SELECT *, ((sum(source_size) OVER ())::BIGINT - coalesce(sum(top) OVER (ORDER BY top / unit, source NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)::DOUBLE
    / (sum(unit) OVER (ORDER BY top / unit, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS share FROM units),
goal AS (SELECT source, source_size, least(top::DOUBLE, coalesce(unit * (SELECT arg_min(share, (top / unit, share)) FROM shares WHERE share * unit < top), top::DOUBLE)) AS target FROM shares),
e AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3) ELSE 0 END AS epochs FROM goal),
r AS (SELECT w.*, source_size, target, epochs, target - epochs * source_size AS rest,
    sum(size) OVER (PARTITION BY w.source ORDER BY key, doc_id) - sum(size) OVER (PARTITION BY w.source, key, doc_id) / 2 AS middle
    FROM w JOIN e ON e.source IS NOT DISTINCT FROM w.source)
SELECT doc_id, size, source_size, target,
    CAST(size * (epochs + CASE WHEN rest > 0 AND middle <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM r
"""

OP11 = r"""
WITH e AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT q.r AS q, q.vec_id AS query_id, e.vec_id, list_dot_product(q.v, e.v)::BIGINT AS score
    FROM e AS q JOIN e ON q.r <> e.r WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s QUALIFY rank <= 5
"""

OP12 = r"""
WITH crc AS MATERIALIZED (
    SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
        lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)) AS t),
d AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
words AS MATERIALIZED (SELECT r, unnest(w) AS w FROM d),
hexed AS (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM words UNION SELECT w FROM b)),
bucket AS MATERIALIZED (
    SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(h), 2), lambda i: CAST('0x' || substr(h, i, 2) AS BIGINT))),
        lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295::BIGINT) % 10000 AS k FROM hexed, crc),
s AS (SELECT k, count(*) AS s FROM words JOIN bucket USING (w) GROUP BY k),
t AS (SELECT k, count(*) AS t FROM b JOIN bucket USING (w) GROUP BY k),
gain AS (
    SELECT k, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (coalesce((SELECT sum(s) FROM s), 0)::DOUBLE + 10000)
        / ((coalesce(s, 0) + 1)::DOUBLE * (coalesce((SELECT sum(t) FROM t), 0)::DOUBLE + 10000))))::BIGINT AS g
    FROM s FULL JOIN t USING (k)),
w AS (SELECT r, sum(g)::BIGINT AS weight FROM words JOIN bucket USING (w) JOIN gain USING (k) GROUP BY r),
h AS (
    SELECT r, doc_id, len(d.w) AS n, coalesce(weight, 0) AS weight,
        CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
    FROM d LEFT JOIN w USING (r)),
scored AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM h),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY n >= 20 ORDER BY score DESC, doc_id NULLS LAST, n, weight) AS place,
        10 * count(*) OVER (PARTITION BY n >= 20) // 100 AS drawn FROM scored)
SELECT doc_id, CAST(n AS BIGINT) AS n_features, weight, score, CASE WHEN n >= 20 AND place <= drawn THEN place END AS rank FROM ranked
"""

OP13 = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
f AS MATERIALIZED (
    SELECT lang, w[i:i + k - 1] AS p, k, count(*) AS a FROM w, unnest(range(1, 5)) AS s(k), unnest(range(1, len(w) - k + 2)) AS t(i) GROUP BY ALL),
totals AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
often AS MATERIALIZED (SELECT * FROM f WHERE a >= 30),
cuts AS (
    SELECT o.lang, o.p, o.k, o.a, c, x.a AS l, y.a AS r, ((2000000::HUGEINT * o.a) // (x.a + y.a))::BIGINT AS score
    FROM often o, unnest(range(1, o.k)) AS s(c) JOIN often x ON x.lang = o.lang AND x.p = o.p[1:c] JOIN often y ON y.lang = o.lang AND y.p = o.p[c + 1:]),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, c) = 1),
held AS (
    SELECT lang, o.p[i:i + m - 1] AS p, max(a) AS held FROM often o, unnest(range(2, o.k)) AS s(m), unnest(range(1, o.k - m + 2)) AS t(i) GROUP BY ALL),
ranked AS (
    SELECT b.*, array_to_string(b.p, ' ') AS phrase FROM best b LEFT JOIN held h ON h.lang = b.lang AND h.p = b.p
    WHERE held IS NULL OR 100 * held < 80 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM ranked JOIN totals USING (lang) QUALIFY rank <= 2000
"""

ORACLES = {"op3_decontamination": OP3, "op4_quality_rules": OP4, "op6_mixing": OP6, "op11_topk": OP11, "op12_importance": OP12, "op13_collocations": OP13}
