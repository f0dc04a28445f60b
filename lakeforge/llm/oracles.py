"""DuckDB SQL for the registered queries that SQL can express in full."""

WORD = r"[^\x20\x09-\x0D]+"

OP1 = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t)
"""


def op3(rules, words, share, tracking) -> str:
    def fits(text: str) -> str:
        host, slash, path = text.partition("/")
        return f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{slash}{path}'))"

    longest = sorted(rules, key=lambda r: -len(r[1]))
    rule = " ".join(f"WHEN {fits(t)} THEN '{t}'" for _, t in longest)
    said = " ".join(f"WHEN {fits(t)} THEN '{v}'" for v, t in longest)
    dropped = " OR ".join(f"starts_with(x, '{t}')" for t in tracking)
    return f"""
WITH r AS (SELECT page_id, url, regexp_replace(html, '<[^>]*>', ' ', 'g') AS body, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, url, body, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
        list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*\\?([^#]*)', 1), '&'), lambda x: x <> '' AND NOT ({dropped}))) AS params
      FROM r),
c AS (SELECT *, CASE {rule} END AS rule, CASE {said} END AS said,
        CASE WHEN instr(url, '://') > 0 THEN regexp_replace(host, '^(www|m)\\.', '') || regexp_replace(path, '/+$', '')
             || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS canon
      FROM p),
l AS (SELECT DISTINCT canon FROM c WHERE canon IS NOT NULL AND (list_has_any(regexp_split_to_array(host, '[.-]'), {list(words)!r})
      OR (len(regexp_extract_all(body, '{WORD}')) > 0 AND len(regexp_extract_all(body, '[#*$%|!]{{2,}}')) >= {share} * len(regexp_extract_all(body, '{WORD}')))))
SELECT page_id, host, path, rule, coalesce(said, CASE WHEN l.canon IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM c LEFT JOIN l ON c.canon = l.canon
"""


# Texts as hex, two digits a byte; w: every 50-byte string with the smallest document that has it.
OP5 = """
WITH d AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
c AS (SELECT doc_id, q, substr(h, CAST(1024 * q + 1 AS BIGINT), 1122) AS c
      FROM (SELECT doc_id, h, unnest(range(0, (greatest(0, len(h) // 2 - 49) + 511) // 512)) AS q FROM d)),
s AS (SELECT doc_id, 512 * q + p AS p, substr(c, CAST(2 * p + 1 AS BIGINT), 100) AS s
      FROM (SELECT doc_id, q, c, unnest(range(0, least(512, len(c) // 2 - 49))) AS p FROM c)),
f AS (SELECT s, min(doc_id) AS first FROM s GROUP BY s HAVING min(doc_id) < max(doc_id)),
w AS (SELECT doc_id, p, first FROM s JOIN f USING (s)),
g AS (SELECT doc_id, p, p - lag(p) OVER k > 50 OR lag(p) OVER k IS NULL AS opens
      FROM w WHERE first < doc_id WINDOW k AS (PARTITION BY doc_id ORDER BY p)),
r AS (SELECT doc_id, n, min(p) AS a, max(p) + 50 AS z
      FROM (SELECT doc_id, p, count(*) FILTER (opens) OVER (PARTITION BY doc_id ORDER BY p) AS n FROM g) GROUP BY doc_id, n),
e AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS b FROM r),
k AS (SELECT doc_id, count(*) AS n_spans, sum(z - a) AS n_removed, max(z) AS last,
        string_agg(substr(h, CAST(2 * b + 1 AS BIGINT), CAST(2 * (a - b) AS BIGINT)), '' ORDER BY a) AS kept
      FROM e JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, CAST(2 * coalesce(last, 0) + 1 AS BIGINT)))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""


def _dup(n: int) -> str:
    return f"""
g{n} AS (SELECT doc_id, p, CASE WHEN p + {n - 1} <= len(words) THEN
           count(*) OVER (PARTITION BY doc_id, CASE WHEN p + {n - 1} <= len(words) THEN array_to_string(words[p:p + {n - 1}], ' ') END) > 1
           ELSE false END AS twice FROM w),
c{n} AS (SELECT doc_id, p, max(twice) OVER (PARTITION BY doc_id ORDER BY p ROWS {n - 1} PRECEDING) AS hit FROM g{n})"""


def op8(limits) -> str:
    grams = [n for n, _ in limits.grams]
    tables = sorted({8, *grams})
    sums = ", ".join(f"CAST(coalesce(sum(length(words[p])) FILTER (c{n}.hit), 0) AS BIGINT) AS dup{n}_chars" for n in grams)
    joins = " ".join(f"JOIN c{n} USING (doc_id, p)" for n in tables)
    tests = " AND ".join(f"coalesce(dup{n}_chars, 0) <= CAST({most} AS DOUBLE) * word_chars" for n, most in limits.grams)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents),
w AS (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS p FROM d),
{','.join(_dup(n) for n in tables)},
r AS (SELECT doc_id, CAST(count(*) FILTER (c8.hit) AS BIGINT) AS n_repeat_words, {sums} FROM w {joins} GROUP BY doc_id),
l AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines FROM d),
m AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(length(array_to_string(lines, '')) - length(array_to_string(list_distinct(lines), '')) AS BIGINT) AS dup_line_chars,
        CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, length(t) AS n_chars,
        {', '.join(f'CAST(coalesce(dup{n}_chars, 0) AS BIGINT) AS dup{n}_chars' for n in grams)}
      FROM d JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)),
v AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND dup_line_chars <= CAST({limits.lines} AS DOUBLE) * n_chars AND {tests} AS kept,
       dup_line_chars, {', '.join(f'dup{n}_chars' for n in grams)}
FROM v
"""


OP10 = f"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
        (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, row_number() OVER (ORDER BY source NULLS LAST) AS i
      FROM d GROUP BY source),
o AS (SELECT *, row_number() OVER k AS rank,
        CAST(sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER before, 0) AS DOUBLE)
        / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS DOUBLE) AS unit
      FROM s WINDOW k AS (ORDER BY source_size / weight, i),
                    before AS (ORDER BY source_size / weight, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT min(rank) AS rank FROM o WHERE 3 * source_size > weight * unit),
g AS (SELECT source, source_size, CAST(CASE WHEN f.rank IS NULL OR o.rank < f.rank THEN 3 * source_size
                                       ELSE weight * (SELECT unit FROM o JOIN f USING (rank)) END AS DOUBLE) AS target
      FROM o CROSS JOIN f),
q AS (SELECT *, least(CAST(floor(target + 0.5) AS BIGINT), 3 * source_size) AS words FROM g),
p AS (SELECT d.doc_id, d.size, q.source_size, q.target,
        CASE WHEN q.source_size = 0 THEN 0 ELSE q.words // q.source_size END AS every,
        CASE WHEN q.source_size = 0 THEN 0 ELSE q.words % q.source_size END AS rest,
        sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('7:' || d.doc_id), d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS upto
      FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (every + CASE WHEN rest > 0 AND 2 * upto - size < 2 * rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM p
"""

OP12 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND b.vec_id <> a.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
QUALIFY rank <= 3"""
