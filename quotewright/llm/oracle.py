"""DuckDB SQL of the queries that SQL can express."""

SQL: dict[str, str] = {}

_W = r"[^\x20\x09-\x0D]+"

SQL["op5_quality_rules"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents
), w AS (SELECT *, regexp_extract_all(t, '{_W}') AS w FROM d),
win AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w)
), rep AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win),
cover AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM rep WHERE n > 1) GROUP BY r
), line AS (
  SELECT r, source, x, lower(trim(regexp_replace(x, '[\x20\x09-\x0D]+', ' ', 'g'))) AS norm,
         len(regexp_extract_all(x, '{_W}')) AS words
  FROM (SELECT r, source, unnest(string_split(t, chr(10))) AS x FROM d)
  WHERE regexp_matches(x, '{_W}')
), dup AS (SELECT r, count(*) - count(DISTINCT x) AS n FROM line GROUP BY r),
freq AS (SELECT source, norm FROM line GROUP BY source, norm HAVING count(DISTINCT r) > 20),
lost AS (
  SELECT r, sum(words) AS n FROM line JOIN freq
  ON line.norm = freq.norm AND line.source IS NOT DISTINCT FROM freq.source GROUP BY r
), base AS (
  SELECT w.r, doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(dup.n, 0) AS n_dup_lines, coalesce(cover.n, 0) AS n_repeat_words,
         CAST(coalesce(lost.n, 0) AS BIGINT) AS removed_words
  FROM w LEFT JOIN dup USING (r) LEFT JOIN cover USING (r) LEFT JOIN lost USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * removed_words <= 50 * n_words AS kept,
       removed_words
FROM base
"""

_P = (
    "((a_g3 + 4 * ((a_g2 + 4 * ((a_g1 + 4 * ((a_g0 + 4 * (CAST(1 AS DOUBLE) / 128)) / (a_n + 4)))"
    " / (a_c1 + 4))) / (a_c2 + 4))) / (a_c3 + 4))"
)
_SUMS = ", ".join(
    f"sum({s}) OVER (PARTITION BY substr(gram, {4 - k}, {k + 1})) AS {s}_g{k}"
    + (f", sum({s}) OVER (PARTITION BY substr(gram, {4 - k}, {k})) AS {s}_c{k}" if k else f", sum({s}) OVER () AS {s}_n")
    for s in "ab"
    for k in range(4)
)
_UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _fits(host: str, path: str) -> str:
    return f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}'))"


_CASES = [
    ("www.example.com", "/en/", "allow"),
    ("example.com", "/en/", "block"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
    ("com", "/", "allow"),
]
_RULE = "CASE " + " ".join(f"WHEN {_fits(h, p)} THEN '{h}{p}'" for h, p, _ in _CASES) + " END"
_SAID = "CASE " + " ".join(f"WHEN {_fits(h, p)} THEN '{v}'" for h, p, v in _CASES) + " END"

SQL["op4_url_filter"] = rf"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS url,
         CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), h AS (
  SELECT *, translate(regexp_extract(rest, '^([^/?#]*)', 1), {_UPPER}) AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM p
), r AS (SELECT *, {_RULE} AS rule, {_SAID} AS said FROM h),
u AS (
  SELECT DISTINCT url, said AS label, FALSE AS fit_,
         chr(2) || chr(2) || chr(2) || translate(url, {_UPPER}) || chr(3) AS s
  FROM r
), f AS (SELECT url, label, s, label IS NOT NULL AND substr(md5(url), 1, 1) NOT IN ('0', '1', '2', '3') AS fit FROM u),
g AS (SELECT url, label, fit, substr(s, i, 4) AS gram FROM (SELECT *, unnest(range(1, length(s) - 2)) AS i FROM f)),
c AS (
  SELECT gram, count(*) FILTER (fit AND label = 'allow') AS a, count(*) FILTER (fit AND label = 'block') AS b
  FROM g GROUP BY gram
), s AS (SELECT gram, {_SUMS} FROM c),
ratio AS (SELECT gram, CAST(round((ln({_P}) - ln({_P.replace("a_", "b_")})) * 1000000) AS BIGINT) AS ratio FROM s),
scored AS (
  SELECT url, label, fit,
         greatest(-1000, least(1000, CAST(floor(CAST(sum(ratio) AS DOUBLE) / (count(*) * 10000)) AS BIGINT))) AS bin
  FROM g JOIN ratio USING (gram) GROUP BY url, label, fit
), held AS (SELECT bin, label FROM scored WHERE label IS NOT NULL AND NOT fit),
cut AS (SELECT DISTINCT unnest([0, bin, bin + 1]) AS cut FROM held),
best AS (
  SELECT cut FROM (
    SELECT cut, sum(CASE WHEN label = 'allow' AND bin >= cut THEN 1 ELSE 0 END) * max(nb)
                + sum(CASE WHEN label = 'block' AND bin < cut THEN 1 ELSE 0 END) * max(na) AS right_
    FROM cut, held, (SELECT count(*) FILTER (label = 'allow') AS na, count(*) FILTER (label = 'block') AS nb FROM held)
    WHERE na > 0 AND nb > 0 GROUP BY cut)
  ORDER BY right_ DESC, abs(cut), cut LIMIT 1
)
SELECT page_id, host, path, rule,
       coalesce(said, CASE WHEN bin >= coalesce((SELECT cut FROM best), 0) THEN 'allow' ELSE 'block' END) AS verdict,
       bin AS score_bin
FROM r JOIN scored USING (url)
"""

# DuckDB has no CRC-32: its table of 256 remainders, then a byte at a time
SQL["op11_prefix_trie"] = """
WITH crc AS (
  SELECT list(v ORDER BY i) AS tab FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM (SELECT unnest(range(256)) AS i))
), t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, m) AS k, m, b
  FROM (
    SELECT conv_id, turn, octet_length(encode(coalesce(text, ''))) AS b,
           md5(CAST(length(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')) AS m
    FROM conversations WHERE conv_id IS NOT NULL)
), convs AS (
  SELECT c, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                            lambda a, x: xor(a >> 8, list_extract(tab, CAST(xor(a, x) & 255 AS INTEGER) + 1))), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT c FROM t), crc
), turns AS (
  SELECT convs.c, t.k AS k, m, b FROM convs JOIN t ON t.c = convs.c - convs.c % 5 WHERE t.k <= h
  UNION ALL SELECT convs.c, 8 + t.k, m, b FROM convs JOIN t ON t.c = convs.c WHERE t.k > h
), paths AS (
  SELECT c, row_number() OVER w AS depth, string_agg(m, '') OVER w AS path, b FROM turns WINDOW w AS (PARTITION BY c ORDER BY k)
  UNION ALL SELECT c, 0, '', 0 FROM convs
), node AS (
  SELECT depth, path, left(path, 32 * (depth - 1)) AS up, min(c) AS conv_id, count(*) AS n_convs, min(b) AS b FROM paths GROUP BY depth, path
), kids AS (SELECT up, count(*) AS n FROM node WHERE depth > 0 GROUP BY up),
own AS (
  SELECT node.*, coalesce(kids.n, 0) AS n_children, (n_convs - 1) * b AS saved, CASE WHEN kids.n IS NULL THEN 1 ELSE 0 END AS leaf
  FROM node LEFT JOIN kids ON kids.up = node.path
), sums AS (
  SELECT left(path, 32 * j) AS top, CAST(sum(saved) AS BIGINT) AS saved_tokens, CAST(sum(leaf) AS BIGINT) AS n_leaves
  FROM (SELECT path, saved, leaf, unnest(range(0, depth + 1)) AS j FROM own) GROUP BY top
), tip AS (SELECT c, max_by(path, depth) AS path FROM paths GROUP BY c),
ends AS (SELECT path, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS digest FROM tip GROUP BY path)
SELECT own.conv_id, own.depth, p.conv_id AS parent_conv_id, own.n_convs, own.n_children, n_leaves, saved_tokens,
       coalesce(digest, sha256('')) AS ends_sha256
FROM own JOIN sums ON sums.top = own.path
LEFT JOIN node p ON own.depth > 0 AND p.path = own.up AND p.depth = own.depth - 1
LEFT JOIN ends ON ends.path = own.path
"""
