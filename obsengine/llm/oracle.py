"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

_GAP = r"[\x20\x09-\x0D]+"
_WORD_CHAR = r"[^\x20\x09-\x0D]"

#: The function words that the stop-word rule counts.
_STOP = (
    "the of and to in is that for with on be have der die das und den von zu mit des dem ist sich "
    "le la les de et un une que qui en dans du el los las y no se del con por para al").split()

_OP2 = """
WITH cut AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0
                       THEN substr(url, position('://' IN url) + 3) END AS rest
  FROM pages),
parsed AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM cut),
rules(action, host_part, path_part) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
         ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fitting AS (
  SELECT p.page_id, max_by(r.host_part || r.path_part, length(r.host_part || r.path_part)) AS rule,
         max_by(r.action, length(r.host_part || r.path_part)) AS action
  FROM parsed p JOIN rules r
    ON (p.host = r.host_part OR ends_with(p.host, '.' || r.host_part))
   AND starts_with(p.path, r.path_part)
  GROUP BY 1),
ruled AS (
  SELECT p.*, f.rule, f.action FROM parsed p LEFT JOIN fitting f USING (page_id)),
seeds AS (
  SELECT host, avg(CASE WHEN action = 'allow' THEN 1.0 ELSE 0.0 END) AS trust,
         avg(CASE WHEN action = 'block' THEN 1.0 ELSE 0.0 END) AS distrust
  FROM ruled WHERE host <> '' GROUP BY 1),
links AS (
  SELECT DISTINCT p.host AS src, lower(l.dst) AS dst
  FROM (SELECT page_id, unnest(regexp_extract_all(coalesce(html, ''),
          '(?i)\\bhref\\s*=\\s*["'']?\\s*(?:https?:)?//([^/?#"''\\s<>]+)', 1)) AS dst
        FROM pages) l JOIN parsed p USING (page_id)
  WHERE p.host <> '' AND p.host <> lower(l.dst)),
edges AS (
  SELECT src, dst, 1.0::DOUBLE / count(*) OVER (PARTITION BY src) AS share FROM links),
flow AS (
  WITH RECURSIVE walk(step, host, trust, distrust) AS (
    SELECT 0, host, trust::DOUBLE, distrust::DOUBLE FROM seeds
    UNION ALL
    SELECT step + 1, host, sum(trust), sum(distrust) FROM (
      SELECT w.step, e.to_host AS host, 0.85 * w.trust * e.t AS trust,
             0.85 * w.distrust * e.d AS distrust
      FROM walk w JOIN (SELECT src AS from_host, dst AS to_host, share AS t, 0.0 AS d FROM edges
                        UNION ALL SELECT dst, src, 0.0, share FROM edges) e
        ON e.from_host = w.host) GROUP BY step, host
    HAVING sum(trust) > 1e-9 OR sum(distrust) > 1e-9)
  SELECT host, sum(trust) AS trust, sum(distrust) AS distrust FROM walk GROUP BY host)
SELECT r.page_id, r.host, r.path, r.rule,
       coalesce(r.action, CASE WHEN f.distrust >= 0.5 AND f.distrust > f.trust THEN 'block'
                               ELSE 'allow' END) AS verdict
FROM ruled r LEFT JOIN flow f USING (host)
"""

_OP3 = f"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents),
cut AS (
  SELECT doc_id, text,
         list_filter(string_split_regex(text, '{_GAP}'), lambda x: x <> '') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD_CHAR}')) AS lines
  FROM base),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS w
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 7)) AS i FROM cut)),
twice AS (
  SELECT doc_id, w FROM windows GROUP BY 1, 2 HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM windows JOIN twice USING (doc_id, w), range(0, 8) AS t(k) GROUP BY 1),
counted AS (
  SELECT c.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
         len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(v.n, 0) AS n_repeat_words,
         len(list_filter(list_distinct(words), lambda x: x IN ({', '.join(f"'{w}'" for w in _STOP)}))) AS stops,
         len(list_filter(lines, lambda x: regexp_matches(x, '^[ \\t]*[-*•]'))) AS bullets,
         len(list_filter(lines, lambda x: regexp_matches(x, '(\\.\\.\\.|…)[ \\t\\r]*$'))) AS dots,
         len(list_filter(words, lambda x: regexp_matches(x, '\\pL'))) AS lettered
  FROM cut c LEFT JOIN covered v USING (doc_id)),
judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
       n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND word_chars >= 2 * n_words AND word_chars <= 16 * n_words
         AND n_symbols <= 0.1::DOUBLE * n_words AND stops >= 1 AND 2 * n_dup_lines <= n_lines
         AND bullets <= 0.9::DOUBLE * n_lines AND dots <= 0.3::DOUBLE * n_lines
         AND lettered >= 0.4::DOUBLE * n_words AS kept
FROM judged
"""

_OP5 = f"""
WITH sized AS (
  SELECT doc_id, source,
         len(list_filter(string_split_regex(coalesce(text, ''), '{_GAP}'), lambda x: x <> ''))::BIGINT AS size,
         length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>!]+', '', 'g')) AS symbols,
         (('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5)
           / 4503599627370496.0 AS u
  FROM documents),
keyed AS (
  SELECT doc_id, source, size,
         -ln(u) / CASE WHEN size > 0 THEN 1.0 - 0.5 * least(1.0::DOUBLE, symbols::DOUBLE / size)
                       ELSE 1.0 END AS key
  FROM sized),
sources AS (
  SELECT source, sum(size)::DOUBLE AS source_size,
         [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight
  FROM keyed GROUP BY source),
levels AS (
  SELECT arg_min(level, ratio) AS level FROM (
    SELECT a.source, 2 * a.source_size / a.weight AS ratio,
           (1.5 * (SELECT sum(source_size) FROM sources)
             - coalesce(sum(2 * b.source_size) FILTER (WHERE 2 * b.source_size / b.weight
                                                       < 2 * a.source_size / a.weight), 0))
           / (sum(b.weight) FILTER (WHERE 2 * b.source_size / b.weight
                                          >= 2 * a.source_size / a.weight)) AS level
    FROM sources a, sources b GROUP BY a.source, a.source_size, a.weight)
  WHERE level <= ratio),
plan AS (
  SELECT source, source_size, least(2 * source_size, weight * level) AS target
  FROM sources, levels),
epochs AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(2, floor(target / source_size)) ELSE 0 END AS epochs
  FROM plan),
placed AS (
  SELECT k.*, p.source_size, p.target, p.epochs,
         coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM keyed k JOIN epochs p ON k.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
       (size * (epochs + CASE WHEN size > 0 AND start + size / 2.0 <= target - epochs * source_size
                              THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed
"""

_OP8 = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       coalesce(doc_id = max(doc_id) OVER same, max(doc_id) OVER same IS NULL) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

#: Unsigned CRC-32 of a text of ASCII characters, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
    string_split({0}, ''), lambda c: list_concat([ascii(c)::BIGINT], [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END))"""

_OP11 = f"""
WITH given AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY 1),
heads AS (
  SELECT *, {_CRC32.format("conv_id::VARCHAR")} % 9 AS h FROM given),
rebuilt AS (
  SELECT c.conv_id, list_concat(list_slice(coalesce(s.turns, []), 1, c.h), list_slice(c.turns, c.h + 1, len(c.turns)))
         AS turns
  FROM heads c LEFT JOIN given s ON s.conv_id = c.conv_id - c.conv_id % 5),
prefixes AS (
  SELECT conv_id, d, list_slice(turns, 1, d) AS node, len(turns) = d AS ends
  FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs,
         CASE WHEN d > 0 THEN (count(*) - 1) * strlen(node[d].text) ELSE 0 END AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM prefixes GROUP BY node, d),
kids AS (
  SELECT list_slice(node, 1, d - 1) AS node, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
counted AS (
  SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN kids k ON k.node = n.node),
upward AS (
  SELECT list_slice(node, 1, unnest(range(0, d + 1))) AS node, saved, (n_children = 0)::INT AS leaf FROM counted),
sums AS (
  SELECT node, sum(saved)::BIGINT AS saved_tokens, sum(leaf)::BIGINT AS n_leaves FROM upward GROUP BY 1)
SELECT c.conv_id, c.d::BIGINT AS depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, s.n_leaves, s.saved_tokens,
       c.ends_sha256
FROM counted c JOIN sums s ON s.node = c.node
LEFT JOIN nodes p ON c.d > 0 AND p.d = c.d - 1 AND p.node = list_slice(c.node, 1, c.d - 1)
"""

_OP13 = """
WITH scaled AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM scaled q JOIN scaled c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""

ORACLE = {
    "op2_url_filters": _OP2,
    "op3_quality_rules": _OP3,
    "op5_source_mixing": _OP5,
    "op8_exact_dedup": _OP8,
    "op11_prefix_trie": _OP11,
    "op13_exact_topk": _OP13,
}
