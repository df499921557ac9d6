"""DuckDB SQL for the queries that SQL can express, over the same tables."""

from __future__ import annotations

_WS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP3 = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents),
keyed AS (SELECT *, translate(trim(line, {_WS}), '{_UPPER}', '{_LOWER}') AS k FROM lines),
repeated AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT keyed.*, keeper IS NOT NULL AND keeper <> doc_id AS dropped
  FROM keyed LEFT JOIN repeated USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP4 = rf"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS words FROM documents),
grams AS (
  SELECT doc_id, i, list_slice(words, i, i + 7) AS g
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
covered AS (
  SELECT doc_id, sum(least(8, coalesce(lead_i - i, 8))) AS n
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS lead_i FROM twice) GROUP BY doc_id),
lines AS (
  SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM w),
stats AS (
  SELECT w.doc_id, t, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
         coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM w JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    10 * n_symbols > 3 * n_words
    OR (n_lines >= 5 AND 100 * n_dup_lines > 40 * n_lines)
    OR word_chars < 2 * n_words OR word_chars > 20 * n_words
    OR 2 * len(regexp_extract_all(t, '[A-Z]')) > len(regexp_extract_all(t, '[A-Za-z]'))
    OR 10 * len(regexp_extract_all(t, '[!?]')) > 4 * n_words
    OR 10 * len(regexp_extract_all(t, '[0-9]')) > 3 * word_chars AS rejected
  FROM stats)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT rejected AS kept
FROM judged
"""

OP6 = r"""
WITH all_turns AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
escaped AS (
  SELECT *, length(text) + length(text) - length(replace(replace(replace(text, '\', ''), '<', ''), '[', '')) AS n,
    CASE role WHEN 'system' THEN length('<sys>') + length('</sys>') + 1
              WHEN 'user' THEN length('[INST] ') + length(' [/INST]')
              WHEN 'assistant' THEN length('<s>') + length('</s>') + 1
              ELSE length('<turn:>') + length('</turn>') + 1 + length(coalesce(role, '')) END AS marks
  FROM all_turns),
walked AS (
  SELECT *, row_number() OVER talk - 1 AS i, count(*) OVER (PARTITION BY conv_id) - 1 AS last_i,
    coalesce(role, '') NOT IN ('system', 'user') AND row_number() OVER talk = 1
    OR row_number() OVER talk > 1 AND coalesce(lag(role) OVER talk, '') || '>' || coalesce(role, '')
       NOT IN ('system>user', 'user>assistant', 'assistant>user') AS wrong
  FROM escaped WINDOW talk AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text))
SELECT conv_id, count(*) AS n_turns, NOT bool_or(wrong) AND bool_or(i = last_i AND role = 'assistant') AS valid,
       min(i) FILTER (WHERE wrong) AS error_turn,
       sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(n + marks)::BIGINT AS formatted_chars
FROM walked GROUP BY conv_id
"""

OP8 = rf"""
WITH rows AS (SELECT doc_id, source, len({_WORDS}) AS size FROM documents),
cells AS (SELECT source, size, ceil(count(*) / 1000)::BIGINT AS parts FROM rows GROUP BY ALL),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM rows GROUP BY source),
line AS (
  SELECT *, source_size * 2.0::DOUBLE AS cap, (sum(source_size) OVER ())::DOUBLE AS total,
         coalesce(sum(source_size * 2.0::DOUBLE) OVER before, 0) AS capped,
         sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS heavy
  FROM sources WINDOW before AS (ORDER BY source_size * 2.0::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (SELECT *, (total * 1.5::DOUBLE - capped) / heavy AS level FROM line),
water AS (SELECT arg_min(level, cap / weight) AS water FROM levels WHERE level * weight <= cap),
goals AS (
  SELECT source, source_size, CASE WHEN water IS NULL THEN cap ELSE least(cap, water * weight) END AS target,
         ('0x' || substr(md5('mix-1|' || coalesce('s' || source, 'null')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM levels CROSS JOIN water),
ranked AS (
  SELECT rows.*, row_number() OVER (PARTITION BY rows.source ORDER BY rows.size,
                                       ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % parts, doc_id) AS i
  FROM rows JOIN cells ON rows.source IS NOT DISTINCT FROM cells.source AND rows.size = cells.size),
drawn AS (
  SELECT doc_id, size, source_size, target, u, i, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS r
  FROM ranked JOIN goals ON ranked.source IS NOT DISTINCT FROM goals.source)
SELECT doc_id, size, source_size, target,
       (least(floor(i * r + u) - floor((i - 1) * r + u), 2) * size)::BIGINT AS taken
FROM drawn
"""


def _op12(rounds: int = 5, k: int = 40) -> str:
    nearest = """
  SELECT vec_id, v, arg_min(c, [d, c]) AS c, min(d) AS d FROM (
    SELECT vec_id, v, c, list_sum(list_transform(list_zip(v, u), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
    FROM numbers CROSS JOIN {at}) GROUP BY vec_id, v"""
    parts = [f"""
WITH numbers AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
at0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY h))::INTEGER - 1 AS c, v AS u
  FROM (SELECT sha256('2:' || vec_id) AS h, v FROM numbers ORDER BY h LIMIT {k}))"""]
    for r in range(1, rounds + 1):
        parts.append(f"""
near{r} AS MATERIALIZED ({nearest.format(at=f'at{r - 1}')}),
mean{r} AS (
  SELECT c, list(m ORDER BY i) AS u FROM (
    SELECT c, i, floor(sum(x) / count(*))::BIGINT AS m
    FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM near{r}) GROUP BY c, i) GROUP BY c),
at{r} AS MATERIALIZED (SELECT a.c, coalesce(m.u, a.u) AS u FROM at{r - 1} a LEFT JOIN mean{r} m USING (c))""")
    parts.append(f"""
last AS MATERIALIZED ({nearest.format(at=f'at{rounds}')})""")
    return ",".join(parts) + f"""
SELECT vec_id, c AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(u, ',')) AS centroid_sha256
FROM last JOIN at{rounds} USING (c)
"""


def all_sql() -> dict[str, str]:
    return {"op3_line_dedup": OP3, "op4_quality_rules": OP4, "op6_chat_format": OP6, "op8_mixing": OP8, "op12_centroids": _op12()}
