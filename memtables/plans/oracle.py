"""DuckDB SQL oracles: for each registered query, the same result computed
directly from the input tables (views ``documents``, ``events``, ...).

Shared pieces are CTE strings composed per query. Scores are rounded to 6
digits and ties broken by id on both sides.
"""

from __future__ import annotations

_SQL: dict[str, str] = {}


def sql(name: str, text: str) -> None:
    _SQL[name] = text.strip()


def all_sql() -> dict[str, str]:
    from memtables.plans import oracle_more  # noqa: F401  (registers the rest)
    return dict(_SQL)


# -- shared CTEs ---------------------------------------------------------------

CV = """cv AS (
  SELECT vec_id AS chunk_id, label * 10 + vec_id % 7 AS memory_id,
         'label-' || label AS space_id, embedding
  FROM embeddings)"""

REQ = """req AS (
  SELECT e.vec_id AS query_id, e.embedding AS query_vector, d.text AS query_text,
         'label-' || e.label || ', label-' || ((e.label + 1) % 10) || ',,label-' || e.label AS space_ids
  FROM embeddings e LEFT JOIN documents d ON d.doc_id = e.vec_id)"""

QS = """qs AS (
  SELECT DISTINCT query_id, trim(s) AS space_id
  FROM req, unnest(string_split(space_ids, ',')) AS t(s)
  WHERE trim(s) <> '')"""

TOPK = """scored AS (
  SELECT qs.query_id, cv.chunk_id, cv.memory_id, cv.space_id,
         round(list_cosine_similarity(r.query_vector::DOUBLE[], cv.embedding::DOUBLE[]), 6) AS score
  FROM qs JOIN req r USING (query_id) JOIN cv USING (space_id)),
topk AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank
    FROM scored) WHERE rank <= 5)"""

MEM = """mem AS (
  SELECT d.doc_id AS memory_id, d.source AS space_id, d.text AS original_content,
         e.ts AS created_at, e.props AS props,
         CASE l.quality WHEN 1 THEN 'COMPLETED' WHEN 0 THEN 'FAILED' END AS processing_status
  FROM documents d JOIN events e ON e.event_id = d.doc_id
  LEFT JOIN labels l ON l.doc_id = d.doc_id)"""

CTEXT = """ctext AS (SELECT doc_id AS chunk_id, coalesce(text, '') AS chunk_text FROM documents)"""


def tokens(x: str) -> str:
    return (f"list_distinct(list_filter(regexp_split_to_array(lower(coalesce({x}, '')), "
            f"'[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> ''))")


def jaccard(a: str, b: str) -> str:
    ta, tb = tokens(a), tokens(b)
    u = f"len(list_distinct(list_concat({ta}, {tb})))"
    return f"CASE WHEN {u} > 0 THEN len(list_intersect({ta}, {tb})) / {u} ELSE 0.0 END"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes)


def chain(rerank: bool = False, threshold: float | None = None, resort: bool = False) -> str:
    """The post-processing chain over top-5, as CTEs ending in ``res``."""
    score = f"round({jaccard('query_text', 'chunk_text')}, 6)" if rerank else "score"
    order1 = "relevance_score DESC, chunk_id" if rerank else "rank"
    where = f"WHERE relevance_score >= {threshold}" if threshold is not None else ""
    final = "created_at, chunk_id" if resort else "o2"
    return f"""{with_(REQ, QS, CV, TOPK, MEM, CTEXT)},
j AS (
  SELECT t.*, r.query_text, coalesce(c.chunk_text, '') AS chunk_text, m.created_at
  FROM topk t JOIN req r USING (query_id)
  LEFT JOIN ctext c USING (chunk_id) LEFT JOIN mem m USING (memory_id)),
j1 AS (SELECT *, {score} AS relevance_score FROM j),
j2 AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY {order1}) AS o1 FROM j1),
j3 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY o1) AS o2
                      FROM j2 {where}) WHERE o2 <= 5),
j4 AS (SELECT * EXCLUDE (rank), row_number() OVER (PARTITION BY query_id ORDER BY {final}) AS rank FROM j3),
j5 AS (SELECT *, min(rank) OVER (PARTITION BY query_id, memory_id) AS first_pos FROM j4),
res AS (SELECT *, (dense_rank() OVER (PARTITION BY query_id ORDER BY first_pos) - 1)::INTEGER AS memory_index,
               count(*) OVER (PARTITION BY query_id) AS total_results FROM j5)"""


CHAIN_OUT = ("SELECT query_id, rank::INTEGER AS rank, chunk_id, memory_id, relevance_score, "
             "memory_index, total_results FROM res")

# -- retrieval -----------------------------------------------------------------

_TOPK_SQL = f"""{with_(REQ, QS, CV, TOPK)}
SELECT query_id, rank::INTEGER AS rank, chunk_id, memory_id, space_id, score FROM topk"""
for _n in ("retrieve_topk", "retrieve_topk_tiled", "retrieve_topk_broadcast"):
    sql(_n, _TOPK_SQL)

RAGGED = """rc AS (
  SELECT 'c' || vec_id AS chunk_id, 'm' || (label * 10 + vec_id % 7) AS memory_id, 'label-' || label AS space_id,
         CASE WHEN vec_id % 11 <> 0 THEN CASE WHEN vec_id % 3 = 0 THEN embedding[1:32] ELSE embedding END END::DOUBLE[] AS v
  FROM embeddings),
rq AS (
  SELECT vec_id AS i, 'q' || vec_id AS query_id, label,
         CASE WHEN vec_id % 13 <> 0 THEN CASE WHEN vec_id % 4 = 0 THEN embedding[1:32] ELSE embedding END END::DOUBLE[] AS qv
  FROM embeddings)"""

sql("retrieve_mixed", f"""{with_(RAGGED)},
s AS (
  SELECT query_id, chunk_id, memory_id, space_id, round(list_cosine_similarity(qv, v), 6) AS score
  FROM rq JOIN rc ON space_id IN ('label-' || label, 'label-' || ((label + 1) % 10)) AND len(qv) = len(v)
  WHERE i % 17 <> 0)
SELECT query_id, rank::INTEGER AS rank, chunk_id, memory_id, space_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM s) WHERE rank <= 5""")

sql("retrieval_outcomes", f"""{with_(RAGGED)},
o AS (SELECT query_id, CASE WHEN i % 17 = 0 THEN 'At least one valid Space ID is required.'
                            WHEN i % 13 = 0 THEN 'The request has no usable query vector'
                            WHEN i % 19 = 0 THEN 'Unknown reranker: nope' END AS error FROM rq)
SELECT query_id, error, error IS NULL AS success FROM o""")

MIXED_REQ = """mreq AS (
  SELECT vec_id AS query_id,
         'label-' || label || ', label-' || ((label + 1) % 10) || ',,label-' || label AS space_ids
  FROM embeddings
  UNION ALL
  SELECT conv_id * 1000 + turn + 1000000000,
         CASE role WHEN 'user' THEN 'conv-' || conv_id
                   WHEN 'assistant' THEN ' conv-' || conv_id || ' ,,' ELSE ' , ' END
  FROM conversations)"""

sql("parse_space_keys", f"""{with_(MIXED_REQ)},
p AS (SELECT query_id, list_filter(list_transform(string_split(space_ids, ','), lambda x: trim(x)), lambda x: x <> '') AS k
      FROM mreq)
SELECT query_id, len(k)::INTEGER AS n_keys, array_to_string(k, '|') AS space_keys,
       len(k) > 0 AS success,
       CASE WHEN len(k) = 0 THEN 'At least one valid Space ID is required.' END AS error
FROM p""")

sql("restrict_to_spaces", f"""{with_(REQ, QS, CV)},
n AS (SELECT space_id, count(*) AS n_chunks FROM cv GROUP BY space_id)
SELECT qs.query_id, qs.space_id, coalesce(n.n_chunks, 0) AS n_chunks
FROM qs LEFT JOIN n USING (space_id)""")

sql("retrieve_postprocessed", chain(rerank=True, threshold=0.05, resort=True) + "\n" + CHAIN_OUT)
sql("rerank", chain(rerank=True) + "\n" + CHAIN_OUT)
sql("relevance_threshold", chain(threshold=0.25) + "\n" + CHAIN_OUT)
sql("chronological_resort", chain(resort=True) + "\n" + CHAIN_OUT)

sql("fetch_memory_definitions", chain() + """
SELECT r.query_id, min(r.memory_index) AS memory_index, r.memory_id,
       any_value(m.space_id) AS memory_space_id, any_value(m.processing_status) AS processing_status,
       any_value(m.created_at) AS created_at
FROM res r LEFT JOIN mem m USING (memory_id)
GROUP BY r.query_id, r.memory_id""")

sql("result_totals", chain(threshold=0.25) + """
SELECT r.query_id, coalesce(a.total_results, 0) AS total_results,
       coalesce(a.total_memories, 0) AS total_memories
FROM req r LEFT JOIN (SELECT query_id, count(*) AS total_results,
                             count(DISTINCT memory_id) AS total_memories
                      FROM res GROUP BY query_id) a USING (query_id)""")

# the most central sentences of ``res`` that fit 400 characters, as CTEs ending in ``reply``
REPLY = rf"""cut AS (SELECT query_id, rank, regexp_extract_all(chunk_text, '[^.!?]+[.!?]*') AS x FROM res),
raw AS (SELECT query_id, rank, i, trim(regexp_replace(x[i], '[ \t\n\r\f]+', ' ', 'g')) AS s FROM cut, unnest(range(1, len(x) + 1)) t(i)),
sen AS (SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY query_id, s ORDER BY rank, i) = 1),
tok AS (SELECT query_id, rank, i, s, unnest({tokens('s')}) AS w FROM sen),
held AS (SELECT query_id, w, count(*) AS n FROM tok GROUP BY query_id, w),
sco AS (SELECT query_id, rank, i, s, sum(n)::DOUBLE * sum(n)::DOUBLE / count(*)::DOUBLE AS score
        FROM tok JOIN held USING (query_id, w) GROUP BY query_id, rank, i, s),
ord AS (SELECT *, row_number() OVER b AS place, sum(length(s) + 1) OVER (b ROWS UNBOUNDED PRECEDING) - 1 AS upto
        FROM sco WINDOW b AS (PARTITION BY query_id ORDER BY score DESC, rank, i)),
reply AS (SELECT query_id, string_agg(left(s, 400), ' ' ORDER BY rank, i) AS reply
          FROM ord WHERE place = 1 OR upto <= 400 GROUP BY query_id)"""

sql("abstract_context", chain() + f""",
{REPLY},
con AS (SELECT query_id, string_agg(chunk_text, chr(10) || chr(10) ORDER BY rank) AS context, count(*) AS n_chunks
        FROM res GROUP BY query_id)
SELECT query_id, context, coalesce(reply, '') AS abstract_reply, n_chunks FROM con LEFT JOIN reply USING (query_id)""")

sql("result_sets", chain(threshold=0.25) + f""",
{REPLY},
agg_r AS (SELECT query_id, count(*) AS total_results,
                 string_agg(chunk_id::VARCHAR, ',' ORDER BY rank) AS chunk_ids
          FROM res GROUP BY query_id),
mems AS (SELECT query_id, memory_id, min(memory_index) AS mi FROM res WHERE query_id % 3 <> 0 GROUP BY query_id, memory_id),
agg_m AS (SELECT query_id, count(*) AS total_memories,
                 string_agg(memory_id::VARCHAR, ',' ORDER BY mi) AS memory_ids
          FROM mems GROUP BY query_id)
SELECT r.query_id, true AS success, NULL::VARCHAR AS error, sha256('2:rs|' || length(r.query_id::VARCHAR) || ':' || r.query_id) AS result_set_id,
       CASE WHEN r.query_id % 2 = 0 AND a.total_results > 0 THEN coalesce(p.reply, '') END AS abstract_reply,
       coalesce(a.total_results, 0) AS total_results, coalesce(m.total_memories, 0) AS total_memories,
       coalesce(a.chunk_ids, '') AS chunk_ids, coalesce(m.memory_ids, '') AS memory_ids
FROM req r LEFT JOIN agg_r a ON a.query_id = r.query_id LEFT JOIN agg_m m ON m.query_id = r.query_id
  LEFT JOIN reply p ON p.query_id = r.query_id""")
