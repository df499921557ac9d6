"""More SQL oracles (catalogue, memories, ingest, parsers, chunking, streaming)."""

from __future__ import annotations

from memtables.plans.oracle import CV, MEM, sql, with_

SP = """sp AS (
  SELECT d.source AS space_id, d.source AS name, min(e.ts) AS created_at, 'emb-64' AS emb
  FROM documents d JOIN events e ON e.event_id = d.doc_id GROUP BY d.source)"""

# -- catalogue -----------------------------------------------------------------------

sql("list_spaces", f"""{with_(SP)}
SELECT space_id, name, emb AS embedder_id, 'recursive' AS strategy, 512 AS chunk_size,
       50 AS chunk_overlap, false AS public_read, 'kind=docs' AS labels, created_at,
       count(*) OVER () AS total_spaces
FROM sp""")

sql("get_space", f"""{with_(SP)},
rq AS (SELECT DISTINCT source AS space_id FROM documents UNION SELECT DISTINCT lang FROM documents)
SELECT rq.space_id, sp.space_id IS NOT NULL AS success,
       CASE WHEN sp.space_id IS NULL THEN 'Space not found: ' || rq.space_id END AS error,
       sp.name, sp.emb AS embedder_id
FROM rq LEFT JOIN sp ON sp.space_id = rq.space_id""")

sql("list_embedders", f"""{with_(SP)},
reg AS (SELECT * FROM (VALUES ('emb-64', 'precomputed 64-d vectors', 64),
                              ('hash-256', 'hashed bag of words', 256)) t(embedder_id, name, dim)),
used AS (SELECT emb AS embedder_id, count(*) AS n_spaces FROM sp GROUP BY emb)
SELECT coalesce(reg.embedder_id, used.embedder_id) AS embedder_id,
       coalesce(reg.name, used.embedder_id) AS name, reg.dim,
       coalesce(used.n_spaces, 0) AS n_spaces, count(*) OVER () AS total_embedders
FROM reg FULL JOIN used ON used.embedder_id = reg.embedder_id""")

CREATE_REQ = """rq AS (
  SELECT min(doc_id) AS seq, source AS name, 'hash-256' AS embedder_id, NULL::VARCHAR AS strategy,
         NULL::INTEGER AS chunk_size, NULL::INTEGER AS chunk_overlap
  FROM documents GROUP BY source
  UNION ALL
  SELECT 1000000 + l.m * 10 + o.off, o.prefix || l.lang, o.emb, o.st, o.sz, o.ov
  FROM (SELECT lang, min(doc_id) AS m FROM documents GROUP BY lang) l,
       (VALUES (0, 'lang-', 'hash-256', 'sentence', 256, 32),
               (1, 'lang-', 'hash-256', 'none', NULL, NULL),
               (2, 'bad-', 'emb-64', 'semantic', 256, 32),
               (3, 'tight-', 'emb-64', 'fixed', 64, 64),
               (4, 'tight-', 'emb-64', 'fixed', 64, 16),
               (5, 'tight-', 'hash-256', 'fixed', 64, 80)) o(off, prefix, emb, st, sz, ov)),
cfg AS (
  SELECT *, coalesce(strategy, 'recursive') AS c_st, coalesce(chunk_size, 512)::INTEGER AS c_sz,
         coalesce(chunk_overlap, 50)::INTEGER AS c_ov FROM rq),
cfg2 AS (
  SELECT *, CASE WHEN c_st NOT IN ('none', 'fixed', 'sentence', 'recursive')
                   THEN 'Unknown chunking strategy: ' || c_st
                 WHEN c_st <> 'none' AND (c_sz <= 0 OR c_ov < 0 OR c_ov >= c_sz)
                   THEN 'chunk_overlap must be smaller than chunk_size' END AS c_err
  FROM cfg)"""

sql("chunking_config", f"""{with_(CREATE_REQ)}
SELECT seq, c_st AS strategy, CASE WHEN c_st <> 'none' THEN c_sz END AS chunk_size,
       CASE WHEN c_st <> 'none' THEN c_ov END AS chunk_overlap, c_err AS error
FROM cfg2""")

sql("create_or_reuse_spaces", f"""{with_(SP, CREATE_REQ)},
ex AS (SELECT name, arg_min(space_id, created_at) AS ex_id, arg_min(emb, created_at) AS ex_emb
       FROM sp GROUP BY name),
r AS (SELECT c.*, ex.ex_id, ex.ex_emb FROM cfg2 c LEFT JOIN ex ON ex.name = c.name),
cr AS (SELECT name, min(seq) AS c_seq FROM r WHERE ex_id IS NULL AND c_err IS NULL GROUP BY name),
cr2 AS (SELECT cr.name, cr.c_seq, r.embedder_id AS c_emb
        FROM cr JOIN r ON r.name = cr.name AND r.seq = cr.c_seq),
f AS (SELECT r.*, cr2.c_seq, cr2.c_emb, r.ex_id IS NOT NULL AS reuse_ex,
             coalesce(r.ex_id IS NULL AND r.seq = cr2.c_seq, false) AS creates,
             coalesce(r.ex_id IS NULL AND r.seq > cr2.c_seq, false) AS reuse_new
      FROM r LEFT JOIN cr2 ON cr2.name = r.name),
g AS (SELECT *, CASE WHEN NOT (reuse_ex OR creates OR reuse_new) THEN c_err END AS error FROM f)
SELECT seq, name,
       CASE WHEN reuse_ex THEN ex_id WHEN creates OR reuse_new THEN sha256('5:space|' || length(name) || ':' || name) END AS space_id,
       CASE WHEN reuse_ex THEN coalesce(ex_emb, embedder_id) WHEN reuse_new THEN c_emb
            WHEN creates THEN embedder_id END AS embedder_id,
       CASE WHEN creates THEN c_st END AS strategy,
       CASE WHEN creates AND c_st <> 'none' THEN c_sz END AS chunk_size,
       CASE WHEN creates AND c_st <> 'none' THEN c_ov END AS chunk_overlap,
       CASE WHEN reuse_ex OR creates OR reuse_new THEN reuse_ex OR reuse_new END AS reused,
       error IS NULL AS success, error,
       CASE WHEN reuse_ex OR reuse_new THEN 'Space already exists, reusing existing space'
            WHEN error IS NULL THEN 'Space created successfully' END AS message
FROM g""")

sql("create_or_reuse_catalog", f"""{with_(SP, CREATE_REQ)},
fresh AS (SELECT name, arg_min(struct_pack(e := embedder_id, st := c_st, sz := c_sz, ov := c_ov, seq := seq), seq) AS c
          FROM cfg2 WHERE c_err IS NULL AND name NOT IN (SELECT name FROM sp) GROUP BY name)
SELECT s.space_id, s.name, s.emb AS embedder_id, 'recursive' AS strategy, 512::INTEGER AS chunk_size, 50::INTEGER AS chunk_overlap,
       false AS public_read, 'kind=docs' AS labels, s.created_at
FROM sp s
UNION ALL
SELECT sha256('5:space|' || length(name) || ':' || name), name, c.e, c.st, CASE WHEN c.st <> 'none' THEN c.sz END, CASE WHEN c.st <> 'none' THEN c.ov END,
       false, '', TIMESTAMP '2024-01-01 00:00:00' + to_seconds(c.seq) FROM fresh""")

UPD = """src AS (SELECT source, min(doc_id) % 5 AS n FROM documents GROUP BY source),
upd AS (
  SELECT source AS space_id, n,
         CASE WHEN n = 4 THEN 'replace_labels and merge_labels are mutually exclusive' END AS error,
         CASE WHEN n = 0 THEN 'renamed-' || source ELSE source END AS name,
         n = 1 AS public_read,
         CASE n WHEN 0 THEN 'kind=docs' WHEN 1 THEN 'flag=true;kind=docs;level=3'
                WHEN 2 THEN 'team=nlp' WHEN 3 THEN 'kind=merged;team=nlp' END AS labels
  FROM src
  UNION ALL
  SELECT DISTINCT lang, -1, 'Space not found: ' || lang, NULL, NULL, NULL FROM documents)"""

sql("update_spaces", f"""WITH {UPD}
SELECT space_id, error IS NULL AS success, error,
       CASE WHEN error IS NULL THEN name END AS name,
       CASE WHEN error IS NULL THEN public_read END AS public_read,
       CASE WHEN error IS NULL THEN labels END AS labels,
       CASE WHEN error IS NULL THEN 'Space updated successfully' END AS message
FROM upd""")

sql("update_spaces_sequence", """WITH
src AS (SELECT d.source AS s, (SELECT min(doc_id) FROM documents x WHERE x.source = d.source) % 2 AS odd
        FROM documents d JOIN events e ON e.event_id = d.doc_id GROUP BY d.source),
final AS (SELECT s, CASE WHEN odd = 1 THEN 'c=3' ELSE 'a=4;kind=x' END AS labels FROM src)
SELECT s AS space_id, 1::BIGINT AS seq, true AS success, NULL::VARCHAR AS error, s AS name, false AS public_read,
       'a=1;kind=x' AS labels FROM src
UNION ALL SELECT s, 2, true, NULL, 'new-' || s, true, 'a=1;kind=x' FROM src
UNION ALL SELECT s, 3, false, 'Labels must be a JSON object of string-to-string pairs, got: {"b":[1]}', NULL, NULL, NULL FROM src
UNION ALL SELECT s, 4, true, NULL, 'new-' || s, true, labels FROM final
UNION ALL SELECT s, NULL, NULL, NULL, 'new-' || s, true, labels FROM final""")

sql("merge_labels", f"""WITH {UPD}
SELECT space_id, CASE WHEN error IS NULL THEN name ELSE space_id END AS name,
       CASE WHEN error IS NULL THEN public_read ELSE false END AS public_read,
       CASE WHEN error IS NULL THEN labels ELSE 'kind=docs' END AS labels
FROM upd WHERE n >= 0""")

# every sixth row: the props as they are, a null and typed values, a nested value, trailing text, an array, blank
LABEL_ROWS = """lr AS (SELECT event_id, CASE event_id % 6
    WHEN 0 THEN props WHEN 1 THEN '{"n":null,"i":' || event_id || ',"b":true,"s":"x' || event_id || '"}'
    WHEN 2 THEN '{"a":{"n":' || event_id || '}}' WHEN 3 THEN '{"a":"b"} ' || event_id WHEN 4 THEN '[' || event_id || ']' ELSE ' ' END AS raw
  FROM events)"""

sql("parse_labels", f"""WITH {LABEL_ROWS},
judged AS (SELECT *, trim(raw) = '' AS blank, json_valid(raw) AS whole FROM lr),
kinds AS (SELECT *, CASE WHEN blank THEN true WHEN NOT whole THEN false WHEN json_type(raw) <> 'OBJECT' THEN false
    ELSE len(list_filter(json_keys(raw), lambda k: json_type(raw, '$."' || k || '"') IN ('OBJECT', 'ARRAY'))) = 0 END AS ok FROM judged)
SELECT event_id, CASE WHEN ok AND NOT blank THEN array_to_string(list_transform(list_sort(list_filter(json_keys(raw),
         lambda k: json_type(raw, '$."' || k || '"') <> 'NULL')), lambda k: k || '=' || json_extract_string(raw, '$."' || k || '"')), ';') END AS labels,
       ok AS success, CASE WHEN NOT ok THEN 'Labels must be a JSON object of string-to-string pairs, got: ' || raw END AS error
FROM kinds""")

sql("delete_spaces", """WITH
sp AS (SELECT DISTINCT d.source AS space_id FROM documents d JOIN events e ON e.event_id = d.doc_id),
rq AS (SELECT DISTINCT d.source AS space_id FROM documents d JOIN labels l ON l.doc_id = d.doc_id
       WHERE l.toxic = 1
       UNION SELECT DISTINCT 'gone-' || lang FROM documents),
mc AS (SELECT d.source AS space_id, count(*) AS n FROM documents d JOIN events e ON e.event_id = d.doc_id
       GROUP BY 1)
SELECT rq.space_id, sp.space_id IS NOT NULL AS success,
       CASE WHEN sp.space_id IS NULL THEN 'Space not found: ' || rq.space_id END AS error,
       CASE WHEN sp.space_id IS NOT NULL THEN coalesce(mc.n, 0) ELSE 0 END AS deleted_memories,
       CASE WHEN sp.space_id IS NOT NULL THEN 'Space deleted successfully' END AS message
FROM rq LEFT JOIN sp ON sp.space_id = rq.space_id LEFT JOIN mc ON mc.space_id = sp.space_id""")

_LEFT = """
cvn AS (SELECT vec_id AS chunk_id, label * 10 + vec_id % 7 AS memory_id, 'label-' || label AS space_id FROM embeddings)"""

sql("delete_spaces_tables", f"""{with_(MEM)},{_LEFT},
gone AS (SELECT source AS space_id FROM documents GROUP BY source HAVING min(doc_id) % 2 = 0),
m AS (SELECT memory_id, space_id FROM mem WHERE space_id NOT IN (SELECT space_id FROM gone)),
gm AS (SELECT memory_id FROM mem WHERE space_id IN (SELECT space_id FROM gone))
SELECT 'spaces' AS tbl, space_id AS id, space_id FROM (SELECT DISTINCT space_id FROM m)
UNION ALL SELECT 'memories', memory_id::VARCHAR, space_id FROM m
UNION ALL SELECT 'chunks', memory_id || '-0', space_id FROM m
UNION ALL SELECT 'vectors', chunk_id::VARCHAR, space_id FROM cvn WHERE memory_id NOT IN (SELECT memory_id FROM gm)""")

sql("delete_memories_tables", f"""{with_(MEM)},{_LEFT},
gm AS (SELECT memory_id FROM mem WHERE memory_id IN (SELECT doc_id FROM labels WHERE toxic = 1)),
m AS (SELECT memory_id, space_id FROM mem WHERE memory_id NOT IN (SELECT memory_id FROM gm))
SELECT 'memories' AS tbl, memory_id::VARCHAR AS id, space_id FROM m
UNION ALL SELECT 'chunks', memory_id || '-0', space_id FROM m
UNION ALL SELECT 'vectors', chunk_id::VARCHAR, space_id FROM cvn WHERE memory_id NOT IN (SELECT memory_id FROM gm)""")

sql("delete_memories", f"""{with_(MEM, CV)},
rq AS (SELECT doc_id AS memory_id FROM labels WHERE toxic = 1
       UNION SELECT -doc_id - 1 FROM labels WHERE toxic = 1),
vc AS (SELECT memory_id, count(*) AS n FROM cv GROUP BY memory_id)
SELECT rq.memory_id, m.memory_id IS NOT NULL AS success,
       CASE WHEN m.memory_id IS NULL THEN 'Memory not found: ' || rq.memory_id END AS error,
       CASE WHEN m.memory_id IS NOT NULL THEN coalesce(vc.n, 0) END AS deleted_vectors,
       CASE WHEN m.memory_id IS NOT NULL THEN 'Memory deleted successfully' END AS message
FROM rq LEFT JOIN mem m ON m.memory_id = rq.memory_id LEFT JOIN vc ON vc.memory_id = rq.memory_id""")

# -- memories -------------------------------------------------------------------------

TOKEN = "base64(encode(CAST(created_at AS VARCHAR) || '|' || memory_id))"

sql("list_memories", f"""{with_(MEM)},
f AS (SELECT *, json_extract(props, '$.k')::INTEGER AS k FROM mem
      WHERE processing_status = 'COMPLETED' AND json_extract(props, '$.k')::INTEGER < 50),
r AS (SELECT *, row_number() OVER (PARTITION BY space_id ORDER BY created_at, memory_id) AS position,
             count(*) OVER (PARTITION BY space_id) AS n_all FROM f),
p AS (SELECT * FROM r WHERE position <= 10),
l AS (SELECT space_id, arg_max({TOKEN}, position) AS tok, count(*) AS n_page FROM p GROUP BY space_id)
SELECT p.space_id AS request_id, p.memory_id, p.processing_status, p.created_at, p.k,
       p.position::INTEGER AS position, l.n_page AS total_memories,
       CASE WHEN p.n_all > 10 THEN l.tok END AS next_token
FROM p JOIN l USING (space_id)""")

sql("list_memories_by_token", f"""{with_(MEM)},
r AS (SELECT *, row_number() OVER (PARTITION BY space_id ORDER BY created_at, memory_id) AS p,
             count(*) OVER (PARTITION BY space_id) AS n_all FROM mem),
q AS (SELECT * FROM r WHERE p BETWEEN 11 AND 20),
l AS (SELECT space_id, arg_max({TOKEN}, p) AS tok, count(*) AS n_page FROM q GROUP BY space_id)
SELECT space_id AS request_id, space_id, memory_id, (p - 10)::INTEGER AS position, n_page AS total_memories,
       CASE WHEN n_all > 20 THEN tok END AS next_token, true AS success, NULL::VARCHAR AS error
FROM q JOIN l USING (space_id)
UNION ALL
SELECT DISTINCT 'bad-' || source, source, NULL, NULL, NULL, NULL, false, 'Page token cannot be read' FROM documents""")

sql("project_content", f"""{with_(MEM)},
r AS (SELECT *, row_number() OVER (PARTITION BY space_id ORDER BY created_at, memory_id) AS position FROM mem)
SELECT space_id AS request_id, memory_id, 'text/plain' AS content_type, original_content,
       position::INTEGER AS position
FROM r WHERE position <= 10""")

sql("filter_by_status", f"""{with_(MEM)}
SELECT memory_id, space_id, 'PENDING' AS processing_status FROM mem WHERE processing_status IS NULL""")

for _n in ("filter_by_metadata", "filter_by_path_columns"):
    sql(_n, f"""{with_(MEM)}
SELECT memory_id, space_id, json_extract(props, '$.k')::INTEGER AS k FROM mem
WHERE json_extract(props, '$.k')::INTEGER < 50""")

sql("get_memory", f"""{with_(MEM)},
rq AS (SELECT doc_id AS memory_id FROM labels UNION ALL SELECT -doc_id - 1 FROM labels WHERE toxic = 1)
SELECT rq.memory_id, m.memory_id IS NOT NULL AS success,
       CASE WHEN m.memory_id IS NULL THEN 'Memory not found: ' || rq.memory_id END AS error,
       m.space_id, CASE WHEN m.memory_id IS NOT NULL THEN coalesce(m.processing_status, 'PENDING') END
         AS processing_status,
       CASE WHEN m.memory_id IS NOT NULL THEN 'string' END AS content_kind,
       m.original_content AS content, NULL::VARCHAR AS content_error
FROM rq LEFT JOIN mem m ON m.memory_id = rq.memory_id""")

sql("negotiate_content", """WITH
st AS (SELECT doc_id * 2 AS memory_id, 'text/plain' AS ct, text AS stored FROM documents
       UNION ALL
       SELECT event_id * 2 + 1, 'application/json; charset=utf-8',
              CASE WHEN event_type = 'error' THEN substr(props, 2) ELSE props END FROM events)
SELECT memory_id,
       CASE WHEN contains(ct, 'application/json') THEN 'json' ELSE 'string' END AS content_kind,
       CASE WHEN NOT contains(ct, 'application/json') THEN stored
            WHEN json_valid(stored) THEN json(stored)::VARCHAR END AS content,
       CASE WHEN contains(ct, 'application/json') AND stored IS NOT NULL AND NOT json_valid(stored)
            THEN 'Failed to fetch content: invalid JSON content' END AS content_error
FROM st""")

sql("page_memories", f"""{with_(MEM)},
r AS (SELECT *, row_number() OVER (PARTITION BY space_id ORDER BY created_at, memory_id) AS position,
             count(*) OVER (PARTITION BY space_id) AS total FROM mem)
SELECT space_id, memory_id, (position - 1) // 100 AS page_no, position,
       CASE WHEN position % 100 = 0 AND position < total THEN {TOKEN} END AS next_token
FROM r""")

# -- ingest ---------------------------------------------------------------------------


def mem_id(space: str, req: str) -> str:
    return f"sha256('6:memory|' || length({space}::VARCHAR) || ':' || {space} || '|' || length({req}::VARCHAR) || ':' || {req})"


FILES = """files AS (
  SELECT page_id, html,
         '/p/' || page_id || CASE page_id % 4 WHEN 0 THEN '.pdf' WHEN 1 THEN '.DOCX'
                                              WHEN 2 THEN '.txt' ELSE '' END AS path
  FROM pages),
ft AS (
  SELECT *, CASE WHEN lower(path) LIKE '%.pdf' THEN 'application/pdf'
                 WHEN lower(path) LIKE '%.docx'
                   THEN 'application/vnd.openxmlformats-officedocument.wordprocessingml.document'
                 WHEN lower(path) LIKE '%.txt' THEN 'text/plain'
                 ELSE 'application/octet-stream' END AS content_type
  FROM files)"""

sql("ingest_text", f"""
SELECT doc_id AS request_id, source AS space_id, {mem_id('source', 'doc_id')} AS memory_id,
       'text/plain' AS content_type, text AS original_content, true AS success, NULL::VARCHAR AS error
FROM documents""")

sql("ingest_files", f"""{with_(FILES)}
SELECT path AS request_id, {mem_id("'pages'", 'path')} AS memory_id, content_type,
       CASE WHEN content_type LIKE 'text/%' THEN html END AS original_content,
       CASE WHEN content_type NOT LIKE 'text/%' THEN base64(encode(html)) END AS original_content_b64,
       true AS success, NULL::VARCHAR AS error
FROM ft""")

sql("resolve_content", f"""{with_(FILES)}
SELECT d.doc_id AS request_id, CASE WHEN ft.path IS NOT NULL THEN 'file' ELSE 'text' END AS source_kind,
       coalesce(ft.content_type, 'text/plain') AS content_type, true AS success, NULL::VARCHAR AS error
FROM documents d LEFT JOIN ft ON ft.page_id = d.doc_id""")

sql("detect_content_type", f"""{with_(FILES)}
SELECT path, content_type FROM ft""")

sql("encode_payload", f"""{with_(FILES)}
SELECT path, content_type,
       CASE WHEN content_type LIKE 'text/%' THEN html END AS original_content,
       CASE WHEN content_type NOT LIKE 'text/%' THEN base64(encode(html)) END AS original_content_b64
FROM ft""")

META = """mr AS (
  SELECT event_id AS request_id, event_type, props,
         CASE WHEN event_type = 'error' THEN 'Metadata must be a JSON object, got: ' || substr(props, 2) END
           AS error
  FROM events)"""

sql("attach_metadata", f"""{with_(META)}
SELECT request_id,
       CASE WHEN event_type NOT IN ('error', 'signup') THEN json(props)::VARCHAR END AS metadata,
       error IS NULL AS success, error
FROM mr""")

sql("ingest_ack", f"""
SELECT doc_id AS request_id, {mem_id('source', 'doc_id')} AS memory_id, source AS space_id,
       'PENDING' AS status, 'text/plain' AS content_type, 'Memory created successfully' AS message
FROM documents""")

sql("outcomes", f"""{with_(META)}
SELECT request_id, error IS NULL AS success, error,
       CASE WHEN error IS NULL
            THEN '{{"success":true,"memory_id":"' || {mem_id("'events'", 'request_id')}
                 || '","message":"Memory created successfully"}}'
            ELSE '{{"success":false,"error":' || to_json(error) || '}}' END AS outcome
FROM mr""")

sql("write_memory_tables", f"""{with_(MEM)}
SELECT memory_id, space_id, 'text/plain' AS content_type, processing_status, created_at,
       json(props)::VARCHAR AS metadata
FROM mem""")

sql("write_tables_of_number_ids", f"""{with_(MEM)},
ids AS (SELECT 'spaces' AS tbl, space_id FROM (SELECT DISTINCT space_id FROM mem)
        UNION ALL SELECT 'memories', space_id FROM mem
        UNION ALL SELECT 'vectors', 'label-' || label FROM embeddings)
SELECT tbl, '00' || regexp_extract(space_id, '[0-9]+$', 0) AS space_id, count(*) AS n FROM ids GROUP BY 1, 2""")

sql("ingest_conversation", f"""
SELECT 'conv-' || conv_id AS space_id, turn, {mem_id("'conv-' || conv_id", 'turn')} AS memory_id,
       'text/plain' AS content_type, text AS original_content,
       json_object('role', role, 'turn', turn)::VARCHAR AS metadata, true AS success
FROM conversations""")

# -- parsers ---------------------------------------------------------------------------


def jtrim(x: str) -> str:
    return f"regexp_replace({x}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"


BODIES = """e AS (
  SELECT vec_id, vec_id::VARCHAR AS i, (label * 10 + vec_id % 7)::VARCHAR AS mem, label::VARCHAR AS lab,
         '0.' || lpad((vec_id % 1000)::VARCHAR, 3, '0') AS score, vec_id % 8 AS v
  FROM embeddings),
pt AS (
  SELECT vec_id AS body_id, v,
    '{"resultSetBoundary":{"resultSetId":"rs-' || i || '"}}' AS B,
    '{"memoryDefinition":{"memoryId":"' || mem || '","spaceId":"label-' || lab || '"}}' AS M,
    '{"retrievedItem":{"chunk":{"chunk":{"chunkId":"' || i || '","chunkText":"text ' || i
      || '","memoryId":"' || mem || '"},"relevanceScore":' || score || ',"memoryIndex":0}}}' AS I,
    '{"abstractReply":{"text":"summary ' || i || '"}}' AS A,
    '{"abstractReply":{"text":"final ' || i || '"}}' AS A2,
    '{"resultSetBoundary":{"resultSetId":"rs2-' || i || '"}}' AS B2,
    '{"retrievedItem":{"chunk":{"chunk":{"chunkId":"x' || i
      || '"}}},"resultSetBoundary":{"resultSetId":"multi-' || i || '"}}' AS multi,
    '{"retrievedItem":{"chunk":{"chunk":{"chunkId":"' || i || '","chunkText":"t","memoryId":"'
      || mem || '"}}}}' AS bare
  FROM e),
bodies AS (
  SELECT body_id, CASE v
    WHEN 0 THEN concat_ws(chr(10), B, M, I)
    WHEN 1 THEN concat_ws(chr(13) || chr(10), B, M, I)
    WHEN 2 THEN concat_ws(chr(10), 'event: message', 'data: ' || B, '', 'data: ' || M, 'data:' || I,
                          'data: event: x')
    WHEN 3 THEN concat_ws(chr(10), B, '{"retrievedItem":', '[1,2]', '42', I, 'not json')
    WHEN 4 THEN concat_ws(chr(10), B, multi, I)
    WHEN 5 THEN concat_ws(chr(10), B, '{"resultSetBoundary":null}', '{"retrievedItem":{}}',
                          '{"memoryDefinition":null}', I)
    WHEN 6 THEN concat_ws(chr(10), B, '{"resultSetBoundary":{}}', A, I, A2)
    ELSE B || chr(10) || bare || chr(10) || B2 || chr(10) END AS body
  FROM pt)"""

PARSED = f"""l0 AS (
  SELECT body_id, unnest(string_split(body, chr(10))) AS raw,
         generate_subscripts(string_split(body, chr(10)), 1) AS line_no
  FROM bodies),
l1 AS (SELECT body_id, line_no, {jtrim('raw')} AS t FROM l0),
l2 AS (SELECT body_id, line_no,
              CASE WHEN starts_with(t, 'data:') THEN {jtrim('substr(t, 6)')} ELSE t END AS j FROM l1),
l3 AS (SELECT * FROM l2 WHERE j <> '' AND NOT starts_with(j, 'event:')
                           AND json_valid(j) AND json_type(j) = 'OBJECT'),
l4 AS (SELECT *, CASE WHEN json_exists(j, '$.resultSetBoundary') THEN 'boundary'
                      WHEN json_exists(j, '$.memoryDefinition') THEN 'memory'
                      WHEN json_exists(j, '$.abstractReply') THEN 'abstract'
                      WHEN json_exists(j, '$.retrievedItem') THEN 'item' END AS kind FROM l3),
l5 AS (SELECT *, CASE kind WHEN 'boundary' THEN json_extract(j, '$.resultSetBoundary')
                           WHEN 'memory' THEN json_extract(j, '$.memoryDefinition')
                           WHEN 'abstract' THEN json_extract(j, '$.abstractReply')
                           WHEN 'item' THEN json_extract(j, '$.retrievedItem') END AS x
       FROM l4 WHERE kind IS NOT NULL),
l6 AS (SELECT *, json_extract(x, '$.chunk') AS ch, json_extract(x, '$.chunk.chunk') AS inner_
       FROM l5 WHERE json_type(x) = 'OBJECT'),
parsed AS (
  SELECT body_id, line_no::INTEGER AS line_no, kind,
         CASE WHEN kind = 'boundary' THEN json_extract_string(x, '$.resultSetId') END AS result_set_id,
         CASE WHEN kind = 'item' THEN coalesce(json_extract_string(inner_, '$.chunkId'), '') END AS chunk_id,
         CASE WHEN kind = 'item' THEN coalesce(json_extract_string(inner_, '$.chunkText'), '') END AS chunk_text,
         CASE WHEN kind = 'item' THEN coalesce(json_extract_string(inner_, '$.memoryId'), '') END AS memory_id,
         CASE WHEN kind = 'item' THEN json_extract(ch, '$.relevanceScore')::DOUBLE END AS relevance_score,
         CASE WHEN kind = 'item' THEN json_extract(ch, '$.memoryIndex')::INTEGER END AS memory_index,
         CASE WHEN kind = 'memory' THEN x::VARCHAR END AS memory_definition,
         CASE WHEN kind = 'abstract' THEN x::VARCHAR END AS abstract_reply
  FROM l6
  WHERE kind <> 'item' OR ((ch IS NULL OR json_type(ch) = 'OBJECT')
                           AND (inner_ IS NULL OR json_type(inner_) = 'OBJECT')))"""

sql("parse_retrieval_stream", f"""WITH {BODIES},
{PARSED}
SELECT * FROM parsed""")

sql("collect_result_set", f"""WITH {BODIES},
{PARSED},
g AS (
  SELECT body_id,
         arg_max(result_set_id, line_no) FILTER (WHERE result_set_id IS NOT NULL) AS rs,
         count(*) FILTER (WHERE kind = 'item') AS total_results,
         count(*) FILTER (WHERE kind = 'memory') AS total_memories,
         string_agg(chunk_id, ',' ORDER BY line_no) FILTER (WHERE kind = 'item') AS chunk_ids,
         string_agg(coalesce(relevance_score::VARCHAR, '-'), ',' ORDER BY line_no)
           FILTER (WHERE kind = 'item') AS scores,
         arg_max(abstract_reply, line_no) FILTER (WHERE abstract_reply IS NOT NULL) AS abstract_reply
  FROM parsed GROUP BY body_id)
SELECT b.body_id, coalesce(g.rs, '') AS result_set_id, coalesce(g.total_results, 0) AS total_results,
       coalesce(g.total_memories, 0) AS total_memories, coalesce(g.chunk_ids, '') AS chunk_ids,
       coalesce(g.scores, '') AS scores, g.abstract_reply
FROM bodies b LEFT JOIN g ON g.body_id = b.body_id""")

sql("normalize_list_response", f"""{with_(MEM)},
lb AS (
  SELECT memory_id AS body_id, CASE memory_id % 5
    WHEN 0 THEN '[{{"memoryId":"' || memory_id || '"}},7,{{"memoryId":"' || memory_id || '-b"}}]'
    WHEN 1 THEN '{{"memories":[{{"memoryId":"' || memory_id || '","status":"'
                || coalesce(processing_status, 'PENDING') || '"}}],"nextToken":null}}'
    WHEN 2 THEN '{{"items":[{{"memoryId":"' || memory_id || '"}}]}}'
    WHEN 3 THEN '42'
    ELSE '[1,"x",null,{{"memoryId":"' || memory_id || '"}}]' END AS body
  FROM mem),
arr AS (
  SELECT body_id, CASE WHEN json_type(body) = 'ARRAY' THEN json_extract(body, '$[*]')
                       WHEN json_type(body) = 'OBJECT' AND json_type(body, '$.memories') = 'ARRAY'
                         THEN json_extract(body, '$.memories[*]') END AS a
  FROM lb WHERE json_valid(body)),
el AS (SELECT body_id, unnest(a) AS e, generate_subscripts(a, 1) AS position FROM arr WHERE a IS NOT NULL)
SELECT body_id, position::INTEGER AS position, json_extract_string(e, '$.memoryId') AS memory_id,
       e::VARCHAR AS element
FROM el WHERE json_type(e) = 'OBJECT'""")

# -- chunking ---------------------------------------------------------------------------

sql("chunk_none", f"""{with_(MEM)}
SELECT memory_id || '-0' AS chunk_id, memory_id, space_id, 0 AS chunk_index,
       coalesce(original_content, '') AS chunk_text
FROM mem""")

sql("chunk_fixed", f"""{with_(MEM)},
w AS (SELECT memory_id, space_id, coalesce(original_content, '') AS t,
             unnest(range(0, greatest(length(coalesce(original_content, '')) - 50, 1), 462)) AS s
      FROM mem)
SELECT memory_id || '-' || (s // 462) AS chunk_id, memory_id, space_id, (s // 462)::INTEGER AS chunk_index,
       substring(t, s + 1, 512) AS chunk_text
FROM w""")

_SENT = r"[.!?]*[^.!?]+[.!?]*[ \t\n\x0B\f\r]*|[.!?]+[ \t\n\x0B\f\r]*"


def _windows(x: str, size: int | str, ov: int | str) -> str:
    return (f"list_transform(range(0, greatest(length({x}) - {ov}, 1), ({size} - {ov})), "
            f"lambda i: substring({x}, i + 1, {size}))")


def pack_sql(size: int, ov: int) -> str:
    carry = (f"(list_reduce(list_reverse(acc.tail), lambda c, x: CASE "
             f"WHEN c.open AND c.n + length(x) <= least({ov}, {size} - length(s)) "
             f"THEN {{'arr': list_prepend(x, c.arr), 'n': c.n + length(x), 'open': true}} "
             f"ELSE {{'arr': c.arr, 'n': c.n, 'open': false}} END, "
             f"{{'arr': []::VARCHAR[], 'n': 0, 'open': true}})).arr")
    step = (f"lambda acc, s: CASE "
            f"WHEN length(s) > {size} THEN {{'done': list_concat(CASE WHEN acc.cur <> '' "
            f"THEN list_append(acc.done, acc.cur) ELSE acc.done END, {_windows('s', size, ov)}), "
            f"'cur': '', 'tail': []::VARCHAR[]}} "
            f"WHEN acc.cur = '' THEN {{'done': acc.done, 'cur': s, 'tail': [s]}} "
            f"WHEN length(acc.cur) + length(s) <= {size} THEN {{'done': acc.done, 'cur': acc.cur || s, "
            f"'tail': list_append(acc.tail, s)}} "
            f"ELSE {{'done': list_append(acc.done, acc.cur), 'cur': array_to_string({carry}, '') || s, "
            f"'tail': list_append({carry}, s)}} END")
    init = "{'done': []::VARCHAR[], 'cur': '', 'tail': []::VARCHAR[]}"
    return (f"list_reduce(regexp_extract_all(coalesce(original_content, ''), '{_SENT}'), {step}, {init})")


sql("chunk_sentence", f"""{with_(MEM)},
r AS (SELECT memory_id, space_id, {pack_sql(512, 50)} AS acc FROM mem),
o AS (SELECT memory_id, space_id,
             CASE WHEN acc.cur <> '' THEN list_append(acc.done, acc.cur) ELSE acc.done END AS out FROM r),
o2 AS (SELECT memory_id, space_id, CASE WHEN len(out) = 0 THEN [''] ELSE out END AS out FROM o),
u AS (SELECT memory_id, space_id, unnest(out) AS chunk_text, generate_subscripts(out, 1) - 1 AS i FROM o2)
SELECT memory_id || '-' || i AS chunk_id, memory_id, space_id, i::INTEGER AS chunk_index, chunk_text FROM u""")

# -- streaming ------------------------------------------------------------------------

sql("stream_index_memories", """
SELECT d.doc_id AS memory_id,
       CASE WHEN coalesce(d.text, '') <> '' THEN 'COMPLETED' ELSE 'FAILED' END AS processing_status,
       CASE WHEN coalesce(d.text, '') <> '' THEN len(range(0, greatest(length(d.text) - 50, 1), 462))
            ELSE 0 END AS n_chunks
FROM documents d JOIN events e ON e.event_id = d.doc_id""")

sql("indexing_freshness", f"""{with_(MEM)}
SELECT space_id, coalesce(processing_status, 'PENDING') AS processing_status, count(*) AS n_memories,
       coalesce(processing_status, 'PENDING') IN ('PENDING', 'PROCESSING') AS unfinished
FROM mem GROUP BY 1, 2""")

sql("wait_for_indexing", f"""{with_(MEM, CV)},
e2 AS (SELECT e.vec_id AS query_id,
              CASE WHEN e.vec_id % 2 = 0 THEN d.source
                   ELSE 'label-' || e.label || ', label-' || ((e.label + 1) % 10) || ',,label-' || e.label
              END AS space_ids
       FROM embeddings e LEFT JOIN documents d ON d.doc_id = e.vec_id),
qs2 AS (SELECT DISTINCT query_id, trim(s) AS space_id
        FROM e2, unnest(string_split(space_ids, ',')) AS t(s) WHERE trim(s) <> ''),
cnt AS (SELECT space_id, count(*) AS n FROM cv GROUP BY 1),
busy AS (SELECT DISTINCT space_id FROM mem
         WHERE coalesce(processing_status, 'PENDING') IN ('PENDING', 'PROCESSING')),
per AS (SELECT q.query_id, least(5, coalesce(sum(c.n), 0))::BIGINT AS total_results,
               bool_or(b.space_id IS NOT NULL) AS busy
        FROM qs2 q LEFT JOIN cnt c ON c.space_id = q.space_id LEFT JOIN busy b ON b.space_id = q.space_id
        GROUP BY 1)
SELECT e2.query_id, coalesce(per.total_results, 0) AS total_results,
       CASE WHEN coalesce(per.total_results, 0) = 0 AND per.busy
            THEN 'No results found after waiting 10 seconds for indexing. Memories may still be processing.'
       END AS message
FROM e2 LEFT JOIN per ON per.query_id = e2.query_id""")

# -- hashed embeddings (hash-256: MD5 word buckets, L2-normalised counts) ----------------


def emb_ctes(src: str, text: str, keep: str, name: str, dim: str = "256") -> str:
    """CTEs ``{name}_b`` .. ``{name}``: the hash-256 vector ``emb`` of column
    ``text`` of ``src``, keeping columns ``keep``."""
    toks = f"list_filter(regexp_split_to_array(lower(coalesce({text}, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> '')"
    return f"""{name}_b AS (
  SELECT {keep}, list_transform({toks}, lambda t: (('0x' || substr(md5(t), 1, 8))::BIGINT % {dim})::INTEGER) AS bk
  FROM {src}),
{name}_c AS (
  SELECT {keep}, len(bk) AS n_terms,
         list_transform(range({dim}), lambda b: len(list_filter(bk, lambda x: x = b))) AS cnt
  FROM {name}_b),
{name}_n AS (SELECT *, sqrt(list_sum(list_transform(cnt, lambda c: c * c))) AS nrm FROM {name}_c),
{name} AS (
  SELECT {keep}, n_terms,
         list_transform(cnt, lambda c: CASE WHEN nrm > 0 THEN c / nrm ELSE 0.0 END)::FLOAT[] AS emb,
         nrm > 0 AS has_words
  FROM {name}_n)"""


FIXED_CHUNKS = f"""{MEM},
fw AS (SELECT memory_id, space_id, coalesce(original_content, '') AS t,
              unnest(range(0, greatest(length(coalesce(original_content, '')) - 50, 1), 462)) AS s
       FROM mem),
fc AS (SELECT memory_id || '-' || (s // 462) AS chunk_id, memory_id, space_id,
              substring(t, s + 1, 512) AS chunk_text FROM fw)"""

sql("embed_chunks", f"""WITH {FIXED_CHUNKS},
{emb_ctes('fc', 'chunk_text', 'chunk_id, memory_id, space_id', 'ce')}
SELECT chunk_id, memory_id, space_id, len(emb)::INTEGER AS dim, n_terms::INTEGER AS n_terms,
       len(list_filter(emb, lambda x: x > 0))::INTEGER AS nnz,
       (list_position(emb, list_max(emb)) - 1)::INTEGER AS top_bucket,
       round(list_max(emb)::DOUBLE, 6) AS top_value
FROM ce""")

sql("stream_index_resumed", f"""WITH sends AS (
  SELECT doc_id, n, CASE WHEN n = 3 OR doc_id % 3 <> 0 THEN coalesce(text, '') <> '' ELSE false END AS ok
  FROM documents JOIN events ON event_id = doc_id, range(1, 4) r(n)
  WHERE CASE n WHEN 1 THEN doc_id % 7 <> 0 WHEN 2 THEN doc_id % 7 <> 0 AND doc_id % 2 = 0
             ELSE doc_id % 3 = 0 OR doc_id % 7 = 0 END),
ended AS (SELECT doc_id, min(n) FILTER (WHERE ok) AS done FROM sends GROUP BY doc_id),
tries AS (SELECT doc_id, done, count(*)::INTEGER AS attempt FROM sends JOIN ended USING (doc_id) WHERE n <= coalesce(done, 3) GROUP BY ALL),
{FIXED_CHUNKS},
{emb_ctes('fc', 'chunk_text', 'chunk_id, memory_id, space_id', 'ce')},
per AS (SELECT memory_id, count(*) AS n_vectors, sum(len(list_filter(emb, lambda x: x > 0)))::BIGINT AS nnz,
               sum(round(list_max(emb)::DOUBLE * 1000000)::BIGINT)::BIGINT AS top_millionths FROM ce GROUP BY memory_id)
SELECT doc_id AS memory_id, CASE WHEN done IS NULL THEN 'FAILED' ELSE 'COMPLETED' END AS processing_status,
       CASE WHEN done IS NULL THEN 0 ELSE n_vectors END AS n_chunks, CASE WHEN done IS NULL THEN 'memory has no text' END AS error, attempt,
       CASE WHEN done IS NOT NULL THEN n_vectors END AS n_vectors, CASE WHEN done IS NOT NULL THEN nnz END AS nnz,
       CASE WHEN done IS NOT NULL THEN top_millionths END AS top_millionths
FROM tries LEFT JOIN per ON memory_id = doc_id""")

sql("embed_by_space", f"""WITH {MEM},
ms AS (SELECT memory_id || '-0' AS chunk_id, coalesce(original_content, '') AS t,
              CASE right(space_id, 1) WHEN '9' THEN 'nope' WHEN '0' THEN 'hash-256' WHEN '2' THEN 'hash-256'
                WHEN '4' THEN 'hash-256' WHEN '6' THEN 'hash-256' WHEN '8' THEN 'hash-256' ELSE 'emb-64' END AS embedder_id
       FROM mem),
md AS (SELECT *, CASE embedder_id WHEN 'hash-256' THEN 256 ELSE 64 END AS dim FROM ms),
{emb_ctes('md', 't', 'chunk_id, embedder_id, dim', 'ce', 'dim')}
SELECT chunk_id, embedder_id, embedder_id <> 'nope' AS success,
       CASE WHEN embedder_id = 'nope' THEN 'Unknown embedder: nope' END AS error,
       CASE WHEN embedder_id <> 'nope' THEN array_to_string(
         list_transform(emb, lambda x: round(x::DOUBLE * 1000000)::BIGINT::VARCHAR), ',') END AS vector
FROM ce""")

sql("retrieve_text", f"""WITH {FIXED_CHUNKS},
{emb_ctes('fc', 'chunk_text', 'chunk_id, memory_id, space_id', 'ce')},
{emb_ctes('benchmark', 'text', 'item_id', 'qe')},
scored AS (
  SELECT qe.item_id AS query_id, ce.chunk_id, ce.memory_id, ce.space_id,
         round(list_cosine_similarity(qe.emb::DOUBLE[], ce.emb::DOUBLE[]), 6) AS score
  FROM qe, ce WHERE qe.has_words AND ce.has_words),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank
           FROM scored)
SELECT query_id, rank::INTEGER AS rank, chunk_id, memory_id, space_id, score FROM ranked WHERE rank <= 5""")

sql("conversation_search", f"""WITH
cm AS (SELECT 'conv-' || conv_id AS space_id, turn, role, text,
              {mem_id("'conv-' || conv_id", 'turn')} AS memory_id,
              TIMESTAMP '2024-01-01 00:00:00' + to_seconds(turn) AS created_at
       FROM conversations WHERE text IS NOT NULL AND text <> ''),
{emb_ctes('cm', 'text', 'memory_id, space_id, role, created_at', 'ce')},
scored AS (
  SELECT q.memory_id AS query_id, c.memory_id || '-0' AS chunk_id, c.memory_id, c.created_at,
         round(list_cosine_similarity(q.emb::DOUBLE[], c.emb::DOUBLE[]), 6) AS score
  FROM ce q JOIN ce c ON c.space_id = q.space_id
  WHERE q.role = 'user' AND q.has_words AND c.has_words),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS r
                       FROM scored) WHERE r <= 5),
fin AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY created_at, chunk_id) AS rank FROM top),
mi AS (SELECT *, min(rank) OVER (PARTITION BY query_id, memory_id) AS first_pos FROM fin)
SELECT query_id, rank::INTEGER AS rank, chunk_id, memory_id, score AS relevance_score,
       (dense_rank() OVER (PARTITION BY query_id ORDER BY first_pos) - 1)::INTEGER AS memory_index,
       count(*) OVER (PARTITION BY query_id) AS total_results, created_at
FROM mi""")

# -- recursive chunking: paragraphs -> lines -> words -> character windows ---------------

_LEVELS = (r"(?s).+?(?:\n\n+|\z)", r"(?s).+?(?:\n+|\z)", r"(?s).+?(?: +|\z)")


def _pack_units_sql(units: str, size: int, ov: int, too_long, lvl: int) -> str:
    """DuckDB list of chunks packed from ``units`` (lambda names per level)."""
    acc, s, c, x, r = f"acc{lvl}", f"s{lvl}", f"c{lvl}", f"x{lvl}", f"r{lvl}"
    carry = (f"(list_reduce(list_reverse({acc}.tail), lambda {c}, {x}: CASE "
             f"WHEN {c}.open AND {c}.n + length({x}) <= least({ov}, {size} - length({s})) "
             f"THEN {{'arr': list_prepend({x}, {c}.arr), 'n': {c}.n + length({x}), 'open': true}} "
             f"ELSE {{'arr': {c}.arr, 'n': {c}.n, 'open': false}} END, "
             f"{{'arr': []::VARCHAR[], 'n': 0, 'open': true}})).arr")
    step = (f"lambda {acc}, {s}: CASE "
            f"WHEN length({s}) > {size} THEN {{'done': list_concat(CASE WHEN {acc}.cur <> '' "
            f"THEN list_append({acc}.done, {acc}.cur) ELSE {acc}.done END, {too_long(s)}), "
            f"'cur': '', 'tail': []::VARCHAR[]}} "
            f"WHEN {acc}.cur = '' THEN {{'done': {acc}.done, 'cur': {s}, 'tail': [{s}]}} "
            f"WHEN length({acc}.cur) + length({s}) <= {size} THEN {{'done': {acc}.done, "
            f"'cur': {acc}.cur || {s}, 'tail': list_append({acc}.tail, {s})}} "
            f"ELSE {{'done': list_append({acc}.done, {acc}.cur), 'cur': array_to_string({carry}, '') || {s}, "
            f"'tail': list_append({carry}, {s})}} END")
    init = "{'done': []::VARCHAR[], 'cur': '', 'tail': []::VARCHAR[]}"
    red = f"list_reduce({units}, {step}, {init})"
    return (f"list_transform([{red}], lambda {r}: CASE WHEN {r}.cur <> '' "
            f"THEN list_append({r}.done, {r}.cur) ELSE {r}.done END)[1]")


def _recursive_sql(text: str, size: int, ov: int, lvl: int = 0) -> str:
    if lvl == len(_LEVELS):
        return _windows(text, size, ov)
    units = f"regexp_extract_all({text}, '{_LEVELS[lvl]}')"
    return _pack_units_sql(units, size, ov, lambda s: _recursive_sql(s, size, ov, lvl + 1), lvl)


sql("chunk_recursive", f"""{with_(MEM)},
o AS (SELECT memory_id, space_id, {_recursive_sql("coalesce(original_content, '')", 512, 50)} AS out FROM mem),
o2 AS (SELECT memory_id, space_id, CASE WHEN len(out) = 0 THEN [''] ELSE out END AS out FROM o),
u AS (SELECT memory_id, space_id, unnest(out) AS chunk_text, generate_subscripts(out, 1) - 1 AS i FROM o2)
SELECT memory_id || '-' || i AS chunk_id, memory_id, space_id, i::INTEGER AS chunk_index, chunk_text FROM u""")

# sizes and strategies as columns: space n of 60 has its own, the last one is missing
_T = "coalesce(original_content, '')"
sql("chunk_by_config", f"""WITH cm AS (
  SELECT memory_id, original_content, CASE WHEN n < 59 THEN n ELSE -1 END AS n, space_id || '-' || memory_id % 3 AS space_id
  FROM (SELECT doc_id AS memory_id, text AS original_content, source AS space_id,
               (regexp_extract(source, '[0-9]+$')::INTEGER * 3 + doc_id % 3)::INTEGER AS n
        FROM documents JOIN events ON event_id = doc_id)),
cc AS (SELECT *, CASE WHEN n < 0 THEN 512 ELSE 300 + 8 * n END AS sz, CASE WHEN n < 0 THEN 50 ELSE n % 16 END AS ov FROM cm),
o AS (SELECT memory_id, space_id, CASE WHEN n % 4 = 0 THEN [{_T}]
        WHEN n % 4 = 1 THEN {_windows(_T, 'sz', 'ov')}
        WHEN n % 4 = 2 THEN {_pack_units_sql(f"regexp_extract_all({_T}, '{_SENT}')", 'sz', 'ov', lambda x: _windows(x, 'sz', 'ov'), 0)}
        ELSE {_recursive_sql(_T, 'sz', 'ov')} END AS out FROM cc),
o2 AS (SELECT memory_id, space_id, CASE WHEN len(out) = 0 THEN [''] ELSE out END AS out FROM o),
u AS (SELECT memory_id, space_id, unnest(out) AS chunk_text, generate_subscripts(out, 1) - 1 AS i FROM o2)
SELECT memory_id || '-' || i AS chunk_id, memory_id, space_id, i::INTEGER AS chunk_index, chunk_text FROM u""")

PAGE_FILES = """pf AS (SELECT page_id // 20 AS f, string_agg(coalesce(html, '') || chr(10), '' ORDER BY page_id) AS content FROM pages GROUP BY 1)"""

sql("ingest_files_from_disk", f"""WITH {PAGE_FILES}
SELECT f AS file, 'text/plain' AS content_type, content AS original_content, strlen(content)::BIGINT AS length, true AS success FROM pf""")

sql("stream_ingest_files", f"""WITH {PAGE_FILES}
SELECT 'file-' || f AS memory_id, 'COMPLETED' AS processing_status, len(range(0, greatest(length(content) - 50, 1), 462)) AS n_chunks, 1 AS attempt FROM pf""")
