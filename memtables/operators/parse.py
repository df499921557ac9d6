"""Parsers of response bodies (ops 8-10): result streams (NDJSON / SSE lines)
and list responses. Space-key parsing (21) lives with retrieval, label parsing
(27) with the catalogue.

All parsing is built-in SQL: the lines of a body are parsed as an array inside
the body's row (higher-order functions, VARIANT for JSON), so folding a body
into its result set needs no explode, regroup or shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from memtables.functions.json import strict_parse_json
from memtables.functions.text import java_trim

# first present key wins, in this order
STREAM_KEYS = (("boundary", "resultSetBoundary"), ("memory", "memoryDefinition"),
               ("abstract", "abstractReply"), ("item", "retrievedItem"))


def _is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def _get(v: Column, path: str, type_: str = "variant") -> Column:
    return F.try_variant_get(v, path, type_)


# -- 8 parse_retrieval_stream -------------------------------------------------------

def _bind(value: Column, fn) -> Column:
    """Evaluate ``value`` once and hand it to ``fn`` as a lambda variable
    (expressions referenced twice inside higher-order functions would
    otherwise be evaluated twice)."""
    return F.transform(F.array(value), fn)[0]


_LINE_FIELDS = ("line_no", "kind", "result_set_id", "chunk_id", "chunk_text", "memory_id",
                "relevance_score", "memory_index", "memory_definition", "abstract_reply")


def _parse_line(line: Column, pos: Column) -> Column:
    """One body line -> struct of the typed fields plus ``keep`` (false for
    skipped lines). Rules as in the stream format: Java trim, one ``data:``
    cut, ``event:`` / empty skipped, whole-object JSON only, first present key
    wins, its value (and an item's chunks) must be objects."""
    def on_text(t: Column) -> Column:
        def on_json(j: Column) -> Column:
            text_ok = (j != "") & ~j.startswith("event:")

            def on_variant(v: Column) -> Column:
                keys = F.struct(*[_get(v, f"$.{key}").alias(name) for name, key in STREAM_KEYS])

                def on_keys(ks: Column) -> Column:
                    kind = F.lit(None).cast("string")
                    for name, _ in reversed(STREAM_KEYS):
                        kind = F.when(ks[name].isNotNull(), F.lit(name)).otherwise(kind)
                    x = F.coalesce(*[ks[name] for name, _ in STREAM_KEYS])
                    parts = F.struct(kind.alias("kind"), x.alias("x"), _get(x, "$.chunk").alias("chunk"),
                                     _get(x, "$.chunk.chunk").alias("inner"))

                    def on_parts(p: Column) -> Column:
                        k, xx, chunk, inner = p["kind"], p["x"], p["chunk"], p["inner"]
                        is_item = k == "item"
                        item_ok = (chunk.isNull() | _is_object(chunk)) & (inner.isNull() | _is_object(inner))
                        keep = (text_ok & _is_object(v) & k.isNotNull() & _is_object(xx)
                                & (~is_item | item_ok))

                        def item_str(field: str) -> Column:
                            return F.when(is_item, F.coalesce(_get(inner, f"$.{field}", "string"), F.lit("")))

                        return F.struct(
                            (pos + 1).alias("line_no"), k.alias("kind"),
                            F.when(k == "boundary", _get(xx, "$.resultSetId", "string")).alias("result_set_id"),
                            item_str("chunkId").alias("chunk_id"),
                            item_str("chunkText").alias("chunk_text"),
                            item_str("memoryId").alias("memory_id"),
                            F.when(is_item, _get(chunk, "$.relevanceScore", "double")).alias("relevance_score"),
                            F.when(is_item, _get(chunk, "$.memoryIndex", "int")).alias("memory_index"),
                            F.when(k == "memory", F.to_json(xx)).alias("memory_definition"),
                            F.when(k == "abstract", F.to_json(xx)).alias("abstract_reply"),
                            F.coalesce(keep, F.lit(False)).alias("keep"))

                    return _bind(parts, on_parts)

                return _bind(keys, on_keys)

            return _bind(F.when(text_ok, strict_parse_json(j)), on_variant)

        return _bind(F.when(t.startswith("data:"), java_trim(F.substring(t, F.lit(6), F.length(t)))).otherwise(t),
                     on_json)

    return _bind(java_trim(line), on_text)


def parsed_lines(body: Column) -> Column:
    """Body -> array of the understood lines (structs, in line order). The
    lines never leave their row: no explode and regroup is needed to fold a
    body into its result set."""
    lines = F.transform(F.split(F.coalesce(body, F.lit("")), "\n"), lambda l, i: _parse_line(l, i))
    return F.transform(F.filter(lines, lambda x: x["keep"]),
                       lambda x: F.struct(*[x[f].alias(f) for f in _LINE_FIELDS]))


def parse_retrieval_stream(bodies: DataFrame, body_col: str = "body", id_col: str = "body_id") -> DataFrame:
    """Typed rows, one per understood line: ``body_id, line_no, kind,
    result_set_id, chunk_id, chunk_text, memory_id, relevance_score,
    memory_index, memory_definition, abstract_reply``.

    Unparseable lines, non-objects, lines whose winning key holds a non-object,
    and unknown keys are skipped. An item without its inner chunk is kept with
    empty strings; score and index stay null when absent.
    """
    return bodies.select(F.col(id_col).alias("body_id"),
                         F.inline(parsed_lines(F.col(body_col))))


# -- 9 collect_result_set -------------------------------------------------------------

def _last(arr: Column, field: str) -> Column:
    vals = F.filter(F.transform(arr, lambda x: x[field]), lambda v: v.isNotNull())
    return F.try_element_at(vals, F.lit(-1))


def collect_result_set(bodies: DataFrame, body_col: str = "body", id_col: str = "body_id") -> DataFrame:
    """One row per body: ``result_set_id`` (last boundary with an id, default
    ''), ``results`` and ``memories`` in line order, last ``abstract_reply``,
    ``total_results``. Folded inside the body's row: no shuffle."""
    def fold(arr: Column) -> Column:
        items = F.filter(arr, lambda x: x["kind"] == "item")
        results = F.transform(items, lambda x: F.struct(
            x["chunk_id"].alias("chunk_id"), x["chunk_text"].alias("chunk_text"),
            x["memory_id"].alias("memory_id"), x["relevance_score"].alias("relevance_score"),
            x["memory_index"].alias("memory_index")))
        mems = F.transform(F.filter(arr, lambda x: x["kind"] == "memory"), lambda x: x["memory_definition"])
        return F.struct(
            F.coalesce(_last(arr, "result_set_id"), F.lit("")).alias("result_set_id"),
            results.alias("results"), mems.alias("memories"),
            _last(arr, "abstract_reply").alias("abstract_reply"),
            F.size(items).cast("long").alias("total_results"))

    folded = _bind(parsed_lines(F.col(body_col)), fold)
    return bodies.select(F.col(id_col).alias("body_id"), folded.alias("_rs")).select("body_id", "_rs.*")


# -- 10 normalize_list_response ---------------------------------------------------------

def normalize_list_response(bodies: DataFrame, array_key: str, body_col: str = "body",
                            id_col: str = "body_id") -> DataFrame:
    """A body that is a bare array, or an object holding ``array_key`` -> one row
    per object element (``body_id, position, element``); non-object elements
    are dropped, any other shape gives no rows."""
    v = strict_parse_json(F.col(body_col))
    kind = F.schema_of_variant(v)
    arr = (F.when(kind.startswith("ARRAY"), _get(v, "$", "array<variant>"))
           .when(kind.startswith("OBJECT"), _get(v, f"$.{array_key}", "array<variant>")))
    rows = bodies.select(F.col(id_col).alias("body_id"), F.posexplode(arr).alias("pos", "e"))
    return rows.where(_is_object(F.col("e"))).select(
        "body_id", (F.col("pos") + 1).alias("position"), F.col("e").alias("element"))
