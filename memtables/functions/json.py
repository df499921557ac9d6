"""JSON / VARIANT helpers: metadata paths, label maps."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from memtables.functions.text import java_trim
from memtables.schema import MSG_LABELS_PREFIX


def val(path: str, type_: str = "string", col: str | Column = "metadata") -> Column:
    """Value at a JSON path of a VARIANT column, as ``type_`` (null when absent
    or not castable). Stands in for the filter language's ``val('$.x')``: the
    caller writes an ordinary Spark predicate, e.g. ``val('$.k', 'int') < 50``.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.try_variant_get(c, path, type_)


def with_path_columns(df: DataFrame, paths: dict[str, tuple[str, str]], col: str = "metadata") -> DataFrame:
    """Adds a typed column for each ``name: (path, type)`` of the VARIANT column ``col``. What it holds
    stands in the column's metadata, which Parquet files keep, so :func:`val_of` finds it again."""
    clash = {n.lower() for n in paths} & {c.lower() for c in df.columns}
    if clash or len({n.lower() for n in paths}) < len(paths):
        raise ValueError(f"column names taken: {sorted(clash) or sorted(paths)}")
    held = lambda path, type_: {PATH_KEY: f"{col} {_type_name(type_)} {path}"}
    return df.select("*", *(val(path, type_, col).alias(name, metadata=held(path, type_)) for name, (path, type_) in paths.items()))


def val_of(df: DataFrame) -> Callable[..., Column]:
    """:func:`val` for the rows of ``df``: a path that has a typed column (:func:`with_path_columns`) is read from
    it, so a comparison reaches the scan and its row-group statistics; any other from the VARIANT."""
    held = {f.metadata[PATH_KEY]: f.name for f in df.schema.fields if PATH_KEY in f.metadata}

    def of(path: str, type_: str = "string", col: str = "metadata") -> Column:
        name = held.get(f"{col} {_type_name(type_)} {path}")
        return val(path, type_, col) if name is None else df[name]
    return of


#: key of a typed path column's metadata
PATH_KEY = "memtables.path"


def _type_name(type_: str) -> str:
    """One name for each type: ``int`` and ``integer`` are the same."""
    return DataType.fromDDL(type_).simpleString()


# One whole JSON value, nothing after it: Spark's JSON parser stops after the
# first value and ignores the rest; a strict reader does not.
_WHOLE_VALUE = (r'(?s)^[\x00-\x20]*(\{.*\}|\[.*\]|".*"|-?[0-9][0-9.eE+-]*|true|false|null)'
                r'[\x00-\x20]*$')


def _whole(text: Column) -> Column:
    """True if the text is one JSON value and nothing more: followed by a mark of its
    own in an array, exactly the value and the mark are read back. A second value, a
    stray bracket or other trailing text ends the array early, breaks it or stands
    where the mark should be."""
    mark = F.md5(F.encode(text, "UTF-8"))
    both = F.from_json(F.concat(F.lit("["), text, F.lit(',"'), mark, F.lit('"]')), "array<string>")
    return text.rlike(_WHOLE_VALUE) & F.coalesce((F.size(both) == 2) & (F.try_element_at(both, F.lit(2)) == mark), F.lit(False))


def strict_parse_json(text: Column) -> Column:
    """VARIANT of a JSON text, null unless the whole text is one JSON value."""
    return F.when(_whole(text), F.try_parse_json(text))


def labels_from_json(text: Column) -> Column:
    """JSON object text -> ``struct<labels map<string,string>, error string>``.

    Null, empty, blank or JSON ``null`` give null labels (meaning: no change).
    Null members are dropped; numbers and booleans keep their JSON text. A
    nested object or array as a value, or any non-object text, gives an error.
    """
    typed = F.try_variant_get(strict_parse_json(text), "$", "map<string,variant>")
    # scalar values as text; VARIANT keeps a number's decimal digits (1.50 stays 1.50)
    as_text = F.transform_values(typed, lambda k, v: F.try_variant_get(v, "$", "string"))
    # duplicate keys make the VARIANT parse fail; the JSON reader keeps the last one
    raw = F.coalesce(as_text, F.when(_whole(text), F.from_json(text, "map<string,string>")))
    nested = F.exists(
        F.map_values(typed),
        lambda x: F.schema_of_variant(x).startswith("OBJECT")
        | F.schema_of_variant(x).startswith("ARRAY"),
    )
    blank = text.isNull() | java_trim(text).isin("", "null")
    error = F.concat(F.lit(MSG_LABELS_PREFIX), text)
    return (
        F.when(blank, F.struct(F.lit(None).cast("map<string,string>").alias("labels"),
                               F.lit(None).cast("string").alias("error")))
        .when(raw.isNull() | F.coalesce(nested, F.lit(False)),
              F.struct(F.lit(None).cast("map<string,string>").alias("labels"),
                       error.alias("error")))
        .otherwise(F.struct(F.map_filter(raw, lambda k, v: v.isNotNull()).alias("labels"),
                            F.lit(None).cast("string").alias("error")))
    )


def merge_labels(old: Column, new: Column) -> Column:
    """Overlay ``new`` on ``old``; the new value wins on a shared key.
    (``map_concat`` raises on duplicate keys, so old keys are filtered first.)"""
    kept = F.map_filter(F.coalesce(old, F.create_map().cast("map<string,string>")),
                        lambda k, v: ~F.map_contains_key(new, k))
    return F.when(new.isNull(), old).otherwise(F.map_concat(kept, new))


def labels_text(m: Column) -> Column:
    """Canonical text of a label map: ``k=v`` pairs sorted by key, ';'-joined.
    Null map -> null."""
    pairs = F.transform(F.array_sort(F.map_entries(m)),
                        lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit(""))))
    return F.when(m.isNotNull(), F.array_join(pairs, ";"))
