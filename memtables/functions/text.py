"""String and binary helpers with Java semantics where the reference relies on
them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java's String.trim() removes every char <= U+0020 at both ends; Spark's
# trim() removes only spaces.
_JAVA_WS = r"^[\x00-\x20]+|[\x00-\x20]+$"


def java_trim(c: Column) -> Column:
    return F.regexp_replace(c, _JAVA_WS, "")


def valid_utf8(b: Column) -> Column:
    """Bytes -> string, bad UTF-8 sequences become U+FFFD (never raises)."""
    return F.make_valid_utf8(b.cast("string"))


def base64_flat(b: Column) -> Column:
    """Base64 without line breaks, independent of the session's
    ``spark.sql.chunkBase64String.enabled``."""
    return F.regexp_replace(F.base64(b), r"[\r\n]", "")


def tokens(text: Column) -> Column:
    """Distinct lower-case word tokens (letters and digits)."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.array_distinct(F.filter(parts, lambda x: x != ""))


def sha_id(kind: str, *cols: Column) -> Column:
    """Repeatable id from a natural key: hex SHA-256 of the kind and the parts. Each part stands with its
    length in front and null as ``-``, so different keys never give one text."""
    parts = [F.lit(kind), *(c.cast("string") for c in cols)]
    return F.sha2(F.concat_ws("|", *(F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts)), 256)
