"""Column-level helpers. All are built-in Spark expressions (JVM side, inside
whole-stage codegen); none is a Python UDF."""

from memtables.functions.text import (  # noqa: F401
    java_trim, valid_utf8, base64_flat, tokens, sha_id,
)
from memtables.functions.json import (  # noqa: F401
    val, strict_parse_json, labels_from_json, labels_text, merge_labels,
)
from memtables.functions.vectors import dot, norm, cosine  # noqa: F401
