"""Table schemas and fixed values.

Every value that must equal the reference's behaviour is listed once, below,
under "Fixed values". Choices of ours are under "Our choices".
"""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour)
# --------------------------------------------------------------------------

DEFAULT_MAX_RESULTS = 5
DEFAULT_CHUNKING_STRATEGY = "recursive"
DEFAULT_CHUNK_SIZE = 512
DEFAULT_CHUNK_OVERLAP = 50
DEFAULT_INCLUDE_MEMORY_DEFINITION = True
DEFAULT_WAIT_FOR_INDEXING = True
DEFAULT_GET_INCLUDE_CONTENT = True
DEFAULT_LIST_INCLUDE_CONTENT = False
MAX_WAIT_MS = 10_000
POLL_INTERVAL_MS = 2_000

STATUS_PENDING = "PENDING"
STATUS_PROCESSING = "PROCESSING"
STATUS_COMPLETED = "COMPLETED"
STATUS_FAILED = "FAILED"
STATUSES = (STATUS_PENDING, STATUS_PROCESSING, STATUS_COMPLETED, STATUS_FAILED)

STRATEGY_NONE = "none"
STRATEGY_FIXED = "fixed"
STRATEGY_SENTENCE = "sentence"
STRATEGY_RECURSIVE = "recursive"
STRATEGIES = (STRATEGY_NONE, STRATEGY_FIXED, STRATEGY_SENTENCE, STRATEGY_RECURSIVE)

TEXT_CONTENT_TYPE = "text/plain"
OCTET_STREAM = "application/octet-stream"
# file-name suffix (lower case) -> content type, tested in this order
SUFFIX_CONTENT_TYPES = (
    (".pdf", "application/pdf"),
    (".docx", "application/vnd.openxmlformats-officedocument.wordprocessingml.document"),
    (".txt", "text/plain"),
)

MSG_NO_CONTENT = "No content provided. Provide either textContent or filePath."
MSG_NO_SPACE_ID = "At least one valid Space ID is required."
MSG_STILL_PROCESSING = ("No results found after waiting 10 seconds for indexing. "
                        "Memories may still be processing.")
MSG_SPACE_REUSED = "Space already exists, reusing existing space"
MSG_SPACE_CREATED = "Space created successfully"
MSG_SPACE_UPDATED = "Space updated successfully"
MSG_SPACE_DELETED = "Space deleted successfully"
MSG_MEMORY_CREATED = "Memory created successfully"
MSG_MEMORY_DELETED = "Memory deleted successfully"
MSG_LABELS_PREFIX = "Labels must be a JSON object of string-to-string pairs, got: "
MSG_CONTENT_PREFIX = "Failed to fetch content: "
MSG_FILE_PREFIX = "Failed to read file: "

# --------------------------------------------------------------------------
# Our choices (the reference leaves these to its server)
# --------------------------------------------------------------------------

# Extra suffixes looked up after the fixed table above (the reference asks the
# operating system first; ours is a fixed table).
EXTRA_CONTENT_TYPES = (
    (".md", "text/markdown"),
    (".html", "text/html"),
    (".htm", "text/html"),
    (".csv", "text/csv"),
    (".json", "application/json"),
    (".png", "image/png"),
    (".jpg", "image/jpeg"),
    (".jpeg", "image/jpeg"),
    (".gif", "image/gif"),
)
PAGE_SIZE_MIN = 1
PAGE_SIZE_MAX = 1000
SCORE_DIGITS = 6                 # scores are rounded to this many digits
MSG_BAD_TOKEN = "Page token cannot be read"
MSG_NO_TEXT = "memory has no text"
MSG_NO_MEMORY_ID = "memory has no id"
MSG_NOT_EMBEDDED = "the embedder gave no vector"
MSG_NO_QUERY_VECTOR = "The request has no usable query vector"
MSG_UNKNOWN_RERANKER = "Unknown reranker: "
MSG_SPACE_NOT_FOUND = "Space not found: "
MSG_MEMORY_NOT_FOUND = "Memory not found: "
MSG_UNKNOWN_STRATEGY = "Unknown chunking strategy: "
MSG_BAD_OVERLAP = "chunk_overlap must be smaller than chunk_size"
MSG_LABELS_EXCLUSIVE = "replace_labels and merge_labels are mutually exclusive"
MSG_BAD_METADATA = "Metadata must be a JSON object, got: "

# --------------------------------------------------------------------------
# Entity schemas
# --------------------------------------------------------------------------

RETRIEVAL_REQUESTS = T.StructType([
    T.StructField("query_id", T.LongType(), False),
    T.StructField("query_vector", T.ArrayType(T.FloatType())),
    T.StructField("query_text", T.StringType()),
    T.StructField("space_ids", T.StringType()),
    T.StructField("max_results", T.IntegerType()),
    T.StructField("relevance_threshold", T.DoubleType()),
    T.StructField("reranker_id", T.StringType()),
    T.StructField("llm_id", T.StringType()),
    T.StructField("llm_temperature", T.DoubleType()),
    T.StructField("chronological_resort", T.BooleanType()),
])
