"""memtables: a Spark-native memory-table engine.

Spaces, memories, chunks and vectors are Parquet-backed DataFrames. Every
operator is a DataFrame -> DataFrame function that answers a whole table of
requests in one Spark job (one request is the one-row case).

Sub-packages:

* ``functions``  Column helpers (Java-compatible trim, UTF-8, base64, JSON
  paths, label maps, vector math, tokens).
* ``sources``    entity tables built from the input tables, ingest of text,
  files and chat turns, sinks.
* ``operators``  catalogue changes, listings, paging, parsers, chunking,
  embedding, retrieval and post-processing, outcome rows.
* ``streaming``  Structured Streaming indexing and freshness.
* ``plans``      the registered end-to-end queries and their SQL oracles.
"""

__version__ = "0.1.0"
