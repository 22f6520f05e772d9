"""tillroll: retail feed -> clean -> star -> marts, as plain Spark DataFrame functions.

Layers
------
- ``sources``   driver tables, raw string feeds derived from them, CSV landing scans
- ``functions`` Column helpers (lenient parsing, recoding, hashing, exact rounding)
- ``operators`` reusable DataFrame operators (quality rules, latest-per-key,
                as-of join, schema conformance, table sinks)
- ``plans``     the datasets users query (clean, star schema, marts, ad-hoc/ops)
- ``streaming`` incremental file ingest with Structured Streaming
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
