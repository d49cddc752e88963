"""layerforge: a layered (bronze / silver / gold) warehouse built on Spark DataFrames.

Sub-packages
------------
sources    readers, writers and the test-data stand-ins for the raw CRM/ERP feeds
functions  column-level cleansing rules (pure Column expressions, no UDFs)
operators  table-level operators: dedup, SCD-2, surrogate keys, quality checks,
           run history, lineage closure, profiling and other extras
plans      the layer builds (silver, gold) and the business queries on top
streaming  incremental file ingest into bronze with Structured Streaming
"""

from layerforge.session import build_session, ensure_checkpoint_dir, scratch_dir

__all__ = ["build_session", "ensure_checkpoint_dir", "scratch_dir"]
