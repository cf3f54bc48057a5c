"""Incremental (file-stream) form of the stateless load and rule steps."""

from relprep.streaming.incremental import load_incrementally, run_to_table, table_stream

__all__ = ["load_incrementally", "run_to_table", "table_stream"]
