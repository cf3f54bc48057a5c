"""Source tables, declared layouts and sinks."""

from relprep.sources import sinks, tables

__all__ = ["sinks", "tables"]
