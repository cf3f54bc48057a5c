"""DataFrame -> DataFrame operators."""

from relprep.operators import aggregates, joins, keys, quality, search, sorting, updates

__all__ = ["aggregates", "joins", "keys", "quality", "search", "sorting", "updates"]
