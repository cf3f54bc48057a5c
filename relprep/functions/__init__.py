"""Column -> Column adapters: money, text, dates and predicates."""

from relprep.functions import dates, money, predicates, text

__all__ = ["dates", "money", "predicates", "text"]
