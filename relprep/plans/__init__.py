"""Check queries over the driver tables, each paired with a DuckDB SQL oracle.

Importing this package registers every check in ``registry.CHECKS``.
"""

from relprep.plans import loaded, loads, quality_checks, reports, rules, sheet_options, staged, streams, titles  # noqa: F401
from relprep.plans.registry import CHECKS

__all__ = ["CHECKS"]
