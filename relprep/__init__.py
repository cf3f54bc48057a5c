"""relprep: relational data preparation and reporting on Spark DataFrames.

Every operator is a composition of Spark built-ins (no Python UDF in any
hot path), so plans stay inside whole-stage codegen and Catalyst keeps
predicate pushdown, column pruning and join selection.

Layout:
    sources/    typed loads, target layouts and write paths (sinks)
    functions/  Column -> Column adapters: money, text, dates, predicates
    operators/  DataFrame -> DataFrame operators: aggregates, joins, sorts,
                updates/deletes, surrogate keys, search, data quality
    plans/      the check queries over the driver tables and their SQL oracle
    streaming/  incremental (file stream) form of the row-level load steps
"""

from relprep.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
