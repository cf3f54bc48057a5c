"""DuckDB SQL fragments for the oracle strings (keyed tokens, money casts)."""

from __future__ import annotations

def money(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(19,4))"


def guid(*keys: str, salt: str) -> str:
    """Same value as ``functions.text.keyed_guid`` in DuckDB SQL."""
    h = f"upper({shuffle_key(*keys, salt=salt)})"
    return (
        f"(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-' || substr({h}, 13, 4)"
        f" || '-' || substr({h}, 17, 4) || '-' || substr({h}, 21, 12))"
    )


def token(*keys: str, salt: str, length: int) -> str:
    return f"left({guid(*keys, salt=salt)}, {length})"


def password(*keys: str, salt: str, length: int = 16) -> str:
    return f"replace(lower({token(*keys, salt=salt, length=length)}), '-', '7')"


def shuffle_key(*keys: str, salt: str) -> str:
    parts = [f"coalesce(length(CAST({k} AS VARCHAR)) || ':' || CAST({k} AS VARCHAR), '-') || '|'" for k in keys]
    return f"md5({' || '.join(parts)} || '{salt}')"


def tsql_len(expr: str) -> str:
    return f"CAST(length(rtrim({expr})) AS INTEGER)"


def postcode(key: str) -> str:
    return f"left(md5(CAST({key} AS VARCHAR)), 6)"


def week_case(days: str) -> str:
    """CASE expression labelling a day count with its delivery week."""
    return (
        f"CASE WHEN {days} <= 7 THEN 'Prva' WHEN {days} BETWEEN 8 AND 14 THEN 'Druga' "
        f"WHEN {days} BETWEEN 15 AND 21 THEN 'Treca' WHEN {days} BETWEEN 22 AND 28 THEN 'Cetvrta' END"
    )


def fill_from_key_case(column: str, key: str) -> str:
    """CASE filling NULL ``column`` from the last digits of ``key`` by its first digit."""
    return (
        f"CASE WHEN {column} IS NULL AND left(CAST({key} AS VARCHAR), 1) IN ('4', '5') THEN CAST(right(CAST({key} AS VARCHAR), 3) AS BIGINT) "
        f"WHEN {column} IS NULL AND left(CAST({key} AS VARCHAR), 1) IN ('6', '7') THEN CAST(right(CAST({key} AS VARCHAR), 4) AS BIGINT) "
        f"ELSE {column} END"
    )
