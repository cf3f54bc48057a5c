"""String adapters with T-SQL semantics, built from Spark built-ins.

All of these are ``Column -> Column`` and stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from relprep.fixed import PASSWORD_TOKEN_LENGTH


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def concat_strict(*parts: Column | str) -> Column:
    """``a + b`` concatenation: any NULL part makes the result NULL (STR-1).

    Plain strings are literals; use ``F.col`` for column references.
    """
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def tsql_len(c: Column | str) -> Column:
    """LEN(s): character count ignoring trailing spaces (STR-6)."""
    return F.length(F.rtrim(_c(c)))


def left(c: Column | str, n: int) -> Column:
    """LEFT(s, n); numbers are converted to their decimal text first (STR-2)."""
    return F.left(_c(c).cast("string"), F.lit(n))


def right(c: Column | str, n: int) -> Column:
    """RIGHT(s, n) (STR-3)."""
    return F.right(_c(c).cast("string"), F.lit(n))


def tsql_substring(c: Column | str, start: int, length: int) -> Column:
    """SUBSTRING(s, start, length) with T-SQL positions (STR-4, STR-5).

    Positions before 1 consume length without producing characters, so
    ``SUBSTRING(s, 0, 100)`` returns 99 characters.
    """
    if start < 1:
        length = length - (1 - start)
        start = 1
    if length <= 0:
        return F.when(_c(c).isNotNull(), F.lit(""))
    return F.substring(_c(c), start, length)


def nvarchar(c: Column | str, n: int) -> Column:
    """CONVERT(NVARCHAR(n), s): cast to text and cut to n characters (STR-13)."""
    return F.substring(_c(c).cast("string"), 1, n)


def charindex(sub: str, c: Column | str) -> Column:
    """CHARINDEX(sub, s): 1-based position, 0 when absent (STR-10)."""
    return F.instr(_c(c), sub)


def first_word(c: Column | str) -> Column:
    """Text before the first space, or the whole string (STR-11)."""
    return F.substring_index(_c(c), " ", 1)


def web_address(c: Column | str) -> Column:
    """``www.<first word>.com`` (UPD-9)."""
    return F.concat(F.lit("www."), first_word(c), F.lit(".com"))


def date_text(c: Column | str) -> Column:
    """CONVERT(NVARCHAR, date): ``yyyy-MM-dd`` (STR-14)."""
    return F.date_format(_c(c).cast("date"), "yyyy-MM-dd")


def _key_text(*keys: Column | str, salt: str) -> Column:
    """``length:value|`` for each key (``-|`` for NULL), then the salt."""
    parts = []
    for k in keys:
        text = _c(k).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
        parts.append(F.lit("|"))
    return F.concat(*parts, F.lit(salt))


def keyed_guid(*keys: Column | str, salt: str) -> Column:
    """A GUID-shaped token that is a pure function of (keys, salt) (STR-12).

    NEWID() is random; a random column is recomputed differently whenever
    a task is retried or a plan is read twice.  The keyed form gives the
    same shape (8-4-4-4-12 upper-case hex) and is reproducible, so retries
    after executor loss give identical rows.  Pass keys that name the row:
    each key enters with its length, and NULL has a sign of its own, so no
    two key lists share a token by the way they are joined.
    """
    guid = F.upper(F.md5(_key_text(*keys, salt=salt)))
    # Insert the four dashes back to front with zero-length overlays, so the
    # hash appears once in the expression tree: subexpression elimination
    # does not share work inside a CASE branch, and five substrings of the
    # same md5 would hash five times.
    for pos in (21, 17, 13, 9):
        guid = F.overlay(guid, F.lit("-"), pos, 0)
    return guid


def keyed_token(*keys: Column | str, salt: str, length: int) -> Column:
    """LEFT(NEWID(), length) in keyed form (STR-12)."""
    return F.left(keyed_guid(*keys, salt=salt), F.lit(length))


def password_token(*keys: Column | str, salt: str, length: int = PASSWORD_TOKEN_LENGTH) -> Column:
    """REPLACE(LOWER(LEFT(NEWID(), n)), '-', 7) in keyed form (STR-7, STR-8)."""
    return F.replace(F.lower(keyed_token(*keys, salt=salt, length=length)), F.lit("-"), F.lit("7"))


def shuffle_key(*keys: Column | str, salt: str) -> Column:
    """Sort key for a reproducible random row order (SRT-3)."""
    return F.md5(_key_text(*keys, salt=salt))


def without_first(c: Column | str, n: int) -> Column:
    """The value without its first ``n`` characters (the card option of the task sheet)."""
    return F.substr(_c(c), F.lit(n + 1))


def without_trailing(c: Column | str, chars: str) -> Column:
    """The value without trailing ``chars`` (the password option of the task sheet)."""
    return F.rtrim(_c(c), F.lit(chars))


def digits_only(c: Column | str) -> Column:
    """Keep only the digits (option for counting phone digits)."""
    return F.regexp_replace(_c(c), "[^0-9]", "")
