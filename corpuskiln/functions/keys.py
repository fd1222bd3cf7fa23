"""Keys, times and names shared by all operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Blanks around a key: ASCII white space, Unicode separators, zero-width space and byte-order mark.
BLANKS = r"[\s\p{Z}\x{200B}\x{FEFF}]+"


def trim_blanks(c: Column) -> Column:
    """Strip Unicode blanks on both sides (``trim`` only strips U+0020)."""
    return F.regexp_replace(c, f"^{BLANKS}|{BLANKS}$", "")


def canonical_key(c: Column) -> Column:
    """A hash or id as it compares: no surrounding blanks, lower case, no leading ``sha256:``; null when nothing is left."""
    bare = F.regexp_replace(F.lower(trim_blanks(c.cast("string"))), r"^sha256:", "")
    bare = trim_blanks(bare)
    return F.when(bare != "", bare)


def instant(c: Column) -> Column:
    """ISO-8601 text (any offset) as a timestamp; null where it cannot be read. Text without offset counts as session time."""
    return F.try_to_timestamp(c.cast("string"))


def utc_month(ts: Column) -> Column:
    """``YYYY-MM`` of an instant in UTC whatever the session's zone is."""
    return F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), "yyyy-MM")


def fresh_name(df: DataFrame, stem: str, *more: DataFrame) -> str:
    """A column name that occurs (in any case) in none of the frames, so helper columns never clash with the caller's."""
    taken = {c.lower() for d in (df, *more) for c in d.columns}
    name, n = f"__{stem}", 0
    while name.lower() in taken:
        n += 1
        name = f"__{stem}_{n}"
    return name
