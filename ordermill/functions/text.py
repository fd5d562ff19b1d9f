"""Text clean-up: three notions of "trim", promotion code lists and size ranks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ordermill.schema import SIZES

# U+0000 to U+0020, what a JVM string trim removes.
CONTROL_AND_SPACE = "".join(map(chr, range(0x21)))

# The Unicode white space characters.
UNICODE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def trim_control(col: Column) -> Column:
    """Strip spaces and control characters (tabs, line ends) from both ends."""
    return F.btrim(col, F.lit(CONTROL_AND_SPACE))


def trim_unicode(col: Column) -> Column:
    """Strip any Unicode white space from both ends."""
    return F.btrim(col, F.lit(UNICODE_SPACE))


def present(col: Column) -> Column:
    """True when a text is neither null nor empty."""
    return col.isNotNull() & (col != "")


def code_list(promotion_ids: Column) -> Column:
    """The entries of a comma list as they stand; null for a null list."""
    return F.split(promotion_ids, ",")


def code_name(entry: Column) -> Column:
    """The code in a list entry; null for a blank entry."""
    return F.nullif(F.trim(entry), F.lit(""))


def promo_count(promotion_ids: Column) -> Column:
    """Number of codes in a comma list; 0 for a null or blank list.

    Counts the entries that hold more than spaces and control characters.
    """
    return F.coalesce(F.regexp_count(promotion_ids, F.lit(r"[^,\x00-\x20][^,]*")), F.lit(0))


def size_rank(size: Column) -> Column:
    """Rank of a clothing size from 1 (XS) to 10 (6XL); 0 for any other text."""
    rank = F.array_position(F.array(*map(F.lit, SIZES)), size)
    return F.coalesce(rank, F.lit(0)).cast("int")
