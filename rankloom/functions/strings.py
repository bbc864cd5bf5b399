"""Whitespace handling shared by the other expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space at the ends of a text.
BLANKS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column | str) -> Column:
    """Text without white space at either end (``trim`` alone only takes blanks)."""
    return F.trim(F.col(text) if isinstance(text, str) else text, F.lit(BLANKS))
