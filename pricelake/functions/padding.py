"""Stripping and zero-filling of texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character the feeds' texts are stripped of: the Unicode spaces and the separators.
STRIPPED = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(STRIPPED))


def padded(value: Column, width: int = 2) -> Column:
    """Left-fill with zeros. Longer values stay whole, which a bare ``lpad`` would cut."""
    return F.when(F.length(value) < width, F.lpad(value, width, "0")).otherwise(value)
