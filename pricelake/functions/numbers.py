"""Price text to double. The cast alone accepts more than a price may be (``1d`` reads as 1.0,
``0x1p3`` as 8.0), so a text is either plainly decimal or must match a pattern."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricelake.functions.padding import STRIPPED, strip

# Fixed patterns: the number formats a price may have.
_INFINITY = r"[+-]?[iI][nN][fF]([iI][nN][iI][tT][yY])?"
_PLAIN = r"[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?"
_DIGITS = r"[0-9]+(_[0-9]+)*"
_GROUPED = rf"[+-]?({_DIGITS}([.]({_DIGITS})?)?|[.]{_DIGITS})([eE][+-]?{_DIGITS})?"


def _decimal_or(text: Column, otherwise: Column) -> Column:
    """The common case without a pattern match: what casts to a finite number, ends in a digit and is not
    hexadecimal is a plain decimal. Everything else goes to ``otherwise``."""
    bare = F.trim(F.replace(text, F.lit(","), F.lit("")))
    ends_in_digit = F.substring(bare, -1, 1).between("0", "9")
    hexadecimal = bare.contains("x") | bare.contains("X")
    # Cast only what can be a number: a cast that fails throws an exception inside, which costs more than all the rest.
    number = F.when(ends_in_digit & ~hexadecimal, bare.try_cast("double"))
    return F.coalesce(F.when(F.abs(number) < float("inf"), number), otherwise)


def normalize_price(text: Column) -> Column:
    """Drop commas and every space, then read a number; NULL when it is none.

    A finite text too large for a double is NULL, an explicit infinity stays one.
    """
    source = text.cast("string")
    bare = F.translate(source, "," + STRIPPED, "")
    number = bare.try_cast("double")
    finite = F.when(bare.rlike(f"^{_PLAIN}$") & (F.abs(number) < float("inf")), number)
    return _decimal_or(source, F.when(bare.rlike(f"^{_INFINITY}$"), number).otherwise(finite))


def clean_price(text: Column) -> Column:
    """Drop commas and outer spaces only; blank, ``-`` and inner spaces are NULL."""
    source = text.cast("string")
    bare = strip(F.replace(source, F.lit(","), F.lit("")))
    number = F.replace(bare, F.lit("_"), F.lit("")).try_cast("double")
    return _decimal_or(source, F.when(bare.rlike(f"^(?:{_GROUPED}|{_INFINITY})$"), number))
