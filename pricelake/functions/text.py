"""Codes, names, path attributes and the list-or-scalar JSON leaf."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.functions.padding import padded

# A JSON string value that itself begins with "[" gets this mark before parsing, so that
# afterwards a leaf text beginning with "[" can only have been a real list.
_QUOTED_BRACKET = r':(\s*)"\['
_MARK = "\x01\x02"
_MARK_ESCAPED = r"\\u0001\\u0002"


def mark_quoted_brackets(document: Column) -> Column:
    replaced = F.regexp_replace(document, _QUOTED_BRACKET, rf':$1"{_MARK_ESCAPED}[')
    return F.when(document.contains('"['), replaced).otherwise(document)


def first_of_list(leaf: Column) -> Column:
    """Leaf text of a document passed through ``mark_quoted_brackets``: ``[]`` is NULL,
    a list is its first element, anything else is itself."""
    return (
        F.when(leaf.startswith("["), F.get(F.from_json(leaf, "array<string>"), F.lit(0)))
        .when(leaf.startswith(_MARK), F.substring(leaf, len(_MARK) + 1, 2**31 - 1))
        .otherwise(leaf)
    )


def split_name(name: Column) -> tuple[Column, Column]:
    """Item and kind around the first ``/``; no slash gives a NULL kind. Nothing is trimmed."""
    parts = F.split(name, "/", 2)
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))


def market_category(market: Column) -> Column:
    """Text between the first and second dash, trimmed; the whole name when it has no dash."""
    return F.when(market.contains("-"), F.trim(F.split_part(market, F.lit("-"), F.lit(2)))).otherwise(market)


def name_of_code(code: Column, names: Mapping[str, str], default: str) -> Column:
    """Look a code up in a small fixed list; no join, so no shuffle."""
    pairs = [F.lit(part) for pair in names.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code), F.lit(default))


def path_text(path: Column) -> Column:
    """File paths arrive URI-encoded; a literal plus sign must survive the decoding. Most have nothing to decode."""
    return F.when(path.contains("%"), F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)


def path_attribute(path: Column, key: str, missing: str | None = None) -> Column:
    """Value of one ``key=value`` folder of a path, ``missing`` when there is none."""
    after = F.split_part(F.concat(F.lit("/"), path), F.lit(f"/{key}="), F.lit(2))
    plain = F.substring_index(after, "/", 1)
    # An empty folder value may be followed by another folder of that key: only such paths go through the pattern.
    other = F.regexp_extract(path, rf"(?:^|/){key}=([^/]+)", 1)
    found = F.when(path.contains(f"{key}="), F.when(plain != "", plain).otherwise(F.nullif(other, F.lit(""))))
    return F.coalesce(found, F.lit(missing).cast("string"))


def code_columns(df: DataFrame) -> DataFrame:
    """Every ``*_cd`` column as text; NULL stays NULL."""
    return df.withColumns({c: F.col(c).cast("string") for c in df.columns if c.endswith("_cd")})


def pad_codes(df: DataFrame, two_digit: Sequence[str] = ("product_cls_cd", "kind_cd", "rank_cd")) -> DataFrame:
    """Codes as text, with class, kind and rank filled to two digits."""
    return code_columns(df).withColumns({c: padded(F.col(c).cast("string")) for c in two_digit if c in df.columns})
