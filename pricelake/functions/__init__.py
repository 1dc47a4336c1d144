"""Column expressions: every function takes and returns a Spark Column (or a frame of them)."""

from pricelake.functions.dates import add_date_features, compact_date, date_from_parts, try_iso_date
from pricelake.functions.numbers import clean_price, normalize_price
from pricelake.functions.padding import padded, strip
from pricelake.functions.text import (
    code_columns,
    first_of_list,
    market_category,
    name_of_code,
    pad_codes,
    path_attribute,
    path_text,
    split_name,
)

__all__ = [
    "add_date_features",
    "clean_price",
    "code_columns",
    "compact_date",
    "date_from_parts",
    "first_of_list",
    "market_category",
    "name_of_code",
    "normalize_price",
    "pad_codes",
    "padded",
    "path_attribute",
    "path_text",
    "split_name",
    "strip",
    "try_iso_date",
]
