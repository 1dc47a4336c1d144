"""Polymorphic JSON documents to rows.

Each feed is parsed once with its declared schema. A field that may be an object or a list
is parsed as the usual shape first; the other shape is tried only on documents where that
gave nothing. A document is all or nothing: one bad element rejects the whole document.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.fixed import CATEGORY_LABELS, CATEGORY_PRICES, CODE_NO_DATA, CODE_OK, PRODUCT_FIELDS, REGION_FIELDS
from pricelake.functions import clean_price, date_from_parts, first_of_list, strip
from pricelake.sources.landing import marked, once, parsed

def _record(fields) -> str:
    return "struct<" + ",".join(f"`{f}`:string" for f in fields) + ">"


def with_records(docs: DataFrame, name: str, path: list[str], record: str, only_if: Column | None = None) -> DataFrame:
    """Add the array at ``path`` of each document, where the field holds a list of records or one.

    The parses stand in columns of their own, so each runs once per document, and the second only
    where the first found no list. A parse of the wrong shape throws an exception inside, so a document whose text shows a single
    record is tried as such first. ``only_if`` limits all to some documents.
    """

    def at_path(kind: str) -> Column:
        ddl = kind
        for step in reversed(path):
            ddl = f"struct<`{step}`:{ddl}>"
        found = parsed(F.col("value"), ddl)
        for step in path:
            found = found[step]
        return found

    wanted = F.lit(True) if only_if is None else only_if
    several, one, late = F.col(f"{name}_several"), F.col(f"{name}_one"), F.col(f"{name}_late")
    single = F.coalesce(F.col("value").contains(f'"{path[-1]}":{{') & ~F.col("value").contains(f'"{path[-1]}":['), F.lit(False))
    return (
        docs.withColumn(f"{name}_single", single)
        .withColumn(f"{name}_several", F.when(wanted & ~F.col(f"{name}_single"), at_path(f"array<{record}>")))
        .withColumn(f"{name}_one", F.when(wanted & several.isNull(), at_path(record)))
        .withColumn(f"{name}_late", F.when(wanted & F.col(f"{name}_single") & one.isNull(), at_path(f"array<{record}>")))
        .withColumn(name, F.coalesce(several, late, F.when(one.isNotNull(), F.array(one))))
        .drop(f"{name}_single", f"{name}_several", f"{name}_one", f"{name}_late")
    )


def whole(records: str) -> Column:
    """The records, or NULL when one of them is no record."""
    return F.when(~F.exists(records, lambda r: r.isNull()), F.col(records))


def exploded(docs: DataFrame, keep: list[str], records: str | Column, name: str, every: bool = False) -> DataFrame:
    """One row per record with its position, and with ``every`` a row without position for a document that has none. An inner explode would make the optimizer infer a size
    filter and push it below the parse, which then runs twice; the outer one with a filter on the
    position does not."""
    rows = docs.select(*keep, F.posexplode_outer(records).alias("pos", name))
    return rows if every else rows.where("pos IS NOT NULL")


REASONS = ("unreadable", "bad_record")
OUTCOMES = ("rows", "empty", *REASONS)


def outcome_of(records: str, other: Column) -> Column:
    """Outcome of a document by its parsed records; ``other`` says it of a readable document without any. The text is parsed
    again only where there are none."""
    hole = F.exists(records, lambda r: r.isNull())
    absent = F.when(F.try_parse_json("value").isNull(), "unreadable").otherwise(other)
    return F.when(F.col(records).isNull(), absent).when(hole, "bad_record").when(F.size(records) == 0, "empty").otherwise("rows")


def with_outcome(docs: DataFrame, feed: str) -> DataFrame:
    """Add ``outcome`` to every document of a feed: ``rows`` it gives, ``empty``, or why it is rejected.

    ``unreadable`` is no JSON; ``bad_record`` holds a record that is none, which rejects the whole document. The rule is the one the
    explodes follow, so documents with rows, empty and rejected ones add up to all.
    """
    fields = {"category": [*CATEGORY_LABELS, *CATEGORY_PRICES], "product": PRODUCT_FIELDS, "region": REGION_FIELDS}[feed]
    record = _record(fields[:1])
    if feed == "category":
        found = with_records(docs, "_records", ["data", "item"], record)
        no_list = F.lit("empty")
    elif feed == "product":
        price = parsed(F.col("value"), f"struct<price:array<{record}>>")["price"]
        found = docs.withColumn("_records", price)
        is_list = parsed(F.col("value"), "struct<price:array<string>>")["price"].isNotNull()
        key = F.map_contains_key(parsed(F.col("value"), "map<string,string>"), "price")
        no_list = F.when(is_list, "bad_record").when(key, "rows").otherwise("empty")
    else:
        found = docs.withColumn("_records", parsed(F.col("value"), f"array<{record}>"))
        no_list = F.lit("empty")
    return found.withColumn("outcome", outcome_of("_records", no_list)).drop("_records")


def rejected(docs: DataFrame, feed: str) -> DataFrame:
    """Documents of a feed that give no rows though they are not empty: all their columns and the ``reason``."""
    return with_outcome(docs, feed).where(F.col("outcome").isin(*REASONS)).withColumnRenamed("outcome", "reason")


def explode_items(docs: DataFrame, outcomes: bool = False) -> DataFrame:
    """Category feed: one row per item with stripped labels and cleaned prices.

    ``data`` given as a list (no data) yields nothing. A label missing from the item is ``""``,
    a JSON null stays NULL; the second look at the keys happens only where a label is NULL and the text holds a ``null`` that may have
    made it so. With ``outcomes`` every document comes back, those without rows as one row without position, with its ``outcome``.
    """
    fields = [*CATEGORY_LABELS, *CATEGORY_PRICES]
    items = with_records(docs, "items", ["data", "item"], _record(fields))
    has_gap = F.exists("items", lambda i: reduce(Column.__or__, [i[f].isNull() for f in CATEGORY_LABELS]))
    gaps = items.withColumn("has_gap", F.coalesce(has_gap, F.lit(False)) & F.col("value").contains("null"))
    keyed = with_records(gaps, "keyed", ["data", "item"], "map<string,string>", only_if=F.col("has_gap"))
    told = ["outcome"] if outcomes else []
    if outcomes:
        keyed = keyed.withColumn("outcome", outcome_of("items", F.lit("empty")))
    rows = exploded(keyed, [*docs.columns, "keyed", *told], whole("items"), "item", outcomes)
    rows = rows.withColumn("keys", F.map_keys(F.get("keyed", F.col("pos")))).drop("keyed")

    def label(field: str) -> Column:
        text = F.col("item")[field]
        is_null = F.coalesce(F.array_contains("keys", field), F.lit(False))
        return F.when(text.isNotNull(), strip(text)).when(~is_null, "")

    return rows.select(
        *[c for c in docs.columns if c != "value"],
        *told,
        "pos",
        *[label(f).alias(name) for f, name in CATEGORY_LABELS.items()],
        *[clean_price(F.col("item")[f]).alias(name) for f, name in CATEGORY_PRICES.items()],
    )


def explode_prices(docs: DataFrame, fields: Sequence[str] = PRODUCT_FIELDS, outcomes: bool = False) -> DataFrame:
    """Product feed: one row per ``price`` element with list leaves collapsed.

    A ``price`` that is no list gives one row holding it as text; a missing one gives none. ``fields`` limits the
    parse to some fields of a record; the rows are the same ones. With ``outcomes`` every document comes back, as in ``explode_items``.
    """
    keep = [c for c in docs.columns if c != "value"]
    record = _record(fields)
    typed = parsed(F.col("value"), f"struct<error_code:string,condition:string,price:array<{record}>>")
    # Only where the typed list is absent: is there a key and its text, and if that looks like one, is it a list after all.
    # It is told of each document in one expression: the text is copied with every column that the next one needs.
    is_list = parsed(F.col("value"), "struct<price:array<string>>")["price"].isNotNull()

    def other(members: Column) -> Column:
        text = F.try_element_at(members, F.lit("price"))
        is_list_text = F.coalesce(F.when(text.startswith("["), is_list), F.lit(False))
        return F.struct(text.alias("text"), F.map_contains_key(members, "price").alias("has_key"), is_list_text.alias("is_list"))

    members = F.array(parsed(F.col("value"), "map<string,string>"))
    listed = F.coalesce(F.col("other.is_list"), F.lit(False))
    has_key = ~listed & F.col("other.has_key")
    no_record = F.when(has_key, F.array(F.lit(None).cast(record)))
    told = {}
    if outcomes:
        no_list = F.when(listed, "bad_record").when(has_key, "rows").otherwise("empty")
        told["outcome"] = outcome_of("head.price", no_list)
    rows = (
        marked(docs)
        .withColumn("head", typed)
        .withColumn("other", F.when(F.col("head.price").isNull(), F.get(F.transform(members, other), F.lit(0))))
        .select(
            *keep,
            *[c.alias(n) for n, c in told.items()],
            "head.error_code",
            "head.condition",
            F.when(~listed, F.col("other.text")).alias("price"),
            F.coalesce(whole("head.price"), no_record).alias("found"),
        )
    )
    rows = exploded(rows, [*keep, *told, "error_code", "condition", "price"], "found", "record", outcomes)
    leaves = {name: F.col(name) for name in ("error_code", "condition", "price")}
    leaves |= {f: F.col("record")[f] for f in fields}
    return rows.select(*keep, *told, "pos", *[first_of_list(leaf).alias(name) for name, leaf in leaves.items()])


def explode_records(docs: DataFrame, outcomes: bool = False) -> DataFrame:
    """Region feed: each document is a list of flat records, or one record on its own line. With ``outcomes`` every document comes
    back, as in ``explode_items``."""
    keep = [c for c in docs.columns if c != "value"]
    records = once(docs).withColumn("records", parsed(F.col("value"), f"array<{_record(REGION_FIELDS)}>"))
    if outcomes:
        records = records.withColumn("outcome", outcome_of("records", F.lit("empty")))
        keep.append("outcome")
    return exploded(records, keep, whole("records"), "record", outcomes).select(*keep, "pos", "record.*")


def explode_response_records(docs: DataFrame) -> DataFrame:
    """Region feed before landing: records of an accepted response."""
    keep = [c for c in docs.columns if c != "value"]
    accepted = with_status(docs, "status").where("status = 'ok'").drop("status")
    records = with_records(accepted, "records", ["data", "item"], _record(REGION_FIELDS))
    return exploded(records, keep, whole("records"), "record").select(*keep, "pos", "record.*")


def group_by_date(records: DataFrame) -> DataFrame:
    """Landing date of each region record; records without a year or a day are left out.

    The date is the folder a record is written to, so no date's records are ever gathered.
    """
    given = (F.col("yyyy") != "") & (F.col("regday") != "")
    dt = F.concat_ws("-", "yyyy", F.replace("regday", F.lit("/"), F.lit("-")))
    return records.where(given).withColumn("dt", dt)


def region_date() -> Column:
    return date_from_parts(F.col("yyyy"), F.col("regday"))


def with_status(docs: DataFrame, name: str, allow_empty: bool = False) -> DataFrame:
    """Add the status of each response: ``ok``, ``empty``, ``missing``, ``broken``, ``unexpected`` or
    ``error:<code>``. Each parse runs only where the one before found another shape."""
    value = F.col("value")
    unseen = F.col("_object").isNull()
    code = F.coalesce(F.col("_object.error_code"), F.lit(""))
    no_keys = F.size(F.map_keys(parsed(value, "struct<data:map<string,string>>")["data"])) == 0
    falsy = F.col("_bare").isNull() | F.col("_bare").isin("", "0", "0.0", "false")
    status = (
        F.when(code == CODE_OK, "ok")
        .when(~unseen & (code == ""), F.when(no_keys, "missing").otherwise("error:"))
        .when(~unseen, F.concat(F.lit("error:"), code))
        .when(F.size("_list") == 0, "missing")
        .when(F.get("_list", F.lit(0)) == CODE_NO_DATA, "ok" if allow_empty else "empty")
        .when(F.col("_list").isNotNull(), "ok")
        .when(falsy, F.when(F.try_parse_json(value).isNull(), "broken").otherwise("missing"))
        .otherwise("unexpected")
    )
    return (
        docs.withColumn("_object", parsed(value, "struct<data:struct<error_code:string>>")["data"])
        .withColumn("_list", F.when(unseen, parsed(value, "struct<data:array<string>>")["data"]))
        .withColumn("_bare", F.when(unseen & F.col("_list").isNull(), parsed(value, "struct<data:string>")["data"]))
        .withColumn(name, status)
        .drop("_object", "_list", "_bare")
    )


def with_price_list_status(docs: DataFrame, name: str) -> DataFrame:
    """Add the status of each product-feed response: ``price`` must be a list with something in it."""
    status = (
        F.when(F.size("_prices") > 0, "ok")
        .when(F.col("_prices").isNotNull(), "empty")
        .when(F.try_parse_json("value").isNull(), "broken")
        .otherwise("not_a_list")
    )
    prices = parsed(F.col("value"), "struct<price:array<string>>")["price"]
    return once(docs).withColumn("_prices", prices).withColumn(name, status).drop("_prices")


def first_condition(value: Column) -> Column:
    """The first request condition of a response, parsed once for all its fields."""
    return F.get(parsed(value, "struct<condition:array<variant>>")["condition"], F.lit(0))


def condition_field(first: Column, key: str) -> Column:
    """A text field of a request condition, stripped; absent, blank or no text gives ``""``."""
    leaf = F.try_variant_get(first, f"$.{key}", "variant")
    text = F.when(F.schema_of_variant(leaf) == "STRING", F.try_variant_get(leaf, "$", "string"))
    return F.coalesce(strip(text), F.lit(""))


def condition_date(value: Column) -> Column:
    """Product feed: the date is the first text of the first condition list."""
    lists = parsed(value, "struct<condition:array<array<string>>>")["condition"]
    return F.get(F.get(lists, F.lit(0)), F.lit(0))
