"""Landed JSON documents.

A document frame has ``file_path`` and ``value`` (the JSON text) plus one string column
per landing key that is a folder level. Two layouts are read: one document per file, and
one document per line, which is what this package writes because a 100 TB landing zone
cannot be one object per request.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.functions import path_attribute, path_text
from pricelake.functions.text import mark_quoted_brackets
from pricelake.schemas import LANDING_KEYS

# Single-quoted texts are no JSON; Spark's reader would take them.
JSON_OPTIONS = {"allowSingleQuotes": "false"}


def read_documents(
    spark: SparkSession,
    root: str,
    keys: Sequence[str] = (),
    one_per_file: bool = False,
    suffix: str | None = None,
    day: str | None = None,
) -> DataFrame:
    """Scan a landing zone. ``keys`` are the folder levels below ``root``, outermost first,
    and become partition columns, so a filter on ``dt`` prunes folders. ``day``: only the folder of this landing date is listed,
    where ``dt`` is the outermost and has one."""
    schema = ", ".join(f"{name} string" for name in ("value", *keys))
    reader, place = spark.read.schema(schema), root
    if day is not None and list(keys[:1]) == ["dt"] and day in folder_values(spark, root, "dt"):
        folder = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(day)
        reader, place = reader.option("basePath", root), f"{root.rstrip('/')}/dt={folder}"
    docs = reader.text(place, wholetext=one_per_file)
    docs = docs.select(path_text(F.col("_metadata.file_path")).alias("file_path"), "*")
    return docs.where(F.col("file_path").endswith(suffix)) if suffix else docs


def of_date(docs: DataFrame, day: str | Column) -> DataFrame:
    """Documents of one landing date. No such date gives an empty frame, so the run is a no-op."""
    return docs.where(F.col("dt") == day)


#: Folder of rows whose partition value is NULL.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def folder_values(spark: SparkSession, root: str, key: str, nulls: bool = False) -> list[str]:
    """Values of the folders ``key=value`` right below ``root``, in order: one listing, no file is opened. ``nulls``: that of NULL
    rows too."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{key}=*")
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place) or []
    values = (unquote(status.getPath().getName().partition("=")[2]) for status in found)
    return sorted(v for v in values if nulls or v != NO_VALUE)


def read_latest(spark: SparkSession, root: str, keys: Sequence[str], product_cls: str | None = None) -> DataFrame:
    """Documents of the newest landing date over all classes, optionally of one class.

    The date is taken from the names of the ``dt`` folders, which must be the outermost; then only its folder is read. An
    empty zone gives an empty frame.
    """
    dates = folder_values(spark, root, "dt")
    docs = read_documents(spark, root, keys).where(F.col("dt") == dates[-1]) if dates else None
    if docs is None:
        return spark.createDataFrame([], ", ".join(f"{name} string" for name in ("file_path", "value", *keys)))
    return docs.where(F.col("product_cls") == product_cls) if product_cls else docs


def latest_date(docs: DataFrame, product_cls: str | None = None) -> DataFrame:
    """The same for documents that do not lie below dated folders: the maximum is found by a scan of ``dt``."""
    newest = docs.where(docs.dt == docs.agg(F.max("dt")).scalar())
    return newest.where(F.col("product_cls") == product_cls) if product_cls else newest


def with_path_attributes(docs: DataFrame, keys: Sequence[str] = LANDING_KEYS, missing: str | None = None) -> DataFrame:
    """Landing keys read from the path text, for zones whose folder levels differ per file."""
    return docs.withColumns({key: path_attribute(F.col("file_path"), key, missing) for key in keys})


def once(docs: DataFrame, name: str = "value") -> DataFrame:
    """The same rows, with the column ``name`` made once for each, whatever reads it.

    The optimizer puts an expression in place of a column that is read once, and into every filter on the column. What builds a document
    would then be interpreted inside ``from_json``, which is not compiled, and what parses one would run for the filter and again for
    the result. It does not look through an explode."""
    others = [c for c in docs.columns if c != name]
    return docs.select(*others, F.explode_outer(F.array(name)).alias(name)).select(*docs.columns)


def parsed(value: Column, ddl: str) -> Column:
    return F.from_json(value, ddl, JSON_OPTIONS)


def is_readable(value: Column) -> Column:
    """True for a non-empty document that parses; ``[]`` and ``{}`` count as empty."""
    doc = F.try_parse_json(value)
    return doc.isNotNull() & ~F.is_variant_null(doc) & ~F.trim(value).rlike(r"^(\[\s*\]|\{\s*\}|\"\")$")


def scan_status(docs: DataFrame) -> DataFrame:
    """Every document with ``rejected``: broken and empty ones are kept apart, never raised."""
    return docs.withColumn("rejected", ~F.coalesce(is_readable(F.col("value")), F.lit(False)))


def marked(docs: DataFrame) -> DataFrame:
    """Documents prepared for ``first_of_list``."""
    return docs.withColumn("value", mark_quoted_brackets(F.col("value")))
