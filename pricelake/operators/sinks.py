"""Partitioned file sinks. Overwrites are dynamic: only partitions present in the output are replaced."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.fixed import SEGMENTS
from pricelake.functions import compact_date
from pricelake.schemas import LANDING_KEYS, MONTH_PARTITIONS, SNAPSHOT_PARTITIONS
from pricelake.session import shuffles_removed
from pricelake.sources.landing import read_documents
from pricelake.sources.tables import CSV_DIALECT, staged


OPEN_COST = "spark.sql.files.openCostInBytes"
SMALL_FILE_BYTES = 16 * 1024
#: Documents a task lands in files of their own: making a file takes far longer than writing a document.
FILES_PER_TASK = 256
#: For files of their own. Tasks move what they wrote to the staging folder themselves, which else the driver does file by file; nothing
#: is seen before the folders are renamed. On a local disk no checksum file is made beside each: for either file Hadoop would
#: start a process that sets its mode. Other stores do not know these two settings.
FILE_EACH = {
    "mapreduce.fileoutputcommitter.algorithm.version": "2",
    "fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem",
    "fs.file.impl.disable.cache": "true",
}


def balanced(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Gather rows by output partition so each gets few files; adaptive execution splits a
    partition that is too large for one task and joins small ones."""
    return df.hint("rebalance", *partitions)


def write_parquet(df: DataFrame, path: str, partitions: Sequence[str] = (), compression: str = "snappy", dealt: bool = False) -> None:
    """``dealt``: the rows are gathered by output partition already."""
    writer = (balanced(df, partitions) if partitions and not dealt else df).write.mode("overwrite").option("compression", compression)
    if partitions:
        writer = writer.partitionBy(*partitions).option("partitionOverwriteMode", "dynamic")
    with shuffles_removed(df.sparkSession):
        writer.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV in the dialect of ``tables.read_csv``: quotes inside a text are doubled, line breaks stay."""
    df.write.mode("overwrite").options(header=True, **CSV_DIALECT).csv(path)


def one_line(document: Column) -> Column:
    """A JSON document without raw line breaks, which can only stand between its parts: a space takes their place. Most have none, and
    looking for one takes far less than the pattern."""
    broken = document.contains("\n") | document.contains("\r")
    return F.when(broken, F.regexp_replace(document, "[\\r\\n]+", " ")).otherwise(document)


def without_place(docs: DataFrame) -> DataFrame:
    """Documents that cannot be landed: one of the landing keys the frame has is NULL, so there is no folder for them."""
    keys = [k for k in LANDING_KEYS if k in docs.columns]
    return docs.where(" OR ".join(f"`{k}` IS NULL" for k in keys) if keys else "false")


def land_documents(
    docs: DataFrame,
    root: str,
    value: str = "value",
    normalize_dt: bool = False,
    one_per_file: bool = False,
    unplaced: str | None = None,
    run: str = "",
    compression: str = "none",
) -> list[str]:
    """Write documents below ``key=value`` folders in the fixed key order; keys the frame lacks
    are left out. ``normalize_dt`` drops the dashes of the date. Returns the keys used.

    Each document takes one line, or with ``one_per_file`` a file of its own as it came. Those with a NULL key have no place and are
    not landed: in a folder for NULL every run would overwrite those of the last. They are kept below ``unplaced``, in a folder of the
    ``run``, with all their columns.

    ``compression`` is that of the text files; a file of the line layout has the size of a task, so it need not be split.
    Files of their own are dealt out by their number, which is counted first: tasks by landing folder or by size would write them one
    after another.
    """
    keys = [k for k in LANDING_KEYS if k in docs.columns]
    placed = docs.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)) if keys else docs
    out = placed.withColumn("dt", compact_date(F.col("dt"))) if normalize_dt else placed
    text = F.col(value) if one_per_file else one_line(F.col(value))
    out = out.select(text.alias("value"), *keys)
    spread = out.repartition(-(-out.count() // FILES_PER_TASK) or 1) if one_per_file else balanced(out, keys)
    writer = spread.write.mode("overwrite").partitionBy(*keys).option("compression", compression)
    if one_per_file:
        writer = writer.option("maxRecordsPerFile", 1).options(**FILE_EACH)
    with shuffles_removed(docs.sparkSession):
        writer.option("partitionOverwriteMode", "dynamic").text(root)
    if unplaced:
        write_parquet(without_place(docs).withColumn("run", F.lit(run)), unplaced, ("run",))
    return keys


def compact_documents(spark: SparkSession, root: str, target: str, keys: Sequence[str], day: str | None = None) -> None:
    """Land a zone of one document per file anew with a document per line, or one landing date of it.

    Spark counts a file as 4 MB at least when it packs files into tasks, which makes 32 documents a task. Here a file counts
    as SMALL_FILE_BYTES, so a task reads up to ``maxPartitionBytes`` of documents. Of a landing date only its own folder is listed.
    """
    docs = read_documents(spark, root, keys, one_per_file=True, day=day)
    before = spark.conf.get(OPEN_COST)
    spark.conf.set(OPEN_COST, str(SMALL_FILE_BYTES))
    try:
        land_documents(docs.where(F.col("dt") == day) if day else docs, target)
    finally:
        spark.conf.set(OPEN_COST, before)


def landing_status(incoming: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of incoming keys that are ``new`` and that ``overwrite`` a landed one.

    Both sides are reduced to distinct keys before one join, so copies cost nothing.
    """
    present = existing.select(*keys).distinct().withColumn("_landed", F.lit(True))
    status = F.when(F.col("_landed"), "overwrite").otherwise("new")
    joined = incoming.select(*keys).distinct().join(present, list(keys), "left")
    return joined.groupBy(status.alias("status")).agg(F.count("*").alias("objects"))


def write_snapshot(df: DataFrame, path: str, dealt: bool = False) -> None:
    """Year/month/dt folders; a rerun of one dt replaces that dt."""
    write_parquet(df, path, SNAPSHOT_PARTITIONS, dealt=dealt)


def segment_of(category: Column) -> Column:
    """Output segment of a category code, NULL for codes in none."""
    segment = F.lit(None).cast("string")
    for name, codes in SEGMENTS.items():
        segment = F.when(category.isin(*codes), name).otherwise(segment)
    return segment


def write_segments(df: DataFrame, root: str) -> None:
    """All segments in one pass, each below its own ``segment=`` folder."""
    write_parquet(df.where("segment IS NOT NULL"), root, ("segment", *SNAPSHOT_PARTITIONS))


def merged_by_date(existing: DataFrame, incoming: DataFrame, day: str = "res_dt") -> DataFrame:
    """Month partitions touched by ``incoming`` with its dates replaced.

    Only those months are read: they are few, so they are named in the filter. Rows of other dates are kept; columns one
    side lacks are NULL. Undated rows have no date to be replaced by: of each there are afterwards as many as were stored or as come in,
    whichever is more, so a rerun changes nothing.
    """
    months = list(MONTH_PARTITIONS)
    found = incoming.select(*months).distinct().collect()
    touched = existing.where(
        reduce(Column.__or__, [reduce(Column.__and__, [F.col(m).eqNullSafe(r[m]) for m in months]) for r in found], F.lit(False))
    )
    dated = touched.where(F.col(day).isNotNull()).join(incoming.select(day).distinct(), [day], "left_anti")
    common = sorted(c for c in existing.columns if c in incoming.columns)
    row = F.to_json(F.struct(*[F.col(f"`{c}`").cast("string").alias(c) for c in common]), {"ignoreNullFields": "false"})
    # Dealt out before they are counted: they are one month, which few tasks read, and nearly all differ, so counting them there
    # would hold whole files in memory.
    undated = touched.where(F.col(day).isNull()).withColumn("_row", row).repartition("_row")
    counted = undated.groupBy(*existing.columns, "_row").agg(F.count("*").alias("_stored"))
    again = incoming.where(F.col(day).isNull()).groupBy(row.alias("_row")).agg(F.count("*").alias("_again"))
    left = F.col("_stored") - F.coalesce("_again", F.lit(0))
    undated = counted.join(again, ["_row"], "left").where(left > 0).withColumn("_nth", F.explode(F.sequence(F.lit(1), left)))
    undated = undated.select(*existing.columns)
    return dated.select(*existing.columns).unionByName(undated).unionByName(incoming, allowMissingColumns=True)


def merge_by_date(existing: DataFrame, incoming: DataFrame, path: str, day: str = "res_dt") -> None:
    """Rewrite the months ``merged_by_date`` covers. Empty input touches nothing.

    The merged months are written to the work folder first and read from there, so no task reads a folder that the same job
    replaces. Where nothing is stored there is nothing to read, and the new rows are written as they are.
    Replacing folders is a rename; on a store without renames use a committer or table format that swaps them in one step.
    """
    if existing.isEmpty():
        merged = existing.limit(0).unionByName(incoming, allowMissingColumns=True)
    else:
        merged = staged(merged_by_date(existing, incoming, day), "merged-months")
    write_parquet(merged, path, MONTH_PARTITIONS)
