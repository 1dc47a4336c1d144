"""Removal of lines that many sites share.

One HyperLogLog sketch of the sites is kept for each line and merged by the aggregation itself, so a line that a third of
all documents have is one small sketch per map task. Lines the sketch puts clearly above the limit are
boilerplate; lines near the limit have their sites counted exactly; the others stay. A Bloom filter of the documents that
lose a line lets the texts of nearly all others pass without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import row_digest, stage, whole_text
from pricelake.llm.exact_dedup import filter_cells, hit_cells, possibly_repeated
from pricelake.session import discard

LEAST_SITES = 10
SKETCH_BITS = 12
#: Six times the standard error of a sketch with 2^12 registers, 1.04 / 64 (the fixed formula of HyperLogLog).
MARGIN = 6 * 1.04 / 2 ** (SKETCH_BITS / 2)


def document_lines(docs: DataFrame, key: str, text: str, site: str) -> DataFrame:
    """``doc``, ``site``, ``position`` and ``line`` (128-bit hash) of each line that is not blank.

    Lines end at a line feed and count whole, with their spaces. A NULL site counts as the site ''.
    """
    split = docs.select(
        row_digest(key, text).alias("doc"),
        F.coalesce(F.col(site).cast("string"), F.lit("")).alias("site"),
        F.posexplode(F.split(whole_text(text), "\n")).alias("position", "content"),
    )
    return split.where(F.trim("content") != "").select(
        "doc", "site", "position", F.unhex(F.md5(F.col("content").cast("binary"))).alias("line")
    )


def site_spread(lines: DataFrame) -> DataFrame:
    """``line`` with ``estimate``, the number of its sites by a merged sketch."""
    sketches = lines.groupBy("line").agg(F.hll_sketch_agg("site", SKETCH_BITS).alias("sketch"))
    return sketches.select("line", F.hll_sketch_estimate("sketch").alias("estimate"))


def remove_shared_lines(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    site: str = "source",
    least_sites: int = LEAST_SITES,
    output: str = "clean_text",
) -> DataFrame:
    """``key``, the text without its shared lines, ``n_lines`` and ``n_removed``, one row per document.

    A line goes when ``least_sites`` sites or more have it. Blank lines stay. A NULL text is empty: one line, nothing removed.
    Repeated rows count once for their site and all come back. Other columns are not read.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("body"), F.col(f"`{site}`").alias("at"))
    lines, lines_path = stage(document_lines(docs, "id", "body", "at"), "lines")
    suspects = site_spread(lines).where(F.col("estimate") >= F.lit(least_sites * (1 - MARGIN)))
    suspects, suspects_path = stage(
        suspects.select("line", (F.col("estimate") <= F.lit(least_sites * (1 + MARGIN))).alias("near")), "suspect-lines"
    )
    found, found_path = stage(lines.join(suspects, "line"), "suspect-occurrences")
    sites = found.where("near").groupBy("line").agg(F.countDistinct("site").alias("sites"))
    shared = suspects.where("not near").select("line").unionAll(sites.where(F.col("sites") >= least_sites).select("line"))
    shared, _ = stage(shared, "shared-lines")
    removed = found.join(shared, "line", "left_semi").select("doc", "position").distinct()
    removed, _ = stage(removed.groupBy(F.col("doc").alias("digest")).agg(F.collect_list("position").alias("removed")), "removed-lines")
    discard(spark, lines_path, suspects_path)

    cells = filter_cells(removed.count())
    filter_, _ = stage(hit_cells(removed.select("digest"), cells), "documents-with-removed-lines")
    marked = possibly_repeated(docs.withColumn("digest", row_digest("id", "body")), filter_, cells)
    parts = F.split(whole_text("body"), "\n")
    whole = marked.where(~F.col("suspect")).select(
        "id", whole_text("body").alias("kept"), F.size(parts).alias("n_lines"), F.lit(0).alias("n_removed")
    )
    joined = marked.where("suspect").join(removed, "digest", "left")
    joined = joined.select("id", parts.alias("parts"), F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))
    stays = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("removed"))
    kept = F.array_join(F.transform(stays, lambda i: F.get(F.col("parts"), i)), "\n")
    touched = joined.select("id", kept.alias("kept"), F.size("parts").alias("n_lines"), F.size("removed").alias("n_removed"))
    return whole.unionAll(touched).select(F.col("id").alias(key), F.col("kept").alias(output), "n_lines", "n_removed")
