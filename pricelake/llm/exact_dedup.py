"""Exact duplicates by two passes with a Bloom filter.

Pass one counts, for each cell of a Bloom filter, how many texts fall on it, and keeps the cells that two or more
fall on as bitmaps. Pass two looks every text up: only one whose cells were all hit twice can have a copy, and
only those rows are shuffled. The rest are known to be alone and pass straight through. The grouping that
follows is exact, so a false positive of the filter costs a shuffled row and never changes a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import runs, stage, whole_text
from pricelake.session import discard

CELLS_PER_ROW = 16
LEAST_CELLS = 2**15
#: 32 MB of bitmaps, the most that is ever broadcast. Above 16 million texts the share of rows that shuffle grows.
MOST_CELLS = 2**28


def filter_cells(rows: int) -> int:
    """Power of two, 16 cells or more a row within the bounds."""
    wanted = max(LEAST_CELLS, CELLS_PER_ROW * rows)
    return min(MOST_CELLS, 1 << (wanted - 1).bit_length())


def _cells(digest: str, cells: int) -> tuple[Column, Column]:
    """Two cells from the halves of one 64-bit hash, counted from 1 as Spark's bitmaps are."""
    hashed = F.xxhash64(digest)
    return (
        (hashed.bitwiseAND(F.lit(cells - 1)) + 1).cast("bigint"),
        (F.shiftrightunsigned(hashed, 32).bitwiseAND(F.lit(cells - 1)) + 1).cast("bigint"),
    )


def repeated_cells(digests: DataFrame, cells: int) -> DataFrame:
    """Bitmaps (``bucket``, ``bits``) of the cells that two or more rows fall on."""
    hits = digests.select(F.explode(F.array(*_cells("digest", cells))).alias("cell"))
    repeated = hits.groupBy("cell").agg(F.count("*").alias("hits")).where("hits > 1")
    return repeated.groupBy(F.bitmap_bucket_number("cell").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits")
    )


def hit_cells(digests: DataFrame, cells: int) -> DataFrame:
    """Bitmaps of the cells that any row falls on, for ``possibly_repeated`` to find rows that may be among ``digests``. Tasks make bitmaps first."""
    hits = digests.select(F.explode(F.array(*_cells("digest", cells))).alias("cell"))
    return hits.groupBy(F.bitmap_bucket_number("cell").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits")
    )


def _is_set(bits: str, cell: str) -> Column:
    position = F.bitmap_bit_position(F.col(cell))
    byte = F.conv(F.hex(F.substring(F.col(bits), (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, (position % 8).cast("int")) == 1, F.lit(False))


def possibly_repeated(digests: DataFrame, filter_: DataFrame, cells: int) -> DataFrame:
    """``digests`` with ``suspect``: false only where no other row has the same digest."""
    marked = digests.withColumns(dict(zip(("cell_1", "cell_2"), _cells("digest", cells), strict=True)))
    for n in (1, 2):
        side = filter_.select(F.col("bucket").alias(f"bucket_{n}"), F.col("bits").alias(f"bits_{n}"))
        marked = marked.withColumn(f"bucket_{n}", F.bitmap_bucket_number(f"cell_{n}"))
        # At most MOST_CELLS bits whatever the input, so this side may always be broadcast.
        marked = marked.join(F.broadcast(side), f"bucket_{n}", "left")
    return marked.select(*digests.columns, (_is_set("bits_1", "cell_1") & _is_set("bits_2", "cell_2")).alias("suspect"))


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its key, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical; NULL counts as empty. Of equal texts the largest key stays. Repeated rows (same
    key and text) are one group and one of them stays. A NULL key sorts below every other, so it stays only
    where its group has no other; ``keep_id`` is then NULL. No documents give no rows; other columns are not read.
    """
    spark = docs.sparkSession
    digests, digest_path = stage(
        docs.select(F.col(key).alias("id"), F.unhex(F.sha2(whole_text(text).cast("binary"), 256)).alias("digest")),
        "digests",
    )
    cells = filter_cells(digests.count())
    filter_, filter_path = stage(repeated_cells(digests, cells), "repeated-cells")
    marked, marked_path = stage(possibly_repeated(digests, filter_, cells), "suspects")
    alone = marked.where(~F.col("suspect"))
    suspects = marked.where("suspect").groupBy("digest", "id").agg(F.count("*").alias("copies"))
    suspects, suspects_path = stage(suspects, "suspect-rows")
    # Written out, so that the join has two plain shuffles and adaptive execution can split a digest of very many documents.
    groups = suspects.groupBy("digest").agg(F.max("id").alias("keep_id"), F.sum("copies").alias("group_size"))
    groups, _ = stage(groups.where("group_size > 1"), "groups")
    joined = suspects.join(groups, "digest", "left")
    start, numbered = runs(F.col("copies"), "nth")
    joined = joined.select("*", start.alias("start")).select("*", numbered(F.col("start")))
    alone_kept = F.col("group_size").isNull() | (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1))
    found = joined.select(
        "id",
        F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        alone_kept.alias("kept"),
        "digest",
    )
    single = alone.select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), "digest"
    )
    discard(spark, digest_path, filter_path)
    return single.unionAll(found).select(
        F.col("id").alias(key), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents with one row of each equal text, the one with the largest key, all columns as they were.

    Rows the filter clears are never shuffled. Of the others each map task sends one row a text. Rows with equal key and
    text are told apart by their other columns, so the result is the same in every run.
    """
    columns = docs.columns
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        F.col(f"`{key}`").alias("id"),
        F.unhex(F.sha2(whole_text(text).cast("binary"), 256)).alias("digest"),
    )
    digests, digest_path = stage(rows.select("digest"), "digests")
    cells = filter_cells(digests.count())
    filter_, _ = stage(repeated_cells(digests, cells), "repeated-cells")
    discard(docs.sparkSession, digest_path)
    marked = possibly_repeated(rows, filter_, cells)
    order = F.struct(F.col("id"), F.xxhash64(F.to_json("row")))
    first = marked.where("suspect").groupBy("digest").agg(F.max_by("row", order).alias("row"))
    return marked.where(~F.col("suspect")).select("row.*").unionAll(first.select("row.*"))
