"""Trie of the common beginnings of conversations, with singletons screened out by a count-min sketch.

The beginning of a conversation after d turns has a digest: the exclusive or of a hash of each turn and its place. All digests are counted in a
count-min sketch. A beginning whose estimate is one belongs to one conversation only, and so does all that follows, so its node
is written where the row stands. Only beginnings with a larger estimate are shuffled and grouped exactly; a collision in the sketch costs a
shuffled row and never changes a result.

A node counts each node below it once, through the smallest conversation of that node: it is a member of all nodes above. So sums over
subtrees are sums over members and take no walk down the trie.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelake.llm.common import map_batches, stage
#: Turns of a conversation that one task numbers and accumulates; longer conversations are split there.
BLOCK_TURNS = 4096
#: Rows of the sketch.
SKETCH_ROWS = 3
CELLS_PER_PREFIX = 8
LEAST_CELLS = 2**15
#: Cells of a row of the sketch at most: one bit each is sent to every task, 24 MB in all.
MOST_CELLS = 2**26
#: Conversation ids joined to one text at a time.
ID_BLOCK = 1024
KEY = ("depth", "x1", "x2")


def _halves(text: Column) -> tuple[Column, Column]:
    """120 bits of the MD5 of a text as two numbers."""
    digest = F.md5(text.cast("binary"))
    return tuple(F.conv(F.substring(digest, at, 15), 16, 10).cast("bigint") for at in (1, 16))


def turns_of(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``c``, ``p`` (place from 0), ``content`` (digest of role and text), ``size`` (bytes of the text) of every turn, by turn, NULL
    first; equal turns by digest. Rows without a conversation are left out; NULL role and text are empty."""
    who, said = (F.coalesce(F.col(f"`{x}`").cast("string"), F.lit("")) for x in (role, text))
    rows = conversations.where(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").cast("bigint").alias("c"),
        F.col(f"`{turn}`").alias("turn"),
        F.md5(F.concat(F.char_length(who).cast("string"), F.lit(":"), who, said).cast("binary")).alias("content"),
        F.octet_length(said).cast("bigint").alias("size"),
    )
    rows = rows.withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS), F.lit(-(2**62))).cast("bigint"))
    numbered = accumulated(rows, F.lit(1).cast("bigint"), F.sum, lambda a, b: a + b, F.lit(0), ["turn", "content"], "nth")
    return numbered.select("c", (F.col("nth") - 1).alias("p"), "content", "size")


def accumulated(rows: DataFrame, value: Column, add, join, nothing: Column, order: list[str], name: str) -> DataFrame:
    """``value`` added up within each conversation ``c`` in order, up to and with each row.

    Blocks of a conversation (``block``, in order) add up apart; the totals of the blocks before are joined for those with several.
    """
    window = Window.partitionBy("c", "block").orderBy(*[F.col(o).asc_nulls_first() for o in order])
    inside = rows.withColumn(name, add(value).over(window.rowsBetween(Window.unboundedPreceding, 0)))
    later = rows.groupBy("c").agg(F.min("block").alias("least"), F.max("block").alias("most")).where("least < most").select("c")
    later, _ = stage(later, "long-conversations")
    totals = rows.join(later, "c", "left_semi").groupBy("c", "block").agg(add(value).alias("total"))
    before = Window.partitionBy("c").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("c", "block", F.coalesce(add("total").over(before), nothing).alias("offset"))
    offsets, _ = stage(offsets, "block-offsets")
    return inside.join(offsets, ["c", "block"], "left").withColumn(name, join(F.col(name), F.coalesce("offset", nothing))).drop("offset")


def rebuilt(turns: DataFrame, group: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations with the first turns of the first of their group in place of their own.

    Returns rows ``c``, ``p``, ``content``, ``size`` and a row a conversation ``c`` with its ``turns``. h is crc32 of the id modulo ``heads``.
    """
    counts = turns.groupBy("c").agg(F.count("*").alias("n"))
    own = counts.select("c", "n", (F.col("c") - F.col("c") % group).alias("base"), (F.crc32(F.col("c").cast("string").cast("binary")) % heads).alias("h"))
    base = counts.select(F.col("c").alias("base"), F.col("n").alias("of_base"))
    plan = own.join(base, "base", "left").select("c", "n", "base", "h", F.least("h", F.coalesce("of_base", F.lit(0))).alias("taken"))
    plan, _ = stage(plan, "rebuilding")
    first = turns.where(F.col("p") < heads - 1).withColumnRenamed("c", "base")
    head = plan.select("c", "base", "h").join(first, "base").where("p < h").select("c", "p", "content", "size")
    tail = turns.join(plan.select("c", "h", "taken"), "c").where("p >= h").select("c", (F.col("p") - F.col("h") + F.col("taken")).alias("p"), "content", "size")
    return head.unionAll(tail), plan.select("c", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("turns"))


def prefixes(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """Every beginning with a turn or more: ``c``, ``depth``, digest ``x1``, ``x2``, that of its parent ``y1``, ``y2``, ``size`` of the last turn and
    whether it is the whole conversation (``ends``)."""
    rows = turns.withColumn("block", F.floor(F.col("p") / BLOCK_TURNS))
    one, two = _halves(F.concat(F.col("p").cast("string"), F.lit(":"), F.col("content")))
    rows, _ = stage(rows.select("c", "p", "block", "size", one.alias("t1"), two.alias("t2")), "turns")
    for n in ("1", "2"):
        rows = accumulated(rows, F.col(f"t{n}"), F.bit_xor, lambda a, b: a.bitwiseXOR(b), F.lit(0).cast("bigint"), ["p"], f"x{n}")
    return rows.join(lengths, "c").select(
        "c",
        (F.col("p") + 1).alias("depth"),
        "x1",
        "x2",
        *[F.col(f"x{n}").bitwiseXOR(F.col(f"t{n}")).alias(f"y{n}") for n in (1, 2)],
        "size",
        (F.col("p") + 1 == F.col("turns")).alias("ends"),
    )


# Sketch.


def sketch_cells(prefix_count: int) -> int:
    """Cells of a row of the sketch: a power of two within the bounds."""
    return min(MOST_CELLS, 1 << (max(LEAST_CELLS, CELLS_PER_PREFIX * prefix_count) - 1).bit_length())


def cells_of(depth: np.ndarray, x1: np.ndarray, x2: np.ndarray, cells: int) -> list[np.ndarray]:
    """Cell of each beginning in each row of the sketch; rows follow one another."""
    out = []
    for row in range(SKETCH_ROWS):
        mixed = (x1 ^ x2 * np.int64(2 * row + 3)).view(np.uint64) + depth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
        out.append((mixed & np.uint64(cells - 1)).astype(np.int64) + row * cells)
    return out


def crowded_cells(found: DataFrame, cells: int) -> np.ndarray:
    """One bit a cell of the sketch, set where two or more beginnings were counted.

    Each batch counts its own cells; Spark adds the counts up. What the driver holds is SKETCH_ROWS * MOST_CELLS bits at most.
    """

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            for hit in cells_of(*keys, cells):
                cell, hits = np.unique(hit, return_counts=True)
                yield pa.record_batch([pa.array(cell), pa.array(hits)], ["cell", "hits"])

    counted = map_batches(found.select(*KEY), of_batches, "cell bigint, hits bigint")
    several = counted.groupBy("cell").agg(F.sum("hits").alias("hits")).where("hits > 1").select((F.col("cell") + 1).alias("cell"))
    bitmaps = several.groupBy(F.bitmap_bucket_number("cell").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits")
    )
    out = np.zeros((SKETCH_ROWS * cells + 7) // 8, np.uint8)
    for bucket, bits in bitmaps.collect():
        out[(bucket - 1) * len(bits) : bucket * len(bits)] = np.frombuffer(bits, np.uint8)[: len(out) - (bucket - 1) * len(bits)]
    return out


def screened(found: DataFrame, cells: int, crowded: np.ndarray) -> DataFrame:
    """``found`` with ``shared`` and ``parent_shared``: false where the estimate is one, so that the beginning is proved to be of one conversation."""
    bits = found.sparkSession.sparkContext.broadcast(crowded)

    def estimates_two(*key: np.ndarray) -> np.ndarray:
        held = np.ones(len(key[0]), bool)
        for cell in cells_of(*key, cells):
            held &= bits.value[cell >> 3] >> (cell & 7).astype(np.uint8) & 1 > 0
        return held

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in (*KEY, "y1", "y2")}
            shared = estimates_two(of["depth"], of["x1"], of["x2"])
            above = estimates_two(of["depth"] - 1, of["y1"], of["y2"]) | (of["depth"] == 1)
            yield batch.append_column("shared", pa.array(shared)).append_column("parent_shared", pa.array(above))

    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema)
    return map_batches(found, of_batches, f"{ddl}, shared boolean, parent_shared boolean")


# Nodes.

EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def end_digests(ends: DataFrame) -> DataFrame:
    """KEY and ``ends_sha256`` of the ids ``c`` that end at each node.

    Ids are joined in blocks of ID_BLOCK neighbouring numbers. A node with several blocks has them hashed one after the other: a SHA-256 has
    no parts, so its bytes pass one task, but one block at a time.
    """
    blocks = ends.groupBy(*KEY, F.floor(F.col("c") / ID_BLOCK).alias("block")).agg(
        F.concat_ws(",", F.transform(F.sort_array(F.collect_set("c")), lambda c: c.cast("string"))).alias("ids")
    )
    blocks, _ = stage(blocks, "end-ids")

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            done = []
            for *row, ids in zip(*(batch.column(n).to_pylist() for n in (0, 1, 2)), batch.column(3), strict=True):
                if row != key:
                    if key is not None:
                        done.append((*key, digest.hexdigest()))
                    key, digest = row, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.as_buffer())
            if done:
                yield pa.record_batch([pa.array(v) for v in zip(*done, strict=True)], [*KEY, "ends_sha256"])
        if key is not None:
            yield pa.record_batch([pa.array([v]) for v in (*key, digest.hexdigest())], [*KEY, "ends_sha256"])

    dealt = blocks.select(*KEY, "ids", "block").repartition(*KEY).sortWithinPartitions(*KEY, "block").select(*KEY, "ids")
    return map_batches(dealt, of_batches, "depth bigint, x1 bigint, x2 bigint, ends_sha256 string")


def trie_of(found: DataFrame, lengths: DataFrame) -> DataFrame:
    """Nodes of the trie of ``prefixes``: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``."""
    found, _ = stage(found, "prefixes")
    cells = sketch_cells(found.count())
    marked, _ = stage(screened(found, cells, crowded_cells(found, cells)), "screened")
    zero = F.lit(0).cast("bigint")
    roots = lengths.select(
        "c", zero.alias("depth"), zero.alias("x1"), zero.alias("x2"), zero.alias("y1"), zero.alias("y2"), zero.alias("size"), (F.col("turns") == 0).alias("ends")
    )
    alone, rows = marked.where("NOT shared"), marked.where("shared").select(*roots.columns)
    nodes = rows.unionByName(roots).groupBy(*KEY).agg(
        F.min("c").alias("conv"), F.count("*").alias("n_convs"), *[F.first(x).alias(x) for x in ("y1", "y2", "size")]
    )
    nodes, _ = stage(nodes, "nodes")

    # Children: nodes that were grouped, and singletons below one that was.
    children = nodes.where("depth > 0").select("depth", "y1", "y2").unionAll(alone.where("parent_shared").select("depth", "y1", "y2"))
    children = children.groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("y1").alias("x1"), F.col("y2").alias("x2")
    ).agg(F.count("*").alias("n_children"))
    children, _ = stage(children, "children")
    nodes = nodes.join(children, [*KEY], "left").withColumn("n_children", F.coalesce("n_children", zero))
    nodes, _ = stage(nodes.withColumn("weight", (F.col("n_convs") - 1) * F.col("size")), "weighed")

    # Each conversation brings its leaf and its savings to all nodes it is a member of, those below a node to that node.
    leaves = nodes.where("n_children = 0").select(F.col("conv").alias("c")).unionAll(alone.where("ends").select("c")).withColumn("leaf", F.lit(1).cast("bigint"))
    leaves, _ = stage(leaves, "leaves")
    weights = nodes.where("weight > 0").select(F.col("conv").alias("c"), "depth", "weight")
    member = rows.select("c", *KEY).unionByName(roots.select("c", *KEY)).join(weights, ["c", "depth"], "left").withColumn("weight", F.coalesce("weight", zero))
    member, _ = stage(member.withColumn("block", F.floor(F.col("depth") / BLOCK_TURNS)), "members")
    upto = accumulated(member, F.col("weight"), F.sum, lambda a, b: a + b, zero, ["depth"], "upto")
    totals = member.groupBy("c").agg(F.sum("weight").alias("total"))
    brought = upto.join(totals, "c").join(leaves, "c", "left")
    sums = brought.groupBy(*KEY).agg(
        F.sum(F.coalesce("leaf", zero)).alias("n_leaves"), F.sum(F.col("total") - F.col("upto") + F.col("weight")).alias("saved_tokens")
    )

    ends = end_digests(rows.where("ends").select(*KEY, "c").unionAll(roots.where("ends").select(*KEY, "c")))
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("y1"), F.col("x2").alias("y2"), F.col("conv").alias("parent"))
    root = above.where("depth = 1").select(F.col("parent").alias("root"))

    def with_parent(below: DataFrame) -> DataFrame:
        """The root is one row; further down a parent of very many children is a skewed key, which adaptive execution splits."""
        first = below.where("depth <= 1").join(F.broadcast(root), F.col("depth") == 1, "left").withColumnRenamed("root", "parent")
        return first.unionByName(below.where("depth > 1").join(above.where("depth > 1"), ["depth", "y1", "y2"], "left").select(first.columns))

    grouped = with_parent(nodes).join(sums, [*KEY]).join(ends, [*KEY], "left")
    single = with_parent(alone.where("parent_shared")).unionByName(alone.where("NOT parent_shared").withColumn("parent", F.col("c")))
    return grouped.select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.when(F.col("depth") > 0, F.coalesce("parent", "conv")).alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    ).unionAll(
        single.select(
            F.col("c").alias("conv_id"),
            "depth",
            F.coalesce("parent", "c").alias("parent_conv_id"),
            F.lit(1).cast("bigint").alias("n_convs"),
            F.when(F.col("ends"), 0).otherwise(1).cast("bigint").alias("n_children"),
            F.lit(1).cast("bigint").alias("n_leaves"),
            zero.alias("saved_tokens"),
            F.when(F.col("ends"), F.sha2(F.col("c").cast("string").cast("binary"), 256)).otherwise(EMPTY_SHA256).alias("ends_sha256"),
        )
    )


def conversation_trie(conversations: DataFrame, rebuild: bool = False, **columns: str) -> DataFrame:
    """One row per distinct beginning of conversations, the root (no turn) included: its smallest member ``conv_id``, ``depth``, the parent's
    ``conv_id``, members ``n_convs``, children ``n_children``, childless nodes below or at it ``n_leaves``, ``saved_tokens`` (bytes of last turns of all but one
    member, over the nodes at and below it) and ``ends_sha256`` of the ids that end there.

    Turns go by ``turn``, NULL first, equal ones by a digest of role and text. NULL role or text is empty; rows without a conversation
    are left out; repeated rows are turns of their own. No conversations give no rows, not even a root. Other columns are not read.
    ``rebuild`` gives each conversation the first turns of the first of its group of five. ``columns`` names the columns (``conv``, ``turn``, ``role``, ``text``).
    """
    turns, _ = stage(turns_of(conversations, **columns), "ordered-turns")
    if rebuild:
        rows, lengths = rebuilt(turns)
    else:
        rows, lengths = turns, turns.groupBy("c").agg(F.count("*").alias("turns"))
    lengths, _ = stage(lengths, "lengths")
    return trie_of(prefixes(rows, lengths), lengths)
