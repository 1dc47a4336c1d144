"""Near duplicates by fingerprints of word shingles, found with Golay-code keys.

A 64-bit fingerprint is cut into three segments of 22, 21 and 21 bits. Two fingerprints that differ in at most two bits
agree fully in one segment and in all but one bit of the segment after it (in a circle). A segment stands for the word
of the perfect (23, 12) Golay code nearest to it. A segment one bit away from another decodes either to the same word or to
one of the few words met when each of its own bits is flipped. So a row is stored under (agreeing segment, word of
the next) and looked up under (agreeing segment, each of the few words of the next): equal keys give the candidates, and
the number of differing bits decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import map_batches, row_digest, stage, words
from pricelake.llm.components import connected_components
from pricelake.operators.lookup import BROADCAST_LIMIT_ROWS
from pricelake.session import discard

SEED = 42
SHINGLE_WORDS = 3
MOST_BITS = 2
#: (lowest bit, width) of each segment.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Keys with more rows than this are joined through one-bit neighbours in place of pairs.
CROWDED = 64
#: Fixed value: generator polynomial of the (23, 12) Golay code, x^11+x^10+x^6+x^5+x^4+x^2+1.
GENERATOR = 0b110001110101


def shingle_hashes(parts: list[bytes], width: int) -> np.ndarray:
    """XXH64 of each run of ``width`` words in order, or of all words if there are fewer; none without a word."""
    if not parts:
        return np.empty(0, np.uint64)
    joined = b" ".join(parts)
    ends = list(accumulate((len(p) + 1 for p in parts), initial=0))
    width = min(width, len(parts))
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(joined[a : b - 1], SEED) for a, b in zip(ends, ends[width:], strict=False)), "<u8", len(parts) - width + 1
    )


def fingerprint(text: str | None) -> int:
    """Majority of the bits of the XXH64 of all shingles of three words; zero without a word."""
    hashes = shingle_hashes(words(text or ""), SHINGLE_WORDS)
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for block in np.split(hashes, range(4096, len(hashes), 4096)):
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key`` and ``fp`` (the 64 bits as a signed number) of every row."""
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").cast("string").alias("body"))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.as_py()) for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(prints, pa.int64())], ["id", "fp"])

    kind = rows.schema["id"].dataType.simpleString()
    return map_batches(rows, of_batches, f"id {kind}, fp bigint")


@cache
def golay_table() -> np.ndarray:
    """Index (12 bits) of the code word nearest to each 23-bit word.

    The remainder by the generator polynomial tells the one error pattern of at most three bits; all 2048 remainders occur.
    """
    remainder = np.arange(1 << 23, dtype=np.int32)
    for bit in range(22, 10, -1):
        remainder = np.where(remainder >> bit & 1, remainder ^ (GENERATOR << (bit - 11)), remainder)
    flips = [0] + [1 << a for a in range(23)]
    flips += [1 << a | 1 << b for a in range(23) for b in range(a)]
    flips += [1 << a | 1 << b | 1 << c for a in range(23) for b in range(a) for c in range(b)]
    patterns = np.array(flips, np.int32)
    error = np.zeros(1 << 11, np.int32)
    error[remainder[patterns]] = patterns
    return ((np.arange(1 << 23, dtype=np.int32) ^ error[remainder]) >> 11).astype(np.int16)


def segment_keys(prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, key, is the plain one) for the three ways to choose the agreeing segment."""
    table = golay_table()
    parts = [(prints >> np.uint64(low)).astype(np.int64) & ((1 << width) - 1) for low, width in SEGMENTS]
    for n, agreeing in enumerate(parts):
        after = (n + 1) % len(parts)
        flips = np.array([0] + [1 << b for b in range(SEGMENTS[after][1])])
        near = table[parts[after][:, None] ^ flips[None, :]].astype(np.int64)
        plain = near[:, 0].copy()
        near.sort(axis=1)
        new = np.ones(near.shape, bool)
        new[:, 1:] = near[:, 1:] != near[:, :-1]
        row, column = np.nonzero(new)
        code = near[row, column]
        yield row, (np.int64(n) << 34) | (agreeing[row] << 12) | code, code == plain[row]


def golay_keys(nodes: DataFrame) -> DataFrame:
    """``key``, ``fp`` and ``stored`` (under this key a row is stored; under all of them it is looked up)."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(0).to_numpy(zero_copy_only=False)
            for start in range(0, len(prints), 4096):
                block = prints[start : start + 4096]
                for row, key, plain in segment_keys(block.view(np.uint64)):
                    yield pa.record_batch([pa.array(key), pa.array(block[row]), pa.array(plain)], ["key", "fp", "stored"])

    return map_batches(nodes.select("fp"), of_batches, "key bigint, fp bigint, stored boolean")


def _through_neighbours(members: DataFrame) -> DataFrame:
    """Links of fingerprints at two bits or fewer, exactly, with 65 rows a fingerprint whatever the size of a bucket.

    Two such fingerprints have a common value at one bit or fewer from both, and no value has more than 65 of them around.
    """
    around = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit((1 << b) - (1 << 64 if b == 63 else 0))) for b in range(64)])
    met = members.select("fp", F.explode(around).alias("value"))
    shared = met.groupBy("value").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    return shared.select(F.explode("fps").alias("a"), F.array_min("fps").alias("b")).where("a <> b")


def linked_fingerprints(nodes: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """Links ``a``, ``b`` between the distinct fingerprints of ``nodes`` that give the components at two bits or fewer.

    A key with more than ``crowded`` stored rows would give pairs without bound; its members are linked through their
    one-bit neighbours, which finds the same components.
    """
    keys, _ = stage(golay_keys(nodes), "golay-keys")
    stored, looked_up = keys.where("stored").select("key", F.col("fp").alias("a")), keys.select("key", F.col("fp").alias("b"))
    full, full_path = stage(stored.groupBy("key").count().where(F.col("count") > crowded).select("key"), "crowded-keys")
    links = None
    if not full.isEmpty():
        members, _ = stage(looked_up.join(full, "key", "left_semi").select(F.col("b").alias("fp")).distinct(), "crowded")
        links = _through_neighbours(members)
        stored, _ = stage(stored.join(full, "key", "left_anti"), "stored-keys")
    differing = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    pairs = stored.join(looked_up, "key").where((F.col("a") < F.col("b")) & (differing <= MOST_BITS)).select("a", "b")
    discard(nodes.sparkSession, *([] if links else [full_path]))
    return (pairs.unionAll(links) if links else pairs).distinct()


def _labelled(prints: DataFrame, least: Column, crowded: int) -> DataFrame:
    """Every distinct fingerprint with ``root``, that of its component, and the ``least`` of its rows."""
    nodes, _ = stage(prints.groupBy("fp").agg(F.min(least).alias("least")), "distinct-fingerprints")
    roots, _ = stage(connected_components(linked_fingerprints(nodes, crowded)), "roots")
    return nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", crowded: int = CROWDED) -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits) and ``component_id``, one row per document.

    Documents whose fingerprints differ in two bits or fewer are linked; ``component_id`` is the smallest key reachable. Texts without a
    word (NULL, empty, blanks) have fingerprint zero and are linked like any others. Repeated rows each come back. A NULL key
    is never the smallest unless its component has no other; then ``component_id`` is NULL. Other columns are not read.
    """
    prints, _ = stage(fingerprints(docs, key, text), "fingerprints")
    labelled, labelled_path = stage(_labelled(prints, F.col("id"), crowded), "labelled")
    smallest = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    # Written out, so that the last join has two plain shuffles and a fingerprint of very many documents can be split.
    components, _ = stage(labelled.join(smallest, "root").select("fp", "component_id"), "components")
    discard(docs.sparkSession, labelled_path)
    joined = prints.join(components, "fp")
    return joined.select(
        F.col("id").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", crowded: int = CROWDED) -> DataFrame:
    """Documents with one of each component, that of the smallest key, all columns as they were.

    A NULL key comes last; equal keys are told apart by a digest of key and text, so a row goes by its own text only. Texts without a word
    (NULL, empty, blanks) are copies of each other. Rows equal in key and text are one row here: they stay or go together
    (``exact_dedup`` takes them). No documents give no rows.
    """
    spark = docs.sparkSession
    digest = row_digest(f"`{key}`", F.col(f"`{text}`").cast("string"))
    who = F.struct(F.col(f"`{key}`").isNull().alias("unknown"), F.col(f"`{key}`").alias("id"), digest.alias("at"))
    prints, prints_path = stage(fingerprints(docs.select(who.alias("who"), F.col(f"`{text}`").alias("body")), "who", "body"), "fingerprints")
    labelled, labelled_path = stage(_labelled(prints, F.col("id"), crowded), "labelled")
    staying, staying_path = stage(labelled.groupBy("root").agg(F.min("least").alias("stays")), "staying")
    chosen, chosen_path = stage(labelled.join(staying, "root").select("fp", F.col("stays.at").alias("stays")), "chosen")
    dropped = prints.select("fp", F.col("id.at").alias("near_copy")).join(chosen, "fp").where("near_copy <> stays")
    dropped, _ = stage(dropped.select("near_copy").distinct(), "near-copies")
    discard(spark, prints_path, labelled_path, staying_path, chosen_path)
    # A digest is 16 bytes: while few are dropped their list goes to every task, beyond that both sides are shuffled.
    few = dropped.count() <= BROADCAST_LIMIT_ROWS
    return docs.join(F.broadcast(dropped) if few else dropped, digest == dropped["near_copy"], "left_anti")
