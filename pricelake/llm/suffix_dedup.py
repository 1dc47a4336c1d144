"""Removal of long byte strings that occur more than once, by suffix sorting in blocks with a difference cover.

Spark makes the buckets of suffixes. Every window of LENGTH bytes has an anchor: of the pieces of PIECE bytes that lie in it, the one with the
least hash, the first of equals. Equal windows have equal anchors at equal places, so suffixes are bucketed by the hash of their anchor, and
anchors that occur once drop out before any text moves. An anchor stands for a few suffixes in a row; the bytes they span are
its context. Equal contexts are repeats as they stand; only buckets with different contexts are sorted.

Inside a task the suffixes of a block of buckets are sorted one range at a time. The suffixes that start on a difference cover modulo 31 are ranked
beforehand, by doubling. Suffixes that tie on their first 32 bytes are put in order by the ranks of the two cover
positions that lie equally far behind them; every pair of suffixes has such a pair within 31 bytes. So a long tie costs one comparison of
numbers and memory is bounded by the block. Neighbours in the order are compared over all LENGTH bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache, cmp_to_key

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelake.llm.common import map_batches, slices, stage, whole_text
from pricelake.operators.lookup import BROADCAST_LIMIT_BYTES
from pricelake.session import discard

LENGTH = 200
PIECE = 48
#: Fixed value: every difference modulo 31 is one of two of these numbers.
COVER = (0, 1, 3, 8, 12, 18)
PERIOD = 31
#: Contexts of one bucket that are sorted in one task; the suffixes of a larger bucket are grouped one by one, over all tasks.
CROWDED = 2000
BLOCK_BYTES = 1 << 20
#: Suffixes sorted at a time, cut where the first eight bytes change.
RANGE = 1 << 16
#: Bytes of a text hashed at a time.
STRIDE = 1 << 19


# Anchors.


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    base, size = 0x9E3779B97F4A7C15, 2 * STRIDE
    powers = np.cumprod(np.full(size, base, np.uint64))
    return powers, np.cumprod(np.full(size, pow(base, -1, 1 << 64), np.uint64))


def _piece_hashes(data: np.ndarray, piece: int) -> np.ndarray:
    powers, inverse = _powers()
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(data * powers[: len(data)], out=sums[1:])
    hashed = (sums[piece:] - sums[:-piece]) * inverse[: len(data) - piece + 1]
    hashed *= np.uint64(0xBF58476D1CE4E5B9)
    hashed ^= hashed >> np.uint64(31)
    hashed *= np.uint64(0x94D049BB133111EB)
    return hashed ^ (hashed >> np.uint64(29))


def anchors(data: np.ndarray, length: int = LENGTH, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows of ``length`` bytes the anchors in order: hash, place, and the first and last window start each stands for.

    A long text is hashed in strides; an anchor whose windows meet a stride's end counts once for either side, at the same place.
    """
    found = []
    width = length - piece + 1
    for begin in range(0, len(data) - length + 1, STRIDE):
        hashed = _piece_hashes(data[begin : begin + STRIDE + length - 1], piece)
        marked = (hashed >> np.uint64(20) << np.uint64(20)) | np.arange(len(hashed), dtype=np.uint64)
        padded = np.append(marked, np.full(-len(marked) % width, np.uint64(2**64 - 1))).reshape(-1, width)
        ahead = np.minimum.accumulate(padded, axis=1).ravel()
        behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
        starts = len(marked) - width + 1
        place = (np.minimum(behind[:starts], ahead[width - 1 : width - 1 + starts]) & np.uint64((1 << 20) - 1)).astype(np.int64)
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        last = np.append(first[1:], starts) - 1
        found.append((hashed[place[first]].view(np.int64), place[first] + begin, first + begin, last + begin))
    if not found:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(parts) for parts in zip(*found, strict=True))


# Suffixes of a block.


@cache
def common_offsets() -> np.ndarray:
    """For two positions modulo PERIOD the least distance at which both meet the cover."""
    on = np.zeros(2 * PERIOD, bool)
    on[list(COVER)] = on[[c + PERIOD for c in COVER]] = True
    table = np.zeros((PERIOD, PERIOD), np.int64)
    for a in range(PERIOD):
        for b in range(PERIOD):
            table[a, b] = next(k for k in range(PERIOD) if on[a + k] and on[b + k])
    return table


def _dense(*keys: np.ndarray) -> np.ndarray:
    """Ranks of rows by several keys, the first one foremost."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for key in keys:
        new[1:] |= key[order[1:]] != key[order[:-1]]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new)
    return rank


def cover_ranks(heads: np.ndarray, size: int, length: int = LENGTH) -> np.ndarray:
    """For each position on the cover its rank by ``length`` bytes or more, 0 elsewhere. ``heads`` are the eight bytes at each position."""
    places = (np.arange(0, size, PERIOD)[:, None] + np.array(COVER)).ravel()
    rank = _dense(*[heads[places + n] for n in (0, 8, 16, 24)]) + 1
    depth = PERIOD
    while depth < length:
        # One period on is len(COVER) cover positions on.
        after = np.zeros(len(rank), np.int64)
        step = depth // PERIOD * len(COVER)
        after[:-step] = rank[step:]
        rank = _dense(rank, after) + 1
        depth *= 2
    ranks = np.zeros(len(heads), np.int64)
    ranks[places] = rank
    return ranks


def repeated_starts(text: bytes, starts: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Which of the ``starts`` begin ``length`` bytes that begin at another of them too."""
    size = len(text)
    data = np.frombuffer(text + bytes(length + 2 * PERIOD + 32), np.uint8).astype(np.uint64)
    heads = np.zeros(len(data) - 7, np.uint64)
    for n in range(8):
        heads |= data[n : len(data) - 7 + n] << np.uint64(56 - 8 * n)
    ranks = cover_ranks(heads, size + PERIOD, length)
    offsets = common_offsets()
    found = np.zeros(len(starts), bool)
    by_head = np.argsort(heads[starts], kind="stable")
    in_order = heads[starts[by_head]]
    fresh = np.flatnonzero(np.append(True, in_order[1:] != in_order[:-1]))
    cuts = np.unique(np.append(fresh[np.searchsorted(fresh, np.arange(0, len(starts), RANGE))[: len(starts)].clip(0, len(fresh) - 1)], [0, len(starts)]))
    at, ranked, residues, table = None, None, None, None
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        members = by_head[low:high]
        places = starts[members]
        keys = [heads[places + n] for n in (0, 8, 16, 24)]
        order = np.lexsort(keys[::-1])
        members, places = members[order], places[order]
        tied = np.ones(len(places), bool)
        for key in keys:
            tied[1:] &= key[order[1:]] == key[order[:-1]]
        tied[0] = False
        firsts = np.flatnonzero(~tied)
        sizes = np.diff(np.append(firsts, len(places)))
        # Most ties are of two; larger ones are sorted by cover ranks.
        for first, count in zip(firsts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            if ranked is None:
                ranked, table = ranks.tolist(), offsets.tolist()

                def compare(one: tuple[int, int], other: tuple[int, int]) -> int:
                    k = table[one[0] % PERIOD][other[0] % PERIOD]
                    return ranked[one[0] + k] - ranked[other[0] + k]

            group = zip(places[first : first + count].tolist(), members[first : first + count].tolist(), strict=True)
            pairs = np.array(sorted(group, key=cmp_to_key(compare)), np.int64)
            places[first : first + count], members[first : first + count] = pairs[:, 0], pairs[:, 1]
        second = np.flatnonzero(tied)
        a, b = places[second - 1], places[second]
        equal = np.ones(len(second), bool)
        for n in [*range(32, length - 7, 8), length - 8]:
            equal &= heads[a + n] == heads[b + n]
        found[members[second[equal]]] = found[members[second[equal] - 1]] = True
    return found


def ranges(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the runs of true values."""
    change = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
    return change[::2], change[1::2]


# Spark.


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``id``, ``body`` and the identity of each text: ``tid`` (64-bit hash) and ``size`` in bytes. Equal texts share it; two
    different ones would need both in common."""
    rows = docs.select(F.col(f"`{key}`").alias("id"), whole_text(f"`{text}`").cast("string").alias("body"))
    return rows.select("id", "body", F.xxhash64("body").alias("tid"), F.octet_length("body").alias("size"))


def _met(texts: DataFrame, stored: DataFrame, held: Column, how: str) -> DataFrame:
    """Texts joined to what is stored of them. ``held`` says how many bytes the lists of a stored row take; if all together take
    little the stored side is broadcast, else both are shuffled."""
    held = stored.agg(F.sum((64 + held).cast("bigint"))).first()[0] or 0
    return texts.join(F.broadcast(stored) if held <= BROADCAST_LIMIT_BYTES else stored, ["tid", "size"], how)


def _bytes(text: pa.Scalar) -> np.ndarray:
    return np.frombuffer(text.as_buffer(), np.uint8) if text.as_buffer() else np.empty(0, np.uint8)


def anchor_hashes(texts: DataFrame, length: int, placed: bool) -> DataFrame:
    """``h`` of all anchors, with ``tid``, ``size`` and place ``at`` if asked for."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 64):
            found = [anchors(_bytes(t), length) for t in part.column(0)]
            columns = [pa.array(np.concatenate([f[0] for f in found]))]
            if placed:
                counts = np.array([len(f[0]) for f in found])
                columns += [pa.array(np.repeat(part.column(n).to_numpy(), counts)) for n in (1, 2)]
                columns.append(pa.array(np.concatenate([f[1] for f in found]), pa.int32()))
            yield pa.record_batch(columns, ["h", "tid", "size", "at"][: len(columns)])

    long = texts.where(F.col("size") >= length)
    return map_batches(
        long.select("body", "tid", "size") if placed else long.select("body"),
        of_batches,
        "h bigint, tid bigint, size int, at int" if placed else "h bigint",
    )


def contexts_of(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """Every wanted anchor once: hash ``h``, digest ``c`` of its context, ``tid``, ``size`` and the first and last start ``low``, ``high``."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 64):
            out: list[list] = [[] for _ in range(6)]
            for n in range(part.num_rows):
                data = _bytes(part.column(0)[n])
                tid, size = part.column(1)[n].as_py(), part.column(2)[n].as_py()
                hashed, at, first, last = anchors(data, length)
                chosen = np.flatnonzero(np.isin(at, part.column(3)[n].values.to_numpy(zero_copy_only=False)))
                for h, a, low, high in zip(*(x[chosen].tolist() for x in (hashed, at, first, last)), strict=True):
                    context = data[low : high + length].tobytes()
                    c = hashlib.md5(b"%d:" % (a - low) + context, usedforsecurity=False).digest()
                    for column, value in zip(out, (h, c, tid, size, low, high), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
            yield pa.record_batch([pa.array(v, k) for v, k in zip(out, kinds, strict=True)], ["h", "c", "tid", "size", "low", "high"])

    joined = _met(texts, wanted, 4 * F.size("places"), "inner")
    found = map_batches(
        joined.select("body", "tid", "size", "places"), of_batches, "h bigint, c binary, tid bigint, size int, low int, high int"
    )
    return found.distinct()


def cut_out(texts: DataFrame, chosen: DataFrame) -> DataFrame:
    """``h``, ``c`` and the ``context`` bytes of the chosen contexts (lists ``hs``, ``cs``, ``lows``, ``ends`` of each text)."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 64):
            hs, cs, pieces = [], [], []
            for n in range(part.num_rows):
                data = _bytes(part.column(0)[n])
                given = [part.column(k)[n].as_py() for k in range(1, 5)]
                for h, c, low, end in zip(*given, strict=True):
                    hs.append(h)
                    cs.append(c)
                    pieces.append(data[low:end].tobytes())
            yield pa.record_batch([pa.array(hs, pa.int64()), pa.array(cs, pa.binary()), pa.array(pieces, pa.binary())], ["h", "c", "context"])

    joined = _met(texts, chosen, 56 * F.size("hs"), "inner")
    found = map_batches(joined.select("body", "hs", "cs", "lows", "ends"), of_batches, "h bigint, c binary, context binary")
    return found.distinct()


def sorted_repeats(contexts: DataFrame, length: int) -> DataFrame:
    """``h``, ``c`` and the ranges ``begins``, ``ends`` of starts in a context that repeat in the same bucket.

    Buckets come in order of ``h``; a block ends with a bucket.
    """

    def solved(block: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
        starts, sizes, base = [], [], 0
        for _, _, context in block:
            sizes.append(len(context) - length + 1)
            starts.append(np.arange(base, base + sizes[-1]))
            base += len(context)
        marks = repeated_starts(b"".join(b[2] for b in block), np.concatenate(starts), length)
        out: list[list] = [[] for _ in range(4)]
        for (h, c, _), part in zip(block, np.split(marks, np.cumsum(sizes)[:-1]), strict=True):
            begins, ends = ranges(part)
            if len(begins):
                for column, value in zip(out, (h, c, begins.tolist(), ends.tolist()), strict=True):
                    column.append(value)
        kinds = (pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()))
        return pa.record_batch([pa.array(v, k) for v, k in zip(out, kinds, strict=True)], ["h", "c", "begins", "ends"])

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = [], 0
        for batch in batches:
            for h, c, context in zip(*(batch.column(n) for n in range(3)), strict=True):
                row = (h.as_py(), c.as_py(), context.as_py())
                if held > BLOCK_BYTES and row[0] != block[-1][0]:
                    yield solved(block)
                    block, held = [], 0
                block.append(row)
                held += len(row[2])
        if block:
            yield solved(block)

    dealt = contexts.select("h", "c", "context").repartition("h").sortWithinPartitions("h")
    return map_batches(dealt, of_batches, "h bigint, c binary, begins array<int>, ends array<int>")


def grouped_repeats(contexts: DataFrame, length: int) -> DataFrame:
    """The same for buckets of any size: the strings at all starts are grouped by their digest, added up before they are shuffled."""
    starts = F.sequence(F.lit(0), F.octet_length("context") - length)
    each = contexts.select("h", "c", "context", F.explode(starts).alias("begin"))
    string = F.substring(F.col("context"), F.col("begin") + 1, F.lit(length))
    each = each.select("h", "c", "begin", F.unhex(F.md5(string)).alias("string"))
    repeated = each.groupBy("string").agg(F.count("*").alias("n")).where("n > 1").select("string")
    found = each.join(repeated, "string", "left_semi").groupBy("h", "c").agg(F.sort_array(F.collect_list("begin")).alias("begins"))
    return found.select("h", "c", "begins", F.transform("begins", lambda b: b + 1).alias("ends"))


def joined_spans(spans: DataFrame) -> DataFrame:
    """The ``spans`` of each text with those that touch or overlap made one, so that what is left per text is little."""
    of_text = Window.partitionBy("tid", "size").orderBy("begin", "end")
    reached = F.max("end").over(of_text.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.withColumn("new", F.when(F.col("begin") <= reached, 0).otherwise(1))
    runs = marked.withColumn("run", F.sum("new").over(of_text)).groupBy("tid", "size", "run").agg(F.min("begin").alias("begin"), F.max("end").alias("end"))
    return runs.groupBy("tid", "size").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))


def repeated_spans(texts: DataFrame, length: int = LENGTH, crowded: int = CROWDED) -> DataFrame:
    """``tid``, ``size`` and the byte ranges ``spans`` (``begin``, ``end``) of each text that strings of ``length`` bytes found elsewhere cover."""
    spark = texts.sparkSession
    shared = anchor_hashes(texts, length, placed=False).groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    shared, shared_path = stage(shared, "shared-anchors")
    met = anchor_hashes(texts, length, placed=True).join(shared, "h", "left_semi").select("tid", "size", "at").distinct()
    wanted, wanted_path = stage(met.groupBy("tid", "size").agg(F.collect_list("at").alias("places")), "wanted-anchors")
    members, members_path = stage(contexts_of(texts, wanted, length), "anchor-contexts")
    # A context is fetched from one of the places it stands at.
    groups = members.groupBy("h", "c").agg(F.count("*").alias("n"), *[F.first(x).alias(x) for x in ("tid", "size", "low", "high")])
    groups, groups_path = stage(groups, "contexts")
    several = groups.groupBy("h").agg(F.count("*").alias("contexts")).where("contexts > 1")
    several, several_path = stage(several, "buckets")
    chosen = groups.join(several, "h").groupBy("tid", "size").agg(
        *[F.collect_list(x).alias(f"{name}s") for name, x in (("h", "h"), ("c", "c"), ("low", "low"))],
        F.collect_list(F.col("high") + length).alias("ends"),
    )
    chosen, chosen_path = stage(chosen, "chosen-contexts")
    bytes_, bytes_path = stage(cut_out(texts, chosen), "context-bytes")
    full = several.where(F.col("contexts") > crowded).select("h")
    in_order = sorted_repeats(bytes_.join(full, "h", "left_anti"), length)
    found = groups.where("n > 1").select("h", "c", F.array(F.lit(0)).alias("begins"), F.array(F.col("high") - F.col("low") + 1).alias("ends"))
    if not full.isEmpty():
        crowd, _ = stage(bytes_.join(full, "h", "left_semi"), "crowded-contexts")
        in_order = in_order.unionAll(grouped_repeats(crowd, length))
    found, found_path = stage(found.unionAll(in_order), "repeated-starts")
    pairs = members.join(found, ["h", "c"]).select("tid", "size", "low", F.explode(F.arrays_zip("begins", "ends")).alias("r"))
    spans = joined_spans(
        pairs.select("tid", "size", (F.col("low") + F.col("r.begins")).alias("begin"), (F.col("low") + F.col("r.ends") - 1 + length).alias("end"))
    )
    spans, _ = stage(spans, "spans")
    discard(spark, shared_path, wanted_path, members_path, groups_path, several_path, chosen_path, bytes_path, found_path)
    return spans


SCHEMA = "n_bytes bigint, n_removed bigint, n_spans bigint, begins array<bigint>, ends array<bigint>, kept binary, kept_sha256 string"


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, crowded: int = CROWDED, with_bytes: bool = True
) -> DataFrame:
    """Every document without the bytes that a string of ``length`` bytes covers which starts anywhere else too.

    One row per document: its key, ``n_bytes``, ``n_removed``, ``n_spans`` (removed runs), the runs (``begins``, ``ends``), the ``kept`` bytes
    (which may cut a character) and ``kept_sha256``; ``with_bytes`` set to false leaves the runs and the bytes out. Strings are
    judged on the input: no copy is spared. They do not cross documents; elsewhere includes the same document, overlapping too. NULL
    counts as empty; texts shorter than ``length`` stay. Repeated rows are copies of each other and each comes back. No documents
    give no rows; other columns are not read.
    """
    texts = _texts(docs, key, text)
    copies = texts.where(F.col("size") >= length).groupBy("tid", "size").agg(F.count("*").alias("copies")).where("copies > 1")
    whole = copies.select("tid", "size", F.array(F.struct(F.lit(0).alias("begin"), F.col("size").alias("end"))).alias("spans"))
    spans = repeated_spans(texts, length, crowded).unionByName(whole).groupBy("tid", "size").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    spans, _ = stage(spans, "all-spans")
    joined = _met(texts, spans, 32 * F.size("spans"), "left")
    kind = texts.schema["id"].dataType.simpleString()
    names = ["n_bytes", "n_removed", "n_spans", *(["begins", "ends", "kept"] if with_bytes else []), "kept_sha256"]
    kinds = {"begins": pa.list_(pa.int64()), "ends": pa.list_(pa.int64()), "kept": pa.binary(), "kept_sha256": pa.string()}
    ddl = dict(c.split() for c in SCHEMA.split(", "))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 64):
            out: dict[str, list] = {name: [] for name in ddl}
            for n in range(part.num_rows):
                data = _bytes(part.column(1)[n])
                change = np.zeros(len(data) + 1, np.int64)
                listed = part.column(2)[n]
                if listed.is_valid:
                    np.add.at(change, listed.values.field(0).to_numpy(), 1)
                    np.add.at(change, listed.values.field(1).to_numpy(), -1)
                gone = np.cumsum(change[:-1]) > 0
                begins, ends = ranges(gone)
                kept = data[~gone].tobytes()
                row = (len(data), int(gone.sum()), len(begins), begins.tolist(), ends.tolist(), kept, hashlib.sha256(kept).hexdigest())
                for column, value in zip(out.values(), row, strict=True):
                    column.append(value)
            yield pa.record_batch([part.column(0), *[pa.array(out[c], kinds.get(c, pa.int64())) for c in names]], ["id", *names])

    done = map_batches(joined.select("id", "body", "spans"), of_batches, ", ".join([f"id {kind}", *[f"{c} {ddl[c]}" for c in names]]))
    return done.withColumnRenamed("id", key)
