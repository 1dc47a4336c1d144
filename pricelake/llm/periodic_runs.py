"""Periodic runs of words inside texts, found by uniting suffix classes in order of falling LCP.

A run is a stretch of words with a smallest period q that no neighbouring word extends. If it starts at s, the suffixes at
s and s + q share a prefix of its length less q. Suffixes are kept in classes, each an ordered set of positions. Classes are united
from the longest common prefix downwards, as Kruskal's algorithm unites trees: at prefix length l two positions become neighbours in an
ordered set, and if they lie no more than l apart, the words from the first on repeat with that distance. A position between two such
neighbours would give the stretch a smaller period, so each run is met once, from its own start, with its smallest period.

A run of at least twelve words has a shared prefix of six words or more. Suffixes that share fewer with all others stay alone: their
classes are never made. Texts of one block share the sorting but not their classes.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import map_batches, whole_text

LEAST_LENGTH = 12
#: A run of LEAST_LENGTH words or more with period q shares max(q, LEAST_LENGTH - q) words between its first two periods.
LEAST_SHARED = LEAST_LENGTH // 2
#: Words sorted together; a longer text is a block of its own.
BLOCK_WORDS = 100_000

SCHEMA = (
    "n_words bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "starts array<bigint>, lengths array<bigint>, periods array<bigint>, collapsed string"
)


def numbered(texts: Sequence[Sequence[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Words of all texts as numbers that no two texts share, with a number of its own before each text and after the last.

    Returns the numbers and where each text starts; the end of a text is two before the start of the next.
    """
    out, starts, base = [], [], 0
    for parts in texts:
        out.append(base)
        base += 1
        starts.append(len(out))
        index = {w: n for n, w in enumerate(dict.fromkeys(parts), base)}
        base += len(index)
        out.extend(map(index.__getitem__, parts))
    out.append(base)
    starts.append(len(out))
    return np.array(out, np.int64), np.array(starts, np.int64)


def _paired(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Dense ranks of pairs, in their order."""
    return np.unique(first * (int(second.max()) + 1) + second, return_inverse=True)[1]


def _shifted(values: np.ndarray, by: int) -> np.ndarray:
    out = np.zeros(len(values), np.int64)
    out[: max(len(values) - by, 0)] = values[by:] + 1
    return out


def suffix_order(seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose next LEAST_SHARED (six) numbers occur elsewhere too, in suffix order, and whether each starts a new class.

    Ranks by two, four and six numbers come from pairs; then only the classes with several members are sorted on, by the rank
    at twice the depth each round, until all are apart.
    """
    two = _paired(seq, _shifted(seq, 1))
    rank = _paired(_paired(two, _shifted(two, 2)), _shifted(two, 4))
    order = np.argsort(rank, kind="stable")
    sizes = np.bincount(rank)
    held = np.repeat(sizes > 1, sizes)
    order = order[held]
    if not len(order):
        return order, np.empty(0, bool)
    rank = (np.cumsum(sizes) - sizes)[rank]
    fresh = np.ones(len(order), bool)
    fresh[1:] = rank[order[1:]] != rank[order[:-1]]
    depth, live = LEAST_SHARED, np.arange(len(order))
    while len(live):
        members = order[live]
        ahead = members + depth
        second = np.where(ahead < len(seq), rank[np.minimum(ahead, len(seq) - 1)], -1)
        first = rank[members]
        by = np.lexsort((second, first))
        members, first, second = members[by], first[by], second[by]
        order[live] = members
        new = np.ones(len(members), bool)
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        group = np.cumsum(new) - 1
        heads = np.flatnonzero(new)
        of_class = np.ones(len(members), bool)
        of_class[1:] = first[1:] != first[:-1]
        class_head = np.maximum.accumulate(np.where(of_class, np.arange(len(members)), 0))
        rank[members] = first + (heads[group] - class_head)
        live = live[np.bincount(group)[group] > 1]
        depth *= 2
    return order, fresh


def shared_prefixes(seq: Sequence[int], order: Sequence[int], fresh: Sequence[bool]) -> list[tuple[int, int, int]]:
    """(shared length, position, the position before it in suffix order) of all neighbours within a class.

    Positions are taken in text order, where the length falls by at most one from one to the next.
    """
    before = {p: q for p, q, new in zip(order[1:], order[:-1], fresh[1:], strict=True) if not new}
    out, shared, last = [], 0, -2
    for p in sorted(before):
        q = before[p]
        shared = max(shared - 1, LEAST_SHARED) if p == last + 1 else LEAST_SHARED
        while seq[p + shared] == seq[q + shared]:
            shared += 1
        out.append((shared, p, q))
        last = p
    return out


def seeds(links: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """(position, next position, shared length) of positions that become neighbours no further apart than they share.

    The smaller set goes into the larger one, so a position moves at most log n times.
    """
    root: dict[int, int] = {}
    members: dict[int, list[int]] = {}

    def find(p: int) -> int:
        top = p
        while (up := root.get(top, top)) != top:
            top = up
        while p != top:
            up = root.get(p, top)
            root[p] = top
            p = up
        return top

    for shared, p, q in sorted(links, key=lambda link: -link[0]):
        a, b = find(p), find(q)
        large, small = members.pop(a, None) or [a], members.pop(b, None) or [b]
        if len(large) < len(small):
            a, b, large, small = b, a, small, large
        root[b] = a
        members[a] = large
        last, low = -1, 0
        for n, x in enumerate(small):
            low = bisect_left(large, x, low)
            if low and large[low - 1] != last and x - large[low - 1] <= shared:
                yield large[low - 1], x, shared
            if low < len(large) and large[low] - x <= shared and (n + 1 == len(small) or large[low] < small[n + 1]):
                yield x, large[low], shared
            large.insert(low, x)
            last, low = x, low + 1


def runs_of(texts: Sequence[Sequence[bytes]]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of all runs of each text, by start, then period."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not any(texts):
        return found
    numbers, starts = numbered(texts)
    order, fresh = suffix_order(numbers)
    if not len(order):
        return found
    seq = numbers.tolist()
    for p, q, shared in seeds(shared_prefixes(seq, order.tolist(), fresh.tolist())):
        if q - p + shared >= LEAST_LENGTH and seq[p - 1] != seq[q - 1]:
            text = int(np.searchsorted(starts, p, "right")) - 1
            found[text].append((p - int(starts[text]), q - p + shared, q - p))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def collapsed(parts: Sequence[bytes], runs: Sequence[tuple[int, int, int]]) -> bytes:
    """Words outside runs and those of the first period of each, but for the ones another run drops, joined by spaces."""
    if not runs:
        return b" ".join(parts)
    change = np.zeros(len(parts) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    return b" ".join([parts[n] for n in kept.tolist()])


def planted(parts: list[bytes], key: int | None) -> list[bytes]:
    """Words of a text in every tenth of which, by the checksum of its key, a tail is made to repeat."""
    checksum = zlib.crc32(b"" if key is None else str(key).encode())
    if checksum % 10 or not parts:
        return parts
    times = checksum // 10
    head = times % len(parts)
    period = 1 + (len(parts) - head) // (3 + times % 8)
    return parts[:head] + [parts[head + n % period] for n in range(len(parts) - head)]


def _blocks(batches: Iterator[pa.RecordBatch], plant: bool) -> Iterator[tuple[list, list[list[bytes]]]]:
    keys, texts, size = [], [], 0
    for batch in batches:
        for key, text in zip(batch.column(0), batch.column(1), strict=True):
            parts = text.as_py().encode("utf-8", "surrogatepass").split()
            if texts and size + len(parts) > BLOCK_WORDS:
                yield keys, texts
                keys, texts, size = [], [], 0
            key = key.as_py()
            keys.append(key)
            texts.append(planted(parts, key) if plant else parts)
            size += len(parts) + 1
    if texts:
        yield keys, texts


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", plant: bool = False, with_text: bool = True) -> DataFrame:
    """Runs of words of every text, one row per document: its key, ``n_words``, ``n_runs``, the longest run (``start``, ``length``,
    ``period``, ``exponent_milli``; NULL without a run), all runs (``starts``, ``lengths``, ``periods``) and the ``collapsed`` text.

    Words are parted by spaces and the bytes 0x09 to 0x0D. Of runs of equal length the first start, then the smallest period is the
    longest. ``collapsed`` keeps of every run its first period. A NULL or empty text has no words, no runs and an empty collapsed text.
    Repeated rows each come back; a NULL key is kept. No documents give no rows; other columns are not read. ``plant`` makes the
    words of a tenth of the documents repeat first. ``with_text`` set to false gives digests in place of runs and text:
    ``runs_sha256`` (lines of start, length and period) and ``collapsed_sha256``.
    """
    rows = docs.select(F.col(f"`{key}`").alias("id"), whole_text(f"`{text}`").cast("string").alias("body"))
    kind = rows.schema["id"].dataType
    columns = SCHEMA if with_text else SCHEMA.partition("starts array")[0] + "runs_sha256 string, collapsed_sha256 string"
    names = ["id", *[c.split()[0] for c in columns.split(", ")]]
    types = [pa.int64()] * 6 + ([pa.list_(pa.int64())] * 3 + [pa.string()] if with_text else [pa.string()] * 2)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_type = None

        def watched():
            nonlocal id_type
            for batch in batches:
                id_type = batch.schema.field(0).type
                yield batch

        for keys, texts in _blocks(watched(), plant):
            out: list[list] = [[] for _ in types]
            for parts, runs in zip(texts, runs_of(texts), strict=True):
                longest = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
                start, length, period = longest or (None, None, None)
                row = [len(parts), len(runs), start, length, period, longest and 1000 * length // period]
                if with_text:
                    row += [[r[n] for r in runs] for n in range(3)]
                    row.append(collapsed(parts, runs).decode("utf-8", "replace"))
                else:
                    lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
                    row += [hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed(parts, runs)).hexdigest()]
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            columns_ = [pa.array(keys, id_type), *[pa.array(v, t) for v, t in zip(out, types, strict=True)]]
            yield pa.record_batch(columns_, names)

    return map_batches(rows, of_batches, f"id {kind.simpleString()}, {columns}").withColumnRenamed("id", key)
