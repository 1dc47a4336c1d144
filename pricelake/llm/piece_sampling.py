"""Sampled segmentations with the pieces of a SentencePiece model, and their lossless decoding.

The pieces that fit a text at each place form a lattice. A forward pass sums the weights of all ways to reach each place; a
backward pass from the end draws each piece in proportion to the ways that end with it, so a whole segmentation is drawn from its exact
distribution. The number drawn at a place depends on the row's key, the seed and the place alone, so the same row gives the same pieces in every
run and partition.

Two neighbouring characters that stand together in no piece are cut apart by every segmentation. So the lattice is the chain of
the lattices of the runs between such cuts: equal runs share one forward pass.

The public model is a byte-pair one without probabilities; a piece is weighted by its place in the vocabulary instead, as
1 / (place + 2) to the power ``sharpness``. A character without a piece is spelt in bytes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.llm.common import map_batches, slices

SEED = 1
SHARPNESS = 1.0
#: Runs up to this length are kept for the next ones alike; beyond this many nodes all are forgotten before the next block.
KEPT_RUN, KEPT_NODES = 48, 1_500_000
BLOCK_CHARS = 250_000
GROUP_CHARS = 50_000
SPACE = "▁"
#: Runs of characters are looked up by a polynomial hash; pieces have 16 characters or so, too few for its known collisions.
BASE, MIX, SLOT_BITS = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), 19
#: Pairs of characters below this code point are looked up in a table.
COMMON_POINTS = 1024


class Pieces:
    """Pieces of a model as texts with plain spaces, their weights, and the ids of the bytes."""

    def __init__(self, model: str, sharpness: float):
        processor = sentencepiece.SentencePieceProcessor(model_file=model)
        self.ids: dict[str, int] = {}
        self.content: list[bytes] = []
        self.byte_ids = [0] * 256
        for n in range(processor.vocab_size()):
            piece = processor.id_to_piece(n)
            if processor.is_byte(n):
                self.byte_ids[int(piece[3:5], 16)] = n
                self.content.append(bytes([int(piece[3:5], 16)]))
            elif processor.is_control(n) or processor.is_unknown(n) or processor.is_unused(n):
                self.content.append(b"")
            else:
                self.ids[piece.replace(SPACE, " ")] = n
                self.content.append(piece.replace(SPACE, " ").encode())
        if any(" " in piece.lstrip(" ") for piece in self.ids):
            raise ValueError("a piece holds a space after another character")
        self.longest = max(map(len, self.ids))
        first = min(self.ids.values())
        self.weight = {piece: -sharpness * math.log(n - first + 2) for piece, n in self.ids.items()}
        self.byte_weight = -sharpness * math.log(len(self.content) + 2)
        self.keys = np.array([self._hash(p) for p in self.ids] + [0], np.uint64)
        if len(np.unique(self.keys)) < len(self.keys):
            raise ValueError("two pieces have the same hash")
        # The last place is that of no piece.
        self.codes = np.array([*self.ids.values(), -1], np.int32)
        self.sizes = np.array([*map(len, self.ids), 0], np.int32)
        self.weights = np.array([*map(self.weight.__getitem__, self.ids), -np.inf])
        self.first, self.second = self._tables()
        pairs = {(ord(a), ord(b)) for piece in self.ids for a, b in zip(piece, piece[1:], strict=False)}
        self.pairs = np.array(sorted(a << 21 | b for a, b in pairs), np.int64)
        self.common_pairs = np.zeros((COMMON_POINTS, COMMON_POINTS), bool)
        for x, y in pairs:
            if x < COMMON_POINTS and y < COMMON_POINTS:
                self.common_pairs[x, y] = True

    def _tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Place of each hash under its upper bits; of those that meet there, all but the last under other bits. The mixer is the
        first one under which no two of these meet again."""
        none, slots = len(self.keys) - 1, 1 << SLOT_BITS
        for n in range(1000):
            self.mix = MIX + np.uint64(2 * n)
            first, second = np.full(slots, none, np.int32), np.full(slots, none, np.int32)
            upper, other = self._slots(self.keys[:-1])
            first[upper] = np.arange(none)
            left = np.flatnonzero(first[upper] != np.arange(none))
            second[other[left]] = left
            if (second[other[left]] == left).all():
                return first, second
        raise ValueError("the tables are too small for this model")

    def _slots(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mixed = hashes * self.mix
        low = (mixed >> np.uint64(20)) & np.uint64((1 << SLOT_BITS) - 1)
        return (mixed >> np.uint64(64 - SLOT_BITS)).astype(np.int64), low.astype(np.int64)

    def cuts(self, points: np.ndarray) -> np.ndarray:
        """Places before which a text is cut: between characters that no piece holds together."""
        before, after = points[:-1], points[1:]
        joined = self.common_pairs[np.minimum(before, COMMON_POINTS - 1), np.minimum(after, COMMON_POINTS - 1)]
        rare = np.flatnonzero((before >= COMMON_POINTS - 1) | (after >= COMMON_POINTS - 1))
        if len(rare):
            pair = before[rare].astype(np.int64) << 21 | after[rare]
            place = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            joined[rare] = self.pairs[place] == pair
        return np.flatnonzero(~joined) + 1

    @staticmethod
    def _hash(text: str) -> int:
        total = 0
        for letter in text:
            total = (total * int(BASE) + ord(letter)) % (1 << 64)
        return total

    def lookup(self, hashes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Weights and ids of the pieces with these hashes, of up to ``most`` characters, the last column one; -inf and -1 for none."""
        hashes = hashes[:, -most:]
        upper, other = self._slots(hashes)
        place, more = self.first[upper], self.second[other]
        place = np.where(self.keys[place] == hashes, place, more)
        place[(self.keys[place] != hashes) | (self.sizes[place] != np.arange(most, 0, -1))] = len(self.keys) - 1
        return self.weights[place], self.codes[place]


class Lattices:
    """Forward passes of runs, as flat arrays: for each node the cumulated shares of the pieces that end there.

    Node k has shares in (k, k + 1], its first one at ``first[k]``.
    """

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        #: Ids of everything an edge can stand for: the pieces, then characters spelt in bytes.
        self.spelling: list[list[int]] = [[n] for n in range(len(pieces.content))]
        self.spelt: dict[str, int] = {}
        self.shares, self.piece, self.length = np.empty(1 << 20), np.empty(1 << 20, np.int32), np.empty(1 << 20, np.int32)
        self.first = np.empty(1 << 19, np.int32)
        self.clear()

    def clear(self) -> None:
        self.runs: dict[str, int] = {}
        self.nodes = self.edges = 0

    def _code(self, piece: str) -> int:
        found = self.pieces.ids.get(piece)
        if found is None:
            found = self.spelt.get(piece)
        if found is None:
            found = self.spelt[piece] = len(self.spelling)
            self.spelling.append([self.pieces.byte_ids[b] for b in piece.encode("utf-8", "surrogatepass")])
        return found

    def _forward(self, run_texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Forward passes of runs, longest first, all at once: (node, share, code, length) of every piece that fits.

        Nodes are counted from the first one of the first run. Column k stands for the piece of ``longest - k`` characters, so
        pieces stand by their start.
        """
        pieces, longest = self.pieces, self.pieces.longest
        sizes = np.array([len(r) for r in run_texts])
        points = np.zeros((len(run_texts), sizes[0]), np.uint64)
        letters = np.frombuffer("".join(run_texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        points[np.arange(sizes[0]) < sizes[:, None]] = letters
        first_node = np.cumsum(sizes) - sizes
        # Column n of the window is the sum of all ways to the place longest - n before the current one.
        window = np.full((len(run_texts), longest), -np.inf)
        window[:, -1] = 0.0
        hashes = np.zeros((len(run_texts), longest), np.uint64)
        out = []
        for end in range(1, sizes[0] + 1):
            active = int(np.searchsorted(-sizes, -end, side="right"))
            window, hashes, last = window[:active], hashes[:active], points[:active, end - 1]
            hashes[:, :-1] = hashes[:, 1:] * BASE + last[:, None]
            hashes[:, -1] = last
            weight, code = pieces.lookup(hashes, min(end, longest))
            missing = np.flatnonzero(code[:, -1] < 0)
            if len(missing):
                characters, which = np.unique(last[missing], return_inverse=True)
                texts = [chr(c) for c in characters.tolist()]
                code[missing, -1] = np.array([self._code(t) for t in texts], np.int32)[which]
                spelt = np.array([pieces.byte_weight * len(t.encode("utf-8", "surrogatepass")) for t in texts])
                weight[missing, -1] = spelt[which]
            sums = window[:, -weight.shape[1] :] + weight
            top = sums.max(axis=1, keepdims=True)
            parts = np.exp(sums - top)
            reached = np.cumsum(parts, axis=1)
            total = reached[:, -1:]
            shares = reached / total
            # The last piece that fits is the last column: one character always does.
            shares[:, -1] = 1.0
            row, column = np.nonzero(code >= 0)
            out.append(((first_node[row] + end - 1), shares[row, column], code[row, column], weight.shape[1] - column))
            window = np.append(window[:, 1:], top + np.log(total), axis=1)
        return tuple(map(np.concatenate, zip(*out, strict=True)))

    def learn(self, found: set[str]) -> None:
        """Forward passes of the runs not met so far, in groups of alike length."""
        new = sorted(found.difference(self.runs), key=lambda r: (-len(r), r))
        start = 0
        while start < len(new):
            stop = min(len(new), start + max(1, GROUP_CHARS // len(new[start])))
            group = new[start:stop]
            node, share, code, length = self._forward(group)
            order = np.argsort(node, kind="stable")
            end = self.edges + len(order)
            while end > len(self.shares):
                self.shares, self.piece, self.length = (np.append(x, np.empty_like(x)) for x in (self.shares, self.piece, self.length))
            self.shares[self.edges : end] = (self.nodes + node + share)[order]
            self.piece[self.edges : end], self.length[self.edges : end] = code[order], length[order]
            nodes = self.nodes + sum(map(len, group))
            while nodes > len(self.first):
                self.first = np.append(self.first, np.empty_like(self.first))
            self.first[self.nodes : nodes] = self.edges + np.searchsorted(node[order], np.arange(nodes - self.nodes))
            self.edges = end
            for run in group:
                self.nodes += len(run)
                self.runs[run] = self.nodes - 1
            start = stop


def drawn(seeds: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A number in [0, 1) for each key and place: the SplitMix64 mixer (fixed values) over both."""
    mixed = seeds + (places.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((mixed ^ (mixed >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / 2**53


def row_seed(key: object, seed: int) -> int:
    return xxhash.xxh64_intdigest(str(key).encode(), seed)


def sample_block(lattices: Lattices, texts: list[str], seeds: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all texts one after the other, and how many each text has. The last place of a text counts its characters
    and the space put before it."""
    if lattices.nodes > KEPT_NODES:
        lattices.clear()
    whole = "".join([" " + t for t in texts if t])
    if not whole:
        return np.empty(0, np.int32), np.zeros(len(texts), np.int64)
    sizes = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
    bounds = np.zeros(len(points) + 1, bool)
    bounds[lattices.pieces.cuts(points)] = True
    bounds[starts] = bounds[-1] = True
    bounds = np.flatnonzero(bounds)
    places = bounds.tolist()
    found = [whole[a:b] for a, b in zip(places, places[1:], strict=False)]
    distinct = set(found)
    lattices.learn(distinct)
    node = np.fromiter(map(lattices.runs.__getitem__, found), np.int64, len(found))
    left, ends = np.diff(bounds), bounds[1:]
    # A long run is hardly met again.
    for run in distinct:
        if len(run) > KEPT_RUN:
            del lattices.runs[run]
    shares, piece, length = (x[: lattices.edges] for x in (lattices.shares, lattices.piece, lattices.length))
    # Texts that are empty start where the next one does, so the last one that starts at or before a run is its own.
    owner = np.searchsorted(starts, bounds[:-1], side="right") - 1
    seed, place = np.array(seeds, np.uint64)[owner], ends - starts[owner]
    # The piece that ends at each place, -1 inside pieces: read in order it is the segmentation.
    ending = np.full(int(sizes.sum()) + 1, -1, np.int32)
    while len(node):
        wanted, edge = node + drawn(seed, place), lattices.first[node].astype(np.int64)
        below = np.flatnonzero(shares[edge] <= wanted)
        while len(below):
            edge[below] += 1
            below = below[shares[edge[below]] <= wanted[below]]
        ending[ends] = piece[edge]
        step = length[edge]
        left = left - step
        more = np.flatnonzero(left > 0)
        step = step[more]
        node, place, ends, seed, left = node[more] - step, place[more] - step, ends[more] - step, seed[more], left[more]
    cut = ending >= 0
    codes = ending[cut]
    until = np.append(0, np.cumsum(cut[1:]))
    per_text = until[starts + sizes] - until[starts]
    spelling = lattices.spelling
    if codes.max() >= len(lattices.pieces.content):
        parts = [spelling[c] for c in codes.tolist()]
        sizes_of = np.fromiter(map(len, parts), np.int64, len(parts))
        per_text = np.bincount(np.repeat(np.arange(len(texts)), per_text), weights=sizes_of, minlength=len(texts)).astype(np.int64)
        codes = np.fromiter((i for part in parts for i in part), np.int32, int(sizes_of.sum()))
    return codes, per_text


@lru_cache(maxsize=4)
def _lattices(model: str, sharpness: float) -> Lattices:
    """One for each Python worker, so that later tasks find the runs of earlier ones."""
    return Lattices(Pieces(model, sharpness))


@lru_cache(maxsize=4)
def _content(model: str) -> list[bytes]:
    return Pieces(model, 1.0).content


def _blocks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for n, text in enumerate(texts):
        size += len(text or "")
        if size > BLOCK_CHARS:
            yield start, n + 1
            start, size = n + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encode(
    docs: DataFrame,
    model: str,
    key: str = "doc_id",
    text: str = "text",
    output: str = "pieces",
    seed: int = SEED,
    sharpness: float = SHARPNESS,
    decoded: str | None = None,
) -> DataFrame:
    """All columns of ``docs`` and ``output``, the ids of a sampled segmentation (an array, empty for NULL and empty texts).

    With ``decoded`` the ids are decoded in the same pass to a column of that name. Columns with the names of new ones are replaced. Rows with equal key and text get the same pieces; a NULL key is a key like any other. ``model`` is the
    model file's path on the executors. Texts are taken whole.
    """
    added = [output, decoded] if decoded else [output]
    docs = docs.drop(*(c for c in added if c not in (key, text)))
    key_at, text_at = docs.columns.index(key), docs.columns.index(text)
    names = [*docs.columns, *added]

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices = _lattices(model, sharpness)
        for batch in slices(batches):
            keys, texts = batch.column(key_at).to_pylist(), batch.column(text_at).to_pylist()
            for start, stop in _blocks(texts):
                seeds = [row_seed(k, seed) for k in keys[start:stop]]
                codes, counts = sample_block(lattices, [t or "" for t in texts[start:stop]], seeds)
                bounds = np.append(0, np.cumsum(counts))
                new = [pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(codes, pa.int32()))]
                if decoded:
                    new.append(pa.array(spell(lattices.pieces.content, codes, bounds), pa.string()))
                yield pa.RecordBatch.from_arrays([*batch.slice(start, stop - start).columns, *new], names)

    kinds = [T.StructField(output, T.ArrayType(T.IntegerType())), *([T.StructField(decoded, T.StringType())] if decoded else [])]
    return map_batches(docs, of_batches, T.StructType([*docs.schema.fields, *kinds]))


def spell(content: list[bytes], ids: np.ndarray, bounds: np.ndarray) -> list[str]:
    """Texts of the pieces between each two bounds, without the space put before them."""
    spelt = list(map(content.__getitem__, ids.tolist()))
    return [b"".join(spelt[a:b])[1:].decode("utf-8", "surrogatepass") for a, b in zip(bounds, bounds[1:], strict=False)]


def decode(rows: DataFrame, model: str, pieces: str = "pieces", output: str = "decoded") -> DataFrame:
    """All columns of ``rows`` and ``output``, the text the pieces spell: exactly the text that was encoded.

    No pieces, and NULL for pieces, give the empty text. A column named ``output`` is replaced.
    """
    rows = rows.drop(output)
    at = rows.columns.index(pieces)
    names = [*rows.columns, output]

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        content = _content(model)
        for part in slices(batches):
            column = part.column(at).fill_null([])
            bounds = column.offsets.to_numpy()
            ids = column.values.to_numpy(zero_copy_only=False)[bounds[0] : bounds[-1]]
            texts = spell(content, ids, bounds - bounds[0])
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names)

    return map_batches(rows, of_batches, T.StructType([*rows.schema.fields, T.StructField(output, T.StringType())]))


def encode_and_decode(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All documents with their text decoded from their pieces, then ``pieces`` and ``n_pieces``. NULL texts come back empty.

    Columns of the documents called like one of the two, or ``decoded``, are replaced or left out.
    """
    encoded = encode(docs, model, key, text, decoded="decoded")
    added = ("pieces", "n_pieces", "decoded")
    columns = [F.col("decoded").alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns if c not in added]
    return encoded.select(*columns, "pieces", F.size("pieces").alias("n_pieces"))
