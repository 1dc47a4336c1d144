"""Token ids of documents in binary files, in the order of the documents' keys.

Ids are ranked by their frequency in the corpus, so that the commonest take one byte. A rank is written in one to four
bytes; two bits in a control byte of its own say how many, and four ranks share a control byte. Control bytes and data bytes stand apart, so
a block is decoded without a loop over ids: tables map each control byte to the lengths and the sum of lengths of its
four ranks, running sums give where each rank starts, and shifted bytes are added up.

A file is a row of blocks; a block is a header, the lengths of its documents, its control bytes and its data bytes. The manifest, a table that Spark writes, says
where each document stands. Only files named there count: what a task wrote before it was lost is never read.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
from collections.abc import Iterator
from functools import lru_cache
from itertools import compress, repeat
from operator import is_
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from pricelake.llm.common import map_batches, slices, stage
from pricelake.session import discard, work_path

END_ID = 2
MAGIC = b"PLVB"
#: magic, documents, ids, control bytes, data bytes.
HEADER = struct.Struct("<4sIQQQ")
BLOCK_IDS = 1 << 20
BLOCKS_PER_TASK = 8
#: Words a worker keeps the ids of, twice over.
KEPT_WORDS = 700_000
#: Words of an encoded line.
LINE_WORDS = 128
#: Letters (ASCII or of Latin-1) and the ASCII punctuation without the apostrophe that may follow: the tokenizer always cuts between them.
PUNCTUATED = re.compile(rb"((?:[a-z]|\xc3[\xa0-\xb6\xb8-\xbf])+)([!-&(-/:-;=-@\[-`{}~]*)")


# Encoding and decoding of ranks.


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of ranks below 2^32; the last control byte is filled up with ones of one byte."""
    ranks = ranks.astype("<u4")
    lengths = 1 + (ranks >= 1 << 8).astype(np.uint8) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    padded = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    padded[: len(ranks)] = lengths - 1
    control = padded.reshape(-1, 4) @ np.array([1, 4, 16, 64], np.uint8)
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) < lengths[:, None]]
    return control.astype(np.uint8).tobytes(), data.tobytes()


@lru_cache(maxsize=1)
def length_table() -> np.ndarray:
    """Byte lengths of the four ranks of each control byte."""
    return ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + np.uint8(1)


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    lengths = length_table()[np.frombuffer(control, np.uint8)].reshape(-1)[:count]
    starts = np.cumsum(lengths, dtype=np.int64) - lengths
    source = np.frombuffer(data + b"\0\0\0", np.uint8)
    ranks = source[starts].astype(np.uint32)
    for extra in (1, 2, 3):
        long = np.flatnonzero(lengths > extra)
        ranks[long] |= source[starts[long] + extra].astype(np.uint32) << np.uint32(8 * extra)
    return ranks


def write_block(ids: np.ndarray, lengths: np.ndarray, rank_of: np.ndarray) -> bytes:
    control, data = pack(rank_of[ids])
    header = HEADER.pack(MAGIC, len(lengths), len(ids), len(control), len(data))
    return b"".join((header, lengths.astype("<u4").tobytes(), control, data))


def read_block(file, id_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and document lengths of the block the file stands at."""
    magic, documents, ids, control, data = HEADER.unpack(file.read(HEADER.size))
    if magic != MAGIC:
        raise ValueError("no block starts here")
    lengths = np.frombuffer(file.read(4 * documents), "<u4")
    return id_of[unpack(file.read(control), file.read(data), ids)], lengths


# Tokenizing.


def id_kind(tokenizer: Tokenizer) -> str:
    """Ids go between tasks in two bytes if the vocabulary allows it, else in four."""
    return "<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4"


def letters_tokenizer(path: str) -> Tokenizer | None:
    """The tokenizer for lines of ``PUNCTUATED`` letters: they are in normal form and lower case, and cutting letters from the rest is
    cutting at white space, so its normaliser and its pattern are left out. None if it cuts in another way."""
    found = json.loads(Path(path).read_text("utf-8"))
    cuts = (found.get("pre_tokenizer") or {}).get("pretokenizers", [])
    steps = (found.get("normalizer") or {}).get("normalizers", [])
    plain = all(s["type"] in ("NFC", "Lowercase") or s.get("pattern") == {"Regex": r"\s+"} for s in steps)
    if [c["type"] for c in cuts] != ["Split", "ByteLevel"] or r"[\p{L}]+" not in str(cuts[0]["pattern"].get("Regex")) or not plain:
        return None
    found["normalizer"], cuts[0] = None, {"type": "WhitespaceSplit"}
    return Tokenizer.from_str(json.dumps(found))


class WordEncoder:
    """Ids of texts, word by word.

    The tokenizer splits at white space before anything else looks across it, so the ids of a text are those of
    its words one after the other. Ids of words are kept in two generations: when the young one is full it becomes the old one, from which
    words still met are taken over.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.kind = id_kind(self.tokenizer)
        self.lines = letters_tokenizer(path) or self.tokenizer
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        if suffix:
            self.ends[[n for piece, n in self.tokenizer.get_vocab().items() if piece.endswith(suffix)]] = True
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _ids(self, parts: list[bytes]) -> Iterator[bytes]:
        """Ids the tokenizer gives each of some words."""
        encoded = self.tokenizer.encode_batch_fast([p.decode("utf-8", "surrogatepass") for p in parts], add_special_tokens=False)
        return (np.array(e.ids, self.kind).tobytes() for e in encoded)

    def _ids_of_letters(self, found: list[bytes]) -> Iterator[bytes]:
        """The same of words of letters alone. In a line of many they cost half as much; the ids that end a word tell them apart."""
        if not self.ends.any():
            yield from self._ids(found)
            return
        groups = [found[n : n + LINE_WORDS] for n in range(0, len(found), LINE_WORDS)]
        lines = [b" ".join(g).decode("utf-8") for g in groups]
        for group, e in zip(groups, self.lines.encode_batch_fast(lines, add_special_tokens=False), strict=True):
            ids = np.array(e.ids, self.kind)
            content, edges = ids.tobytes(), (np.flatnonzero(self.ends[ids]) + 1) * ids.itemsize
            if len(edges) != len(group):
                raise ValueError("the tokenizer cuts words of letters")
            edges = [0, *edges.tolist()]
            yield from map(content.__getitem__, map(slice, edges, edges[1:]))

    def _learn(self, missing: set[bytes]) -> None:
        """Add words to the young generation: from the old one, from their letters and punctuation, or from the tokenizer."""
        young, old = self.young, self.old
        letters, whole, cut = [], [], []
        for word in missing:
            if (ids := old.get(word)) is not None:
                young[word] = ids
            elif (found := PUNCTUATED.fullmatch(word)) is None:
                whole.append(word)
            elif found[2]:
                cut.append((word, found[1], found[2]))
            else:
                letters.append(word)
        # A word just met may be the part of another.
        letters = list({*letters, *(core for _, core, _ in cut if core not in young)})
        whole += {marks for _, _, marks in cut if marks not in young}.difference(whole)
        young.update(zip(letters, self._ids_of_letters(letters), strict=True))
        young.update(zip(whole, self._ids(whole), strict=True))
        for word, core, marks in cut:
            young[word] = young[core] + young[marks]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian numbers, with the end id."""
        parts, end = [], np.array([END_ID], self.kind).tobytes()
        for text in texts:
            content = (text or "").encode("utf-8", "surrogatepass")
            # The tokenizer lower-cases, but looks for its special tokens before that.
            parts.append((content if b"<|" in content else content.lower()).split())
        out = []
        for start in range(0, len(parts), 64):
            block = parts[start : start + 64]
            if len(self.young) > KEPT_WORDS:
                self.old, self.young = self.young, {}
            known = [list(map(self.young.get, words)) for words in block]
            missing = set().union(*(compress(words, map(is_, ids, repeat(None))) for words, ids in zip(block, known, strict=True)))
            self._learn(missing)
            for words, ids in zip(block, known, strict=True):
                found = map(self.young.__getitem__, words) if None in ids else ids
                out.append(b"".join(found) + end)
        return out


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    """One for each Python worker, so that later tasks find the words of earlier ones."""
    return WordEncoder(path)


def tokenize(docs: DataFrame, tokenizer: str, key: str, text: str) -> DataFrame:
    """``id``, ``ids`` (little-endian numbers of ``id_kind``, with the end id) and ``place`` (a number of its own) of every row."""
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").cast("string").alias("body"))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        place = TaskContext.get().partitionId() << 33
        for part in slices(batches):
            ids = pa.array(encoder.encode(part.column(1).to_pylist()), pa.binary())
            yield pa.record_batch([part.column(0), ids, pa.array(place + np.arange(len(ids)), pa.int64())], ["id", "ids", "place"])
            place += len(ids)

    return map_batches(rows, of_batches, f"id {rows.schema['id'].dataType.simpleString()}, ids binary, place bigint")


def frequency_ranks(tokens: DataFrame, kind: str) -> np.ndarray:
    """Ids by falling frequency (ties by id): the id of each rank. Tasks count, Spark adds; no more rows than the vocabulary has."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for ids in batch.column(0):
                counts = np.bincount(np.frombuffer(ids.as_buffer(), kind))
                if len(counts) > len(total):
                    total = np.append(total, np.zeros(len(counts) - len(total), np.int64))
                total[: len(counts)] += counts
        ids = np.flatnonzero(total)
        yield pa.record_batch([pa.array(ids), pa.array(total[ids])], ["token", "times"])

    counts = map_batches(tokens.select("ids"), counted, "token bigint, times bigint").groupBy("token").agg(F.sum("times").alias("times"))
    found = counts.orderBy(F.desc("times"), "token").select("token").toPandas()
    return found["token"].to_numpy(np.uint32)


# Files.


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def _written(place: str, id_of, kind: str):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = id_of.value
        rank_of = np.zeros(int(ranks.max()) + 1 if len(ranks) else 1, np.uint32)
        rank_of[ranks] = np.arange(len(ranks), dtype=np.uint32)
        part = TaskContext.get().partitionId()
        store, folder = _open(place)
        name, file, offset, block = f"{part:06d}-{uuid.uuid4().hex}.ids", None, 0, 0
        pending, keys, size, width = [], [], 0, np.dtype(kind).itemsize

        def flush():
            nonlocal offset, block, pending, keys, size
            lengths = np.array([len(p) // width for p in pending])
            content = write_block(np.frombuffer(b"".join(pending), kind), lengths, rank_of)
            file.write(content)
            held = pa.concat_arrays(keys)
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64())
            row = [pa.array([v], k) for v, k in zip((part, block, name, offset, int(lengths.sum())), kinds, strict=True)]
            row.append(pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), held))
            offset, block, pending, keys, size = offset + len(content), block + 1, [], [], 0
            return pa.RecordBatch.from_arrays(row, ["part", "block", "file", "offset", "n_ids", "keys"])

        for batch in batches:
            if file is None:
                store.create_dir(folder, recursive=True)
                file = store.open_output_stream(f"{folder}/{name}")
            first = 0
            for n, ids in enumerate(batch.column(1)):
                pending.append(ids.as_py())
                size += len(pending[-1]) // width
                if size >= BLOCK_IDS:
                    keys.append(batch.column(0).slice(first, n + 1 - first))
                    first = n + 1
                    yield flush()
            if first < batch.num_rows:
                keys.append(batch.column(0).slice(first))
        if pending:
            yield flush()
        if file is not None:
            file.close()

    return of_batches


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write all documents and return the manifest: a row for each block, with ``part`` and ``block`` giving the order.

    Beside the blocks the manifest table holds ``id_of`` as ``ranks`` in a table of its own. NULL and empty texts have the end id alone. A NULL key comes
    first; rows with equal keys stand in the order of a digest of their ids. No documents give no files and an empty manifest.
    """
    spark = docs.sparkSession
    tokens, tokens_path = stage(tokenize(docs, tokenizer, key, text), "token-ids")
    width = id_kind(Tokenizer.from_file(tokenizer))
    id_of = frequency_ranks(tokens, width)
    kind = tokens.schema["id"].dataType.simpleString()
    # Spark samples what it ranges by, and the ids of texts are long: a digest and the place stand for them. A key that very many rows have
    # fills as many ranges as it needs, equal texts included.
    order = [F.col("id").asc_nulls_first(), F.col("digest"), F.col("place")]
    ordered = tokens.withColumn("digest", F.xxhash64("ids")).repartitionByRange(*order).sortWithinPartitions(*order).select("id", "ids")
    schema = f"part int, block int, file string, offset bigint, n_ids bigint, keys array<{kind}>"
    blocks = map_batches(ordered, _written(folder, spark.sparkContext.broadcast(id_of), width), schema)
    blocks.write.parquet(f"{folder}/manifest")
    ranks = T.StructType([T.StructField("rank", T.LongType()), T.StructField("token", T.LongType())])
    spark.createDataFrame([(n, int(t)) for n, t in enumerate(id_of)], ranks).coalesce(1).write.parquet(f"{folder}/ranks")
    discard(spark, tokens_path)
    return spark.read.schema(schema).parquet(f"{folder}/manifest")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of the files in order of ``start``: ``id``, ``start`` (ids before it), ``n_tokens`` and ``ids`` (binary, as 32-bit numbers)."""
    manifest = spark.read.parquet(f"{folder}/manifest")
    id_of = spark.read.parquet(f"{folder}/ranks").orderBy("rank").toPandas()["token"].to_numpy(np.uint32)
    shared = spark.sparkContext.broadcast(id_of)
    # A file's first id: one row a file meets in this window. A block's: the blocks before it in its file.
    files = manifest.groupBy("part").agg(F.sum("n_ids").alias("in_file"))
    before = F.coalesce(F.sum("in_file").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = files.select("part", before.alias("before_file"))
    earlier = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("in_earlier", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0))).join(files, "part")
    placed = placed.select("file", "offset", (F.col("before_file") + F.col("in_earlier")).alias("start"), "keys")
    # The manifest is small and would be read in one task; a task for every few blocks reads them on many cores.
    placed = placed.repartition(manifest.count() // BLOCKS_PER_TASK + 1, "file", "offset")

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        for batch in batches:
            for file, offset, start, keys in zip(*batch.columns, strict=True):
                with store.open_input_file(f"{root}/{file.as_py()}") as source:
                    source.seek(offset.as_py())
                    ids, lengths = read_block(source, shared.value)
                ends = np.cumsum(lengths, dtype=np.int64)
                content = ids.astype("<u4").tobytes()
                parts = [content[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                starts = pa.array(start.as_py() + ends - lengths, pa.int64())
                yield pa.record_batch([keys.values, starts, pa.array(lengths, pa.int64()), pa.array(parts, pa.binary())], names)

    names = ["id", "start", "n_tokens", "ids"]
    kind = manifest.schema["keys"].dataType.elementType.simpleString()
    return map_batches(placed, of_batches, f"id {kind}, start bigint, n_tokens bigint, ids binary")


def checksums(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """``start``, ``n_tokens`` and ``ids_crc32`` of documents read from token files."""
    return rows.select(F.col("id").alias(key), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def token_files_round_trip(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the files to the shared folder and return what reading them back gives."""
    folder = work_path(docs.sparkSession, "token-files")
    write_token_files(docs, tokenizer, folder, key, text)
    return read_token_files(docs.sparkSession, folder)
