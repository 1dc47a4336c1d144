"""Languages by hyperdimensional profiles of letter trigrams.

Each letter has a random vector of -1 and 1. A trigram is bound: the vectors of its letters, turned by their place, are multiplied. A
text is the bundle (sum) of its trigrams and a language the bundle of its training texts, each of equal weight. A text
has the language whose prototype has the largest cosine with it. All sums are of whole numbers, so neither the
order of rows nor their partitions change them.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import id_remainder, map_batches, slices

DIMENSIONS = 1024
#: Letters share 63 vectors by code point; everything else is a gap, whose vector is the first.
SLOTS = 64
SEED = 20_240_607
UNKNOWN = "und"
BLOCK_TEXTS = 64
BLOCK_CHARS = 1_000_000
#: A training text adds its trigram shares in units of 2^-20.
SHARE = 1 << 20
#: Languages a task sums at once before it hands its sums on.
OPEN_LANGUAGES = 32
#: Fixed by the contract: rows with this remainder by 4 are held out.
FOLDS, HELD_OUT = 4, 2
#: Short clean texts are little like any language, so by default only ``und`` is rejected.
LEAST_SCORE = 0.0


@cache
def slots() -> np.ndarray:
    """Slot of every code point: letters and the marks on them from 1, the rest 0."""
    kinds = (unicodedata.category(chr(c))[0] for c in range(0x110000))
    return np.fromiter((1 + c * 37 % (SLOTS - 1) if k in "LM" else 0 for c, k in enumerate(kinds)), np.uint8, 0x110000)


@cache
def letter_vectors() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors of the first, second and third letter of a trigram: the same ones, turned by two, one and no places."""
    own = np.random.default_rng(SEED).integers(0, 2, (SLOTS, DIMENSIONS), np.int8) * 2 - 1
    return np.roll(own, 2, axis=1), np.roll(own, 1, axis=1), own


def trigrams(text: str) -> np.ndarray:
    """Codes of the trigrams of the lower-cased text, gaps taken as one and added at both ends; none without a letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    found = np.zeros(len(points) + 2, np.uint8)
    found[1:-1] = slots()[points]
    if not any(map(str.isalpha, text)):
        return np.empty(0, np.int64)
    found = found[np.append(True, (found[1:] != 0) | (found[:-1] != 0))].astype(np.int64)
    return (found[:-2] * SLOTS + found[1:-1]) * SLOTS + found[2:]


def trigram_vectors(codes: np.ndarray) -> np.ndarray:
    first, second, third = letter_vectors()
    bound = first[codes // (SLOTS * SLOTS)]
    bound *= second[codes // SLOTS % SLOTS]
    bound *= third[codes % SLOTS]
    return bound


def bundle(texts: list[np.ndarray]) -> np.ndarray:
    """Sum of the trigram vectors of each text. Whole numbers below 2^24, so float32 holds them exactly."""
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    pairs, counts = np.unique(owner << 18 | np.concatenate(texts), return_counts=True)
    codes, place = np.unique(pairs & ((1 << 18) - 1), return_inverse=True)
    sums = np.zeros((len(texts), DIMENSIONS), np.float32)
    for start in range(0, len(codes), 8192):
        inside = (place >= start) & (place < start + 8192)
        dense = np.zeros((len(texts), min(8192, len(codes) - start)), np.float32)
        dense[pairs[inside] >> 18, place[inside] - start] = counts[inside]
        sums += dense @ trigram_vectors(codes[start : start + 8192]).astype(np.float32)
    return sums


def blocks(texts: list[str | None]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Texts as trigram codes, in blocks of bounded size, with the index of the first."""
    block, start, size = [], 0, 0
    for n, text in enumerate(texts):
        if block and (len(block) == BLOCK_TEXTS or size + len(text or "") > BLOCK_CHARS):
            yield start, block
            block, start, size = [], n, 0
        block.append(trigrams(text or ""))
        size += len(text or "")
    if block:
        yield start, block


class Prototypes:
    """Unit vectors of the languages, in alphabetical order."""

    def __init__(self, names: list[str], sums: np.ndarray):
        self.names = names
        self.units = sums / np.linalg.norm(sums, axis=1, keepdims=True) if names else sums

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and cosine (negative ones as 0) of each text; ties go to the first language."""
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        for start, block in blocks(texts):
            if not self.names:
                continue
            sums = bundle(block).astype(np.float64)
            length = np.linalg.norm(sums, axis=1)
            cosines = np.round(sums @ self.units.T / np.where(length == 0, 1, length)[:, None], 9)
            best = cosines.argmax(axis=1)
            for n, codes in enumerate(block):
                if len(codes):
                    names[start + n] = self.names[best[n]]
                    scores[start + n] = min(1.0, max(0.0, float(cosines[n, best[n]])))
        return names, scores


def learn(docs: DataFrame, text: str = "text", language: str = "lang") -> Prototypes:
    """Prototypes of the languages of all given rows with a text and a language.

    Each task sums its rows and hands on one vector a language; Spark adds them. The driver gets one row a language.
    """
    rows = docs.where(F.col(language).isNotNull() & F.col(text).isNotNull())
    rows = rows.select(F.col(language).cast("string").alias("name"), F.col(text).cast("string").alias("body"))

    def handed_on(open_: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for name, shares in open_.items():
            codes = np.flatnonzero(shares)
            total = np.zeros(DIMENSIONS, np.int64)
            for start in range(0, len(codes), 4096):
                part = codes[start : start + 4096]
                total += shares[part] @ trigram_vectors(part).astype(np.int64)
            place = pa.array(np.arange(DIMENSIONS, dtype=np.int32))
            yield pa.record_batch([pa.array([name] * DIMENSIONS), place, pa.array(total)], ["name", "place", "value"])

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, body in zip(batch.column(0), batch.column(1), strict=True):
                codes = np.sort(trigrams(body.as_py()).astype(np.int32))
                if not len(codes):
                    continue
                name = name.as_py()
                if name not in open_ and len(open_) == OPEN_LANGUAGES:
                    yield from handed_on(open_)
                    open_.clear()
                shares = open_.setdefault(name, np.zeros(SLOTS**3, np.int64))
                first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
                counts = np.diff(np.append(first, len(codes)))
                shares[codes[first]] += counts * SHARE // len(codes)
        yield from handed_on(open_)

    sums = map_batches(rows, of_batches, "name string, place int, value bigint")
    sums = sums.groupBy("name", "place").agg(F.sum(F.col("value").cast("decimal(38,0)")).cast("double").alias("value"))
    found = sums.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("parts"))
    vectors = sorted((r.name, [p.value for p in r.parts]) for r in found.collect())
    return Prototypes([n for n, _ in vectors], np.array([v for _, v in vectors], np.float64).reshape(-1, DIMENSIONS))


def training_rows(key: str) -> Column:
    return id_remainder(key, FOLDS) != HELD_OUT


def _broadcast(docs: DataFrame, model: Prototypes) -> Broadcast:
    return docs.sparkSession.sparkContext.broadcast(model)


def predict_languages(docs: DataFrame, model: Prototypes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``lang_pred`` and ``score`` (cosine, 0 to 1), one row per document.

    NULL texts and texts without a letter are ``und`` with score 0, and so is every text if nothing was learned. Only the text is
    looked at, all of it. Repeated rows each come back; no rows give none; other columns are not read.
    """
    shared = _broadcast(docs, model)
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").cast("string").alias("body"))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            names, scores = shared.value.predict(batch.column(1).to_pylist())
            yield pa.record_batch([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["id", "n", "s"])

    kind = rows.schema["id"].dataType.simpleString()
    found = map_batches(rows, of_batches, f"id {kind}, n string, s double")
    return found.select(F.col("id").alias(key), F.col("n").alias("lang_pred"), F.col("s").alias("score"))


def keep_identified(docs: DataFrame, model: Prototypes, text: str = "text", least_score: float = LEAST_SCORE) -> DataFrame:
    """Rows whose text has a language (is not ``und``) with the given cosine at least, all columns as they were.

    If nothing was learned, the rows whose text has a letter. With the default bound that is also what stays otherwise.
    """
    shared = _broadcast(docs, model)
    column = docs.columns.index(text)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(column).to_pylist()
            if not shared.value.names:
                yield batch.filter(pa.array([any(map(str.isalpha, t or "")) for t in texts], pa.bool_()))
                continue
            names, scores = shared.value.predict(texts)
            keep = [n != UNKNOWN and s >= least_score for n, s in zip(names, scores, strict=True)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return map_batches(docs, of_batches, docs.schema)
