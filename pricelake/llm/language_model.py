"""Token log-probabilities from a log-bilinear model trained with noise-contrastive estimation.

The model's units are the commonest words, the end of a text, and classes of all other words by their last two bytes. The vector of the
next unit is predicted as the sum of the vectors of the units before it, each scaled by the weights of its distance; its inner product with each
unit's own vector, plus the unit's bias, scores the unit. Training tells each unit from units drawn from their frequencies
(noise), which needs no sum over all units. Scoring normalises: one matrix product for a batch of places gives the scores of all units. A
word of a class has the class's probability times its smoothed share of the class's tokens, so the probabilities of
all words, and of one unknown word in each class, add up to one.

Every training text takes part. Tasks train from the same start on their own rows; the average of what they reach, by tokens, is the start of the next
round. Spark counts the words, adds up the parameters and joins the counts of rare words.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelake.llm.common import id_remainder, map_batches, stage, words
from pricelake.session import discard

#: Fixed by the contract: rows with this remainder by 5 are held out.
FOLDS, HELD_OUT = 5, 1
#: Units of the model: words of their own, the end, and classes of the others.
WORD_UNITS, CLASSES = 127, 128
UNITS = WORD_UNITS + 1 + CLASSES
END = WORD_UNITS
DIMENSIONS, CONTEXT = 24, 6
NOISE, BATCH, ROUNDS, RATE = 24, 2048, 2, 0.15
#: Places scored at a time.
SCORED = 512
#: The commonest words are known to every task; the counts of the others are joined.
COMMON_WORDS = 1 << 18
#: Distinct words a counting task holds before it hands its counts on.
OPEN_WORDS = 400_000
SEED = 11
#: Parameters are added up in units of 2^-24, as whole numbers, so their order does not matter.
SCALE = 1 << 24


def training_rows(key: str) -> Column:
    return id_remainder(key, FOLDS) != HELD_OUT


# Counts.


def count_words(texts: DataFrame) -> DataFrame:
    """``word`` (bytes) and ``times`` over all rows of one text column. Tasks count first, Spark adds."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: Counter = Counter()

        def handed_on():
            return pa.record_batch([pa.array(list(open_), pa.binary()), pa.array(list(open_.values()), pa.int64())], ["word", "times"])

        for batch in batches:
            for text in batch.column(0):
                open_.update(words(text.as_py() or ""))
                if len(open_) > OPEN_WORDS:
                    yield handed_on()
                    open_.clear()
        yield handed_on()

    return map_batches(texts, of_batches, "word binary, times bigint").groupBy("word").agg(F.sum("times").alias("times"))


def ending(word: bytes) -> bytes:
    return word[-2:]


@dataclass
class Vocabulary:
    """What every task has to know of the counts: of bounded size whatever the corpus."""

    tokens: int
    distinct: int
    #: Times of the commonest words, and of the end, which stands as the empty word.
    common: dict[bytes, int]
    #: Words with a unit of their own.
    words: list[bytes]
    classes: dict[bytes, int]
    #: Tokens and distinct words of each class.
    class_tokens: np.ndarray
    class_distinct: np.ndarray
    unit_counts: np.ndarray

    def __post_init__(self):
        own = {word: n for n, word in enumerate(self.words)} | {b"": END}
        self.place = {word: n for n, word in enumerate(self.common)}
        self.times = np.fromiter(self.common.values(), np.float64, len(self.common))
        self.unit = np.fromiter((own[w] if w in own else self.class_of(w) for w in self.common), np.int16, len(self.common))
        self.base = self.base_of(self.times)
        self.share = np.where(self.unit > END, self.share_of(np.maximum(self.unit, END + 1), self.times), 0.0)

    def class_of(self, word: bytes) -> int:
        return self.classes.get(ending(word), UNITS - 1)

    def classes_of(self, words_: list[bytes]) -> list[int]:
        return list(map(self.classes.get, [word[-2:] for word in words_], repeat(UNITS - 1)))

    def base_of(self, times: np.ndarray) -> np.ndarray:
        """log10 of the smoothed share of tokens among all tokens."""
        return np.log10((times + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))

    def share_of(self, unit: np.ndarray, times: np.ndarray) -> np.ndarray:
        """log10 of the smoothed share of words in their classes."""
        n = unit - END - 1
        return np.log10((times + 0.5) / (self.class_tokens[n] + 0.5 * (self.class_distinct[n] + 1)))


def common_words(counts: DataFrame, most: int) -> DataFrame:
    """The commonest words, at most so many: those met more often than the words that would go beyond the bound.

    The least number of times is found from how many words there are of each; a limit would have every task send that many rows.
    """
    words_of = counts.groupBy("times").agg(F.count("*").alias("n"))
    above = words_of.select("times", F.sum("n").over(Window.orderBy(F.desc("times"))).alias("so_far"))
    least = above.where(F.col("so_far") <= most).agg(F.min("times")).first()[0]
    return counts.where(F.col("times") >= least) if least is not None else counts.limit(0)


def vocabulary(counts: DataFrame, texts: int) -> Vocabulary:
    """``counts`` without the ends, of which each of the training texts has one."""
    total = counts.agg(F.sum("times"), F.count("*")).first()
    common = {bytes(r.word): r.times for r in common_words(counts, COMMON_WORDS).orderBy(F.desc("times"), "word").collect()}
    own = list(common)[:WORD_UNITS]
    common[b""] = texts
    rest = counts.where(~F.col("word").isin([bytearray(w) for w in own])) if own else counts
    by_ending = rest.groupBy(F.expr("substring(word, -2, 2)").alias("ending")).agg(
        F.sum("times").alias("tokens"), F.count("*").alias("distinct")
    )
    largest = by_ending.orderBy(F.desc("tokens"), "ending").limit(CLASSES - 1).collect()
    rest_total = rest.agg(F.sum("times"), F.count("*")).first()
    tokens, distinct = np.zeros(CLASSES), np.zeros(CLASSES)
    for n, row in enumerate(largest):
        tokens[n], distinct[n] = row.tokens, row.distinct
    tokens[-1], distinct[-1] = (rest_total[0] or 0) - tokens.sum(), rest_total[1] - distinct.sum()
    units = np.zeros(UNITS)
    units[: len(own)] = [common[w] for w in own]
    units[END], units[END + 1 :] = texts, tokens
    ends = 1 if texts else 0
    return Vocabulary(
        (total[0] or 0) + texts,
        total[1] + ends,
        common,
        own,
        {bytes(r.ending): END + 1 + n for n, r in enumerate(largest)},
        tokens,
        distinct,
        units,
    )


# The model.


@dataclass
class Model:
    """Vectors of units as context and as prediction, weights of distances, biases."""

    context: np.ndarray
    target: np.ndarray
    distance: np.ndarray
    bias: np.ndarray

    @staticmethod
    def start(unit_counts: np.ndarray) -> Model:
        """Small random vectors; the biases are the log frequencies, which alone give the frequencies back."""
        draw = np.random.default_rng(SEED)
        frequencies = (unit_counts + 0.5) / (unit_counts + 0.5).sum()
        return Model(
            draw.normal(0, 0.1, (UNITS + 1, DIMENSIONS)).astype(np.float32),
            draw.normal(0, 0.1, (UNITS, DIMENSIONS)).astype(np.float32),
            np.ones((CONTEXT, DIMENSIONS), np.float32) / np.arange(1, CONTEXT + 1, dtype=np.float32)[:, None] ** 0.5,
            np.log(frequencies).astype(np.float32),
        )

    def parts(self) -> list[np.ndarray]:
        return [self.context, self.target, self.distance, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def moved_to(self, flat: np.ndarray) -> Model:
        out, at = [], 0
        for part in self.parts():
            out.append(flat[at : at + part.size].reshape(part.shape).astype(np.float32))
            at += part.size
        return Model(*out)


def contexts(units: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Units before each place, nearest first; the extra unit where the text has none."""
    places = np.arange(len(units))
    out = np.empty((CONTEXT, len(units)), np.int16)
    for n in range(CONTEXT):
        at = places - n - 1
        out[n] = np.where(at >= first, units[np.maximum(at, 0)], UNITS)
    return out


def row_sums(groups: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sum of ``values[n % len(values)]`` over the places n of each group. Two-byte groups are sorted by radix."""
    order = np.argsort(groups, kind="stable")
    sorted_ = groups[order]
    first = np.flatnonzero(sorted_[1:] != sorted_[:-1]) + 1
    first = np.append(0, first)
    out = np.zeros((size, values.shape[1]), np.float32)
    out[sorted_[first]] = np.add.reduceat(values.take(order % len(values), axis=0), first, axis=0)
    return out


def predicted(tables: list[np.ndarray], before: np.ndarray) -> np.ndarray:
    """Predicted vectors: with one table of context vectors for each distance, a lookup and a sum."""
    total = tables[0].take(before[0], axis=0)
    for table, units in zip(tables[1:], before[1:], strict=True):
        total += table.take(units, axis=0)
    return total


class Trainer:
    """AdaGrad on the noise-contrastive loss of batches of places."""

    def __init__(self, model: Model, unit_counts: np.ndarray, seed: int):
        self.model = model.moved_to(model.flat())
        self.seen = [np.full(p.shape, 1e-3, np.float32) for p in self.model.parts()]
        self.noise = (unit_counts + 0.5) / (unit_counts + 0.5).sum()
        self.log_noise = np.log(self.noise * NOISE).astype(np.float32)
        self.draw = np.random.default_rng(seed)

    def learn(self, units: np.ndarray, before: np.ndarray) -> None:
        """One step. The noise units are shared by the places of the batch."""
        m, n = self.model, len(units)
        noise = self.draw.choice(UNITS, NOISE, p=self.noise)
        guess = predicted([m.context * d for d in m.distance], before)
        mine = m.target.take(units, axis=0)
        own = (guess * mine).sum(axis=1) + (m.bias - self.log_noise)[units]
        others = guess @ m.target[noise].T
        others += m.bias[noise] - self.log_noise[noise]
        # Slopes of the loss by the scores: of the unit that came, and of the noise.
        slope_own = -1 / (1 + np.exp(np.clip(own, -30, 30)))
        np.clip(others, -30, 30, out=others)
        np.negative(others, out=others)
        np.exp(others, out=others)
        others += 1
        slope_others = np.reciprocal(others, out=others)
        slope_guess = slope_others @ m.target[noise]
        slope_guess += slope_own[:, None] * mine
        target = row_sums(units, slope_own[:, None] * guess, UNITS)
        np.add.at(target, noise, slope_others.T @ guess)
        bias = np.bincount(units, slope_own, UNITS).astype(np.float32)
        np.add.at(bias, noise, slope_others.sum(axis=0))
        by_distance = before + (np.arange(CONTEXT, dtype=np.int16) * (UNITS + 1))[:, None]
        sums = row_sums(by_distance.ravel(), slope_guess, CONTEXT * (UNITS + 1)).reshape(CONTEXT, UNITS + 1, DIMENSIONS)
        context, distance = (sums * m.distance[:, None]).sum(axis=0), (sums * m.context).sum(axis=1)
        for part, seen, slope in zip(m.parts(), self.seen, (context, target, distance, bias), strict=True):
            slope = slope / n
            seen += slope**2
            part -= RATE * slope / np.sqrt(seen)


def log_probabilities(model: Model, units: np.ndarray, before: np.ndarray) -> np.ndarray:
    """log10 probability of each place's unit, normalised over all units by a matrix product for each batch.

    The bias is one more dimension of the product. A batch of scores is small enough for the processor's cache.
    """
    out = np.empty(len(units))
    scores = np.empty((SCORED, UNITS), np.float32)
    ones = np.ones(UNITS, np.float32)
    target = np.ascontiguousarray(np.vstack([model.target.T, model.bias]))
    tables = [np.pad(model.context * d, ((0, 0), (0, 1))) for d in model.distance]
    tables[0][:, -1] = 1
    # No score is above this; float32 overflows at 88.
    longest = sum(float(np.linalg.norm(t, axis=1).max()) for t in tables)
    bounded = longest * float(np.linalg.norm(target, axis=0).max()) < 80
    for start in range(0, len(units), SCORED):
        chosen = units[start : start + SCORED]
        guess = predicted(tables, before[:, start : start + SCORED])
        block = scores[: len(chosen)]
        np.matmul(guess, target, out=block)
        own = block[np.arange(len(chosen)), chosen].astype(np.float64)
        if not bounded:
            np.minimum(block, 80, out=block)
        np.exp(block, out=block)
        out[start : start + SCORED] = own - np.log(block @ ones)
    return out / math.log(10)


# Texts as units.


def blocks(texts: list[str | None]) -> Iterator[tuple[int, list[int], list[bytes]]]:
    """Words and ends of texts in blocks of about 100,000, with the index of the first text and the length of each."""
    block, lengths, start = [], [], 0
    for n, text in enumerate(texts):
        parts = words(text or "")
        block += parts
        block.append(b"")
        lengths.append(len(parts) + 1)
        if len(block) > 100_000:
            yield start, lengths, block
            block, lengths, start = [], [], n + 1
    if block:
        yield start, lengths, block


def places(vocabulary_: Vocabulary, block: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
    """Place of each word among the common ones (-1: not there), its unit, and the words that are not there with their positions."""
    found = np.fromiter(map(vocabulary_.place.get, block, repeat(-1)), np.int32, len(block))
    missing = np.flatnonzero(found < 0)
    rare = list(map(block.__getitem__, missing.tolist()))
    units = vocabulary_.unit[found]
    units[missing] = vocabulary_.classes_of(rare)
    return found, units, rare, missing


def firsts(lengths: list[int]) -> np.ndarray:
    return np.cumsum(lengths) - lengths


def units_of(texts: DataFrame, found: Vocabulary) -> DataFrame:
    """``units`` (two-byte numbers, the end included) of every row of one text column."""
    shared = texts.sparkSession.sparkContext.broadcast(found)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, lengths, block in blocks(batch.column(0).to_pylist()):
                content = places(shared.value, block)[1].tobytes()
                ends = np.cumsum(lengths).tolist()
                parts = [content[2 * (end - n) : 2 * end] for end, n in zip(ends, lengths, strict=True)]
                yield pa.record_batch([pa.array(parts, pa.binary())], ["units"])

    return map_batches(texts, of_batches, "units binary")


def unit_blocks(rows: pa.Array) -> Iterator[tuple[np.ndarray, list[int]]]:
    """Units of rows one after the other, in blocks of about 100,000, with the length of each row."""
    block, size = [], 0
    for n, row in enumerate(rows):
        block.append(row.as_py())
        size += len(block[-1]) // 2
        if size > 100_000 or n + 1 == len(rows):
            yield np.frombuffer(b"".join(block), np.int16), [len(r) // 2 for r in block]
            block, size = [], 0


def train(units: DataFrame, found: Vocabulary, rounds: int = ROUNDS) -> Model:
    """A model from all rows of ``units``, which are read once a round."""
    context = units.sparkSession.sparkContext
    counts = found.unit_counts
    model = Model.start(found.unit_counts)
    for turn in range(rounds):
        start = context.broadcast(model)

        def of_batches(batches: Iterator[pa.RecordBatch], start=start, turn=turn) -> Iterator[pa.RecordBatch]:
            trainer = Trainer(start.value, counts, SEED + turn * 1_000_003 + TaskContext.get().partitionId())
            tokens = 0
            for batch in batches:
                for found_units, lengths in unit_blocks(batch.column(0)):
                    before = contexts(found_units, np.repeat(firsts(lengths), lengths))
                    tokens += len(found_units)
                    # Places of many texts share a step: every batch is spread over the block.
                    steps = max(1, round(len(found_units) / BATCH))
                    for k in range(steps):
                        trainer.learn(found_units[k::steps], before[:, k::steps])
            if tokens:
                values = np.round(trainer.model.flat().astype(np.float64) * SCALE).astype(np.int64)
                place = pa.array(np.arange(len(values), dtype=np.int32))
                yield pa.record_batch([place, pa.array(values), pa.array(np.full(len(values), tokens))], ["place", "value", "tokens"])

        reached = map_batches(units, of_batches, "place int, value bigint, tokens bigint")
        weighted = F.sum(F.col("value").cast("decimal(20,0)") * F.col("tokens").cast("decimal(18,0)"))
        mean = reached.groupBy("place").agg((weighted / F.sum("tokens")).cast("double").alias("value"))
        values = mean.toPandas().sort_values("place")["value"].to_numpy()
        if len(values):
            model = model.moved_to(values / SCALE)
        start.unpersist()
    return model


def score(docs: DataFrame, model: Model, found: Vocabulary, counts: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_tokens``, ``n_known``, ``base_score`` and ``score``, one row per document."""
    spark = docs.sparkSession
    shared, trained = spark.sparkContext.broadcast(found), spark.sparkContext.broadcast(model)
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").cast("string").alias("body"))
    names = ["row", "id", "n_tokens", "n_known", "base", "score", "rare"]

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary_, model_ = shared.value, trained.value
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for start, lengths, block in blocks(batch.column(1).to_pylist()):
                found, units, rare, missing = places(vocabulary_, block)
                first = firsts(lengths)
                logs = log_probabilities(model_, units, contexts(units, np.repeat(first, lengths)))
                known = found >= 0
                parts = (
                    known & (vocabulary_.times[found] > 0),
                    np.where(known, vocabulary_.base[found], 0.0),
                    logs + np.where(known, vocabulary_.share[found], 0.0),
                )
                n_known, base, total = (np.add.reduceat(p, first, dtype=np.float64) for p in parts)
                # Rare words of each text, each once with its times.
                owners = np.searchsorted(first, missing, side="right") - 1
                times = Counter(zip(owners.tolist(), rare, strict=True))
                keys = list(times)
                rare_words = [w for _, w in keys]
                offsets = np.searchsorted([n for n, _ in keys], np.arange(len(lengths) + 1)).astype(np.int32)
                rares = pa.StructArray.from_arrays(
                    [
                        pa.array(rare_words, pa.binary()),
                        pa.array(vocabulary_.classes_of(rare_words), pa.int32()),
                        pa.array(times.values(), pa.int32()),
                    ],
                    ["word", "unit", "times"],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row + np.arange(len(lengths)), pa.int64()),
                        batch.column(0).slice(start, len(lengths)),
                        pa.array(lengths, pa.int64()),
                        pa.array(n_known.astype(np.int64)),
                        pa.array(base),
                        pa.array(total),
                        pa.ListArray.from_arrays(pa.array(offsets), rares),
                    ],
                    names,
                )
                row += len(lengths)

    kind = rows.schema["id"].dataType.simpleString()
    schema = (
        f"row bigint, id {kind}, n_tokens bigint, n_known bigint, base double, score double, "
        "rare array<struct<word: binary, unit: int, times: int>>"
    )
    # Written out once: the row numbers must not change between the two reads.
    scored, _ = stage(map_batches(rows, of_batches, schema), "scored")

    tokens_of, distinct_of = (
        F.element_at(F.lit(v.tolist()), F.col("unit") - END) for v in (found.class_tokens, found.class_distinct)
    )
    rare = scored.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.unit", F.col("r.times").alias("n"))
    joined = rare.join(counts, "word", "left").withColumn("c", F.coalesce("times", F.lit(0)))
    seen = F.log10((F.col("c") + 0.5) / F.lit(found.tokens + 0.5 * (found.distinct + 1)))
    share = F.log10((F.col("c") + 0.5) / (tokens_of + 0.5 * (distinct_of + 1)))
    added = joined.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more_known"),
        F.sum(seen * F.col("n")).alias("more_base"),
        F.sum(share * F.col("n")).alias("more_share"),
    )
    zero = F.lit(0)
    return scored.drop("rare").join(added, "row", "left").select(
        F.col("id").alias(key),
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", zero)).alias("n_known"),
        (F.col("base") + F.coalesce("more_base", zero)).alias("base_score"),
        (F.col("score") + F.coalesce("more_share", zero)).alias("score"),
    )


def train_and_score(docs: DataFrame, learns: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of every document.

    Rows for which ``learns`` holds are the training texts. NULL and empty texts are one end. Without training texts every token is unknown and the
    model is the even one over its start. Repeated rows each count and each come back. Other columns are not read.
    """
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").cast("string").alias("body"), learns.alias("learns"))
    texts = rows.where("learns").select("body")
    counts, _ = stage(count_words(texts), "word-counts")
    found = vocabulary(counts, texts.count())
    units, units_path = stage(units_of(texts, found), "units")
    model = train(units, found)
    discard(docs.sparkSession, units_path)
    scored = score(rows, model, found, counts, "id", "body")
    return scored.select(
        F.col("id").alias(key), "n_tokens", "n_known", F.lit(found.tokens).cast("bigint").alias("train_tokens"), "base_score", "score"
    )
