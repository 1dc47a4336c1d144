"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic texts are labelled examples; all other training texts are unlabelled, whatever they hold. With the share of toxic texts (the class
prior) known, the risk on the texts that are not toxic is what the unlabelled ones cost less what the toxic ones among them
cost. On a flexible model that difference falls below zero, which is overfitting; where it does, the step goes the other way. The classifier is
linear in the words and the short runs of letters a text has, fitted in numpy on a sample of bounded size; every text is scored. Only
features that toxic examples have clearly more often than unlabelled ones take part, by the likelihood-ratio statistic.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import id_remainder, map_batches, stage
from pricelake.session import discard

#: Words are hashed to this many features, and runs of letters to as many more.
FEATURE_BITS = 18
FEATURES = 1 << FEATURE_BITS
#: The most examples the fit takes of each kind, those with the smallest hash of their key.
MOST_POSITIVE, MOST_UNLABELLED = 10_000, 20_000
#: Bytes of a run of letters, the space before or after a word included.
RUN = 5
#: Least likelihood-ratio statistic of a feature. By chance one feature in ten thousand gets there.
LEAST_STATISTIC = 15.0
STEPS, RATE, DECAY = 300, 0.1, 5e-4
#: Fixed by the contract: rows with this remainder by 5 are held out.
FOLDS, HELD_OUT = 5, 0
WORD = re.compile(rb"[a-z0-9\x80-\xff]+")


def features(text: str | None) -> np.ndarray:
    """Features of the distinct words of the whole text and of its runs of letters, A-Z in lower case, marks around words left out."""
    found = WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())
    if not found:
        return np.empty(0, np.int32)
    distinct = set(found)
    content = np.frombuffer(b" " + b" ".join(found) + b" ", np.uint8).astype(np.uint64)
    runs = np.zeros(max(0, len(content) - RUN + 1), np.uint64)
    for n in range(RUN):
        runs = (runs << np.uint64(8)) | content[n : n + len(runs)]
    # Multiplicative hashing by the golden ratio, the upper bits.
    runs = (runs * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - FEATURE_BITS)
    hashed = np.fromiter((zlib.crc32(w) & (FEATURES - 1) for w in distinct), np.int32, len(distinct))
    return np.unique(np.concatenate((hashed, runs.astype(np.int32) + FEATURES)))


def statistic(with_p: np.ndarray, p: int, with_u: np.ndarray, u: int) -> np.ndarray:
    """Likelihood-ratio statistic of each feature between the two kinds of examples; 0 where toxic ones do not have it more often."""

    def term(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return seen * np.log(np.where(seen > 0, seen, 1) / np.where(seen > 0, expected, 1))

    share = (with_p + with_u) / (p + u)
    g = 2 * (term(with_p, p * share) + term(with_u, u * share) + term(p - with_p, p * (1 - share)) + term(u - with_u, u * (1 - share)))
    return np.where(with_p * u > with_u * p, g, 0.0)


class Sparse:
    """Examples as one row of features each."""

    def __init__(self, rows: list[np.ndarray]):
        self.sizes = np.array([len(r) for r in rows], np.int64)
        self.owner = np.repeat(np.arange(len(rows)), self.sizes)
        self.features = np.concatenate(rows) if rows else np.empty(0, np.int32)
        self.rows = len(rows)

    def sums(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, weights[self.features], self.rows)

    def slopes(self, outer: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.features, outer[self.owner], size)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


@dataclass
class Classifier:
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Between 0 and 1; the bias alone for a text without a word."""
        return sigmoid(Sparse([features(t) for t in texts]).sums(self.weights) + self.bias)


def chosen_features(seen: np.ndarray, with_p: np.ndarray, with_u: np.ndarray, p: int, u: int) -> np.ndarray:
    """Those of the features ``seen`` that tell toxic examples from unlabelled ones, in order."""
    if not p or not u:
        return seen[:0]
    return np.sort(seen[statistic(with_p, p, with_u, u) >= LEAST_STATISTIC])


def places(row: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Places of a row's features among the chosen ones."""
    return np.flatnonzero(np.isin(chosen, row, assume_unique=True))


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, chosen: np.ndarray) -> Classifier:
    """Adam on the non-negative risk with logistic loss, from the places of each example's features among the chosen ones.

    Without an example of either kind every score is 0.
    """
    if not positive or not unlabelled:
        return Classifier(np.zeros(2 * FEATURES), -60.0)
    p, u, size = Sparse(positive), Sparse(unlabelled), len(chosen)
    theta, mean, square = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    theta[-1] = np.log(prior / (1 - prior)) if 0 < prior < 1 else 0.0
    for step in range(1, STEPS + 1):
        gp, gu = p.sums(theta) + theta[-1], u.sums(theta) + theta[-1]
        # Logistic loss l(z) = log(1 + exp(-z)); of a text taken as not toxic it is l(-g), with slope sigmoid(g).
        unlabelled_risk = np.logaddexp(0, gu).mean()
        negative_risk = unlabelled_risk - prior * np.logaddexp(0, gp).mean()
        as_negative = np.concatenate([-prior * sigmoid(gp) / p.rows, sigmoid(gu) / u.rows])
        if negative_risk >= 0:
            outer = as_negative
            outer[: p.rows] -= prior * sigmoid(-gp) / p.rows
        else:
            outer = -as_negative
        slope = np.empty(size + 1)
        slope[:-1] = p.slopes(outer[: p.rows], size) + u.slopes(outer[p.rows :], size) + DECAY * theta[:-1]
        slope[-1] = outer.sum()
        mean = 0.9 * mean + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        theta = theta - RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(2 * FEATURES)
    weights[chosen] = theta[:-1]
    return Classifier(weights, float(theta[-1]))


def training_rows(key: str) -> Column:
    return id_remainder(key, FOLDS) != HELD_OUT


def learn(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    most_positive: int = MOST_POSITIVE,
    most_unlabelled: int = MOST_UNLABELLED,
) -> Classifier:
    """Classifier from the given documents and labels. The prior is the share of toxic rows among all given labels that are not NULL.

    Of more examples than the bounds allow, those whose keys have the smallest hashes are taken: keys are counted once, however many
    rows they have, and of the rows of a key the one with the least digest is the example. So the bounds hold for rows. NULL keys are no examples.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("id"), F.col(label).alias("toxic"))
    share = known.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0]

    def chosen(ids: DataFrame, most: int, positive: bool) -> DataFrame:
        # A cut by hash first: the limit alone would have every task send that many rows. It lets through the wanted number and six
        # standard deviations more, so the smallest hashes are always among them.
        share = (most + 6 * most**0.5 + 36) / max(1, ids.count())
        hashed = F.xxhash64("id")
        if share < 1:
            ids = ids.where(hashed < int(share * 2**64) - 2**63)
        return ids.orderBy(hashed, "id").limit(most).select("id", F.lit(positive).alias("positive"))

    rows = docs.where(F.col(key).isNotNull()).select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").cast("string").alias("body"))
    examples = chosen(known.where("toxic = 1").select("id").distinct(), most_positive, True).unionAll(
        chosen(rows.select("id").distinct(), most_unlabelled, False)
    )
    # Bounded by the two limits, so it may be broadcast.
    every = rows.join(F.broadcast(examples.distinct()), "id").select("id", "positive", "body")
    least = F.struct(F.xxhash64("body").alias("digest"), "body")
    texts = every.groupBy("id", "positive").agg(F.min(least).alias("least")).select("id", "positive", F.col("least.body").alias("body"))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t.as_py()).tobytes() for t in batch.column(2)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(found, pa.binary())], ["id", "positive", "features"])

    kind = rows.schema["id"].dataType.simpleString()
    found, found_path = stage(map_batches(texts, of_batches, f"id {kind}, positive boolean, features binary"), "examples")
    sizes = {r.positive: r["count"] for r in found.groupBy("positive").count().collect()}

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with_p, with_u = np.zeros(2 * FEATURES, np.int64), np.zeros(2 * FEATURES, np.int64)
        for batch in batches:
            for positive, row in zip(batch.column(0), batch.column(1), strict=True):
                (with_p if positive.as_py() else with_u)[np.frombuffer(row.as_buffer(), np.int32)] += 1
        seen = np.flatnonzero(with_p + with_u)
        yield pa.record_batch([pa.array(seen), pa.array(with_p[seen]), pa.array(with_u[seen])], ["feature", "with_p", "with_u"])

    counts = map_batches(found.select("positive", "features"), counted, "feature bigint, with_p bigint, with_u bigint")
    counts = counts.groupBy("feature").agg(F.sum("with_p").alias("with_p"), F.sum("with_u").alias("with_u"))
    # Features that no toxic example has are never chosen. There are no more rows than features.
    counts = counts.where("with_p > 0").toPandas()
    counts = [counts[c].to_numpy(np.int64) for c in ("feature", "with_p", "with_u")]
    chosen = chosen_features(*counts, sizes.get(True, 0), sizes.get(False, 0))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [places(np.frombuffer(r.as_buffer(), np.int32), chosen).astype(np.int32).tobytes() for r in batch.column(2)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(rows, pa.binary())], ["id", "positive", "places"])

    # The driver gets a few bytes of each of a bounded number of examples.
    examples = map_batches(found, placed, f"id {kind}, positive boolean, places binary")
    sides: dict[bool, list[np.ndarray]] = {True: [], False: []}
    for row in sorted(examples.collect(), key=lambda r: (r.id, r.positive, bytes(r.places))):
        sides[row.positive].append(np.frombuffer(row.places, np.int32))
    discard(docs.sparkSession, found_path)
    return fit(sides[True], sides[False], share or 0.0, chosen)


def score(docs: DataFrame, model: Classifier, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``score`` (0 to 1) and ``predicted`` (1 from a score of 0.5 on), one row per document.

    NULL counts as empty; a text without a word has the score of the bias. Only the text is looked at, all of it. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").cast("string").alias("body"))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found = pa.array(shared.value.scores(part.column(1).to_pylist()), pa.float64())
                yield pa.record_batch([part.column(0), found], ["id", "score"])

    kind = rows.schema["id"].dataType.simpleString()
    found = map_batches(rows, of_batches, f"id {kind}, score double")
    return found.select(F.col("id").alias(key), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
