"""Documents that hold benchmark items, by an inverted index of the items and block-max WAND.

Words count without the punctuation at their edges. A document holds an item if it has the wanted share of the shingles of its question and of its
answer, or of the item as a whole, or if the item stands there letter for letter, whatever is glued to its ends.

The items are indexed under BM25 and every document is a query against them. The weight a word has in an item is divided by the
least score of a document that holds the item, so one threshold, 1, serves for all. With k of a text's shingles missing, and one there, at most k of its
words are missing: each word before the shingle that is there begins a missing one, each word behind it ends one. The heaviest k
are taken off; of an item that stands there letter for letter, the first and last word. So the search loses no document that the check accepts.

Items stand in blocks, and for each word a block has the largest weight in it. A block whose largest weights do not add up to the threshold
is skipped; in the others cursors move to the next item that can reach it. What is found is checked.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import map_batches, stage, words

SHINGLE_WORDS = 5
LEAST_OVERLAP = 0.8
BLOCK_ITEMS = 2
#: Items are indexed in parts of this many bytes of text; each part is one pass over the documents.
PART_BYTES = 4 * 1024 * 1024
#: Usual BM25 settings.
K1, B = 1.2, 0.75
#: From the first letter or digit of a run without white space to its last one.
WORD = re.compile(r"[^\W_](?:\S*[^\W_])?")
#: Rounding of sums.
SLACK = 1e-9


def bare_words(text: str) -> list[str]:
    """Lower-case A-Z, then the runs without white space, each without punctuation at its edges; those of punctuation alone are no words."""
    lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    return WORD.findall(lowered)


def shingles(parts: list[str]) -> set[str]:
    """Runs of five words, or the whole text if it is shorter; none without a word."""
    if not parts:
        return set()
    return {" ".join(parts[n : n + SHINGLE_WORDS]) for n in range(max(1, len(parts) - SHINGLE_WORDS + 1))}


def question_and_answer(text: str) -> tuple[str, str]:
    """The last line that is not blank is the answer if there is another one before it; else all is question."""
    lines = [line for line in text.split("\n") if words(line)]
    return ("\n".join(lines[:-1]), lines[-1]) if len(lines) > 1 else (text, "")


def enough(shared: int, total: int, least: float) -> bool:
    return shared >= least * total - SLACK


def holds(parts: list[str], run: str) -> bool:
    return f" {run} " in f" {' '.join(parts)} "


class Passage:
    """Words and shingles of an item or of a side of it."""

    def __init__(self, text: str):
        self.words = bare_words(text)
        self.shingles = shingles(self.words)

    def most_missing(self, least: float) -> int:
        """How many distinct words can be missing where the wanted share of the shingles is there."""
        missing = math.floor(len(self.shingles) * (1 - least) + SLACK)
        return missing if missing < len(self.shingles) else len(self.words)

    def shared(self, own_words: list[str], own: set[str]) -> int:
        """How many shingles a document has. Fewer than five words are one, held as a run of words anywhere."""
        if self.words and len(self.words) < SHINGLE_WORDS:
            return int(holds(own_words, " ".join(self.words)))
        return len(self.shingles & own)


class ItemIndex:
    """Postings of one part of the items."""

    def __init__(self, items: list[tuple[object, str]], least: float = LEAST_OVERLAP):
        self.least = least
        #: Key, the whole item, its question and its answer, of each item with a word.
        self.items: list[tuple[object, Passage, Passage, Passage]] = []
        for key, text in items:
            whole = Passage(text)
            if whole.words:
                self.items.append((key, whole, *map(Passage, question_and_answer(text))))
        self._post()

    def _least_score(self, weights: dict[str, float], whole: Passage, sides: tuple[Passage, Passage]) -> float:
        """The least score of a document that holds the item in one way or another."""

        def heaviest(passage: Passage) -> float:
            found = sorted((weights[w] for w in set(passage.words)), reverse=True)
            return sum(found[: passage.most_missing(self.least)])

        missing = [heaviest(whole), sum(map(heaviest, sides))]
        if len(whole.words) >= SHINGLE_WORDS:
            missing.append(sum(weights[w] for w in {whole.words[0], whole.words[-1]}))
        return sum(weights.values()) - max(missing)

    def _post(self) -> None:
        n = len(self.items)
        found_in = Counter(word for item in self.items for word in set(item[1].words))
        mean = sum(len(item[1].words) for item in self.items) / max(1, n)
        postings: dict[str, list[tuple[int, float]]] = defaultdict(list)
        for place, (_, whole, *sides) in enumerate(self.items):
            length = K1 * (1 - B + B * len(whole.words) / mean)
            weights = {
                word: math.log(1 + (n - found_in[word] + 0.5) / (found_in[word] + 0.5)) * times * (K1 + 1) / (times + length)
                for word, times in Counter(whole.words).items()
            }
            own = self._least_score(weights, whole, sides)
            for word, weight in weights.items():
                # An item that may lose all its words is found by any one of them.
                postings[word].append((place, weight / own if own > SLACK else 1.0))
        self.postings = dict(postings)
        self.vocabulary = frozenset(postings)
        self.largest = {word: max(w for _, w in found) for word, found in postings.items()}
        self.blocks: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        self.inside: dict[str, dict[int, list[tuple[int, float]]]] = {}
        for word, found in postings.items():
            inside = defaultdict(list)
            for place, weight in found:
                inside[place // BLOCK_ITEMS].append((place, weight))
            self.inside[word] = dict(inside)
            self.blocks[word] = (np.array(list(inside)), np.array([max(w for _, w in p) for p in inside.values()]))

    def retrieve(self, text_words: list[str]) -> list[int]:
        """Places of all items whose score is at the threshold or above, in order."""
        query = self.vocabulary.intersection(text_words)
        if sum(map(self.largest.__getitem__, query)) < 1 - SLACK:
            return []
        numbers, weights = zip(*map(self.blocks.__getitem__, query), strict=True)
        bound = np.bincount(np.concatenate(numbers), np.concatenate(weights))
        found = []
        for block in np.flatnonzero(bound >= 1 - SLACK):
            found += self._walk([p for word in query if (p := self.inside[word].get(int(block)))])
        return found

    @staticmethod
    def _walk(lists: list[list[tuple[int, float]]]) -> list[int]:
        """Weak AND within a block: the pivot is the first item up to which the largest weights add up to the threshold."""
        cursors = [[found[0][0], max(w for _, w in found), 0, found] for found in lists]
        hits = []
        while cursors:
            cursors.sort(key=lambda c: c[0])
            total, pivot = 0.0, None
            for place, largest, _, _ in cursors:
                total += largest
                if total >= 1 - SLACK:
                    pivot = place
                    break
            if pivot is None:
                break
            if cursors[0][0] == pivot and sum(c[3][c[2]][1] for c in cursors if c[0] == pivot) >= 1 - SLACK:
                hits.append(pivot)
            target = pivot + 1 if cursors[0][0] == pivot else pivot
            for cursor in cursors:
                while cursor[2] < len(cursor[3]) and cursor[3][cursor[2]][0] < target:
                    cursor[2] += 1
                cursor[0] = cursor[3][cursor[2]][0] if cursor[2] < len(cursor[3]) else -1
            cursors = [c for c in cursors if c[0] >= 0]
        return hits

    def matches(self, text: str | None) -> list[tuple]:
        """Of each item a text holds: its key, shingles of question, answer and whole, shared and in all, and whether it stands there
        letter for letter."""
        own_words = bare_words(text or "")
        places = self.retrieve(own_words)
        if not places:
            return []
        own, joined, out = shingles(own_words), " ".join(own_words), []
        for place in places:
            key, whole, *sides = self.items[place]
            counts = [(p.shared(own_words, own), len(p.shingles)) for p in (*sides, whole)]
            verbatim = len(whole.words) >= SHINGLE_WORDS and " ".join(whole.words) in joined
            by_sides, by_whole = all(enough(*c, self.least) for c in counts[:2]), enough(*counts[2], self.least)
            if by_sides or by_whole or verbatim:
                out.append((key, *(n for c in counts for n in c), verbatim))
        return out


def indexes(items: DataFrame, key: str, text: str, least: float, part_bytes: int) -> Iterator[ItemIndex]:
    """Indexes of all items that have a word, each over a part of bounded size. Items without a text are left out."""
    rows = items.where(F.col(f"`{text}`").isNotNull()).select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("body"))
    size = rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    parts = math.ceil(size / part_bytes)
    for n in range(parts):
        part = rows.where(F.pmod(F.xxhash64("body", "id"), F.lit(parts)) == n)
        found = [(r.id, r.body) for r in part.orderBy("id", "body").toLocalIterator()]
        if found:
            yield ItemIndex(found, least)


def search(rows: DataFrame, found: Iterator[ItemIndex], passed: Callable, schema, chained: bool) -> DataFrame | None:
    """``passed`` over the rows with each index in turn: each over all rows, or (``chained``) over what the one before it left.

    One index stays with its plan. Of several only one is on the driver and the executors at a time: what it finds is written before it is
    dropped and the next one is built.
    """
    spark, results, ahead = rows.sparkSession, [], next(found, None)
    while ahead is not None:
        shared = spark.sparkContext.broadcast(ahead)
        result, ahead = map_batches(rows, passed(shared), schema), next(found, None)
        if ahead is not None or results:
            result, _ = stage(result, "item-part")
            shared.destroy()
        results.append(result)
        if chained:
            rows = result
    return results[-1] if chained and results else reduce(DataFrame.unionAll, results) if results else None


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    least_overlap: float = LEAST_OVERLAP,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """One row for each document and each item it holds: both keys, the distinct shingles of question, answer and whole item, shared and in
    all, and ``verbatim``.

    NULL and empty texts hold nothing, items without a word are held by nothing, equal items are each reported. Repeated
    documents each come back. Other columns are not read.
    """
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").cast("string").alias("body"))
    kind, item_kind = rows.schema["id"].dataType.simpleString(), items.schema[item_key].dataType.simpleString()
    counts = [f"{part}_{n}" for part in ("question", "answer", "whole") for n in ("shared", "total")]
    names, kinds = [*counts, "verbatim"], [pa.int32()] * len(counts) + [pa.bool_()]
    schema = f"id {kind}, item {item_kind}, " + ", ".join(f"{n} int" for n in counts) + ", verbatim boolean"

    def passed(shared):
        def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [(n, *m) for n, t in enumerate(batch.column(1)) for m in shared.value.matches(t.as_py())]
                if found:
                    places, held, *values = zip(*found, strict=True)
                    values = [pa.array(v, kind) for v, kind in zip(values, kinds, strict=True)]
                    yield pa.record_batch([batch.column(0).take(pa.array(places)), pa.array(held), *values], ["id", "item", *names])

        return of_batches

    found = search(rows, indexes(items, item_key, item_text, least_overlap, part_bytes), passed, schema, chained=False)
    if found is None:
        found = docs.sparkSession.createDataFrame([], schema)
    return found.select(F.col("id").alias(key), F.col("item").alias(item_key), *names)


def keep_clean(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    least_overlap: float = LEAST_OVERLAP,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Documents that hold no item, all columns as they were. NULL and empty texts hold none; repeated rows stay or go together."""
    column = docs.columns.index(text)

    def passed(shared):
        def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array([not shared.value.matches(t.as_py()) for t in batch.column(column)], pa.bool_()))

        return of_batches

    clean = search(docs, indexes(items, item_key, item_text, least_overlap, part_bytes), passed, docs.schema, chained=True)
    return docs if clean is None else clean
