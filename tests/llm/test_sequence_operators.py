"""Periodic runs, repeated byte strings and conversation prefixes against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pricelake.llm import periodic_runs, prefix_trie, suffix_dedup
from pricelake.session import release


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


# Runs.


def brute_runs(parts):
    found = set()
    for period in range(1, len(parts) // 2 + 1):
        start = 0
        while start + period < len(parts):
            end = start
            while end + period < len(parts) and parts[end] == parts[end + period]:
                end += 1
            length = end + period - start
            if end > start and length >= max(12, 2 * period):
                stretch = parts[start : start + length]
                if not any(stretch[q:] == stretch[:-q] for q in range(1, period)):
                    found.add((start, length, period))
            start = max(end, start + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_found(key, text, plant):
    """The digest row of one document."""
    parts = (text or "").encode().split()
    checksum = zlib.crc32(b"" if key is None else str(key).encode())
    if plant and checksum % 10 == 0 and parts:
        times, n = checksum // 10, len(parts)
        a = times % n
        p = 1 + (n - a) // (3 + times % 8)
        parts = [parts[i] if i < a else parts[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(parts)
    dropped = {i for s, n, p in runs for i in range(s + p, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        key, len(runs), *best, best[1] and 1000 * best[1] // best[2], digest("".join(f"{s},{n},{p}\n" for s, n, p in runs)),
        digest(" ".join(w.decode() for i, w in enumerate(parts) if i not in dropped)),
    )


def test_runs_of_random_texts():
    draw = random.Random(2)
    for _ in range(400):
        texts = []
        for _ in range(draw.randint(1, 4)):
            parts = [b"%d" % draw.randrange(draw.choice([1, 2, 3, 6])) for _ in range(draw.randint(0, 50))]
            if draw.random() < 0.4:
                parts += [b"%d" % draw.randrange(4) for _ in range(draw.randint(1, 9))] * draw.randint(2, 8)
            texts.append(parts)
        assert periodic_runs.runs_of(texts) == [brute_runs(t) for t in texts]


RUN_TEXTS = [
    (1, None), (2, ""), (3, " \n\t"), (4, "a " * 12), (5, "a " * 11), (6, "ä b c " * 6 + "end"), (7, "x y " * 6 + "z " + "x y " * 6), (None, "no key " * 7),
    (8, "q " * 30_000), (9, "once upon a time"), (9, "once upon a time"), (10, "a b a b a b a b a b a b c a b a b a b a b a b a b c"),
]


@pytest.mark.parametrize("plant", [False, True])
def test_find_runs(documents, clashing, plant):
    names = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    planted = [n for n in range(400) if zlib.crc32(str(n).encode()) % 10 == 0]
    draw = random.Random(6)
    rows = RUN_TEXTS + [(n, " ".join(str(draw.randrange(900)) for _ in range(draw.randint(1, 300)))) for n in planted[:40]]
    rows = [r for r in rows if r[0] != 8]
    want = sorted((brute_found(k, t, plant) for k, t in rows), key=repr)
    for docs in (documents(rows), clashing(documents(rows))):
        assert rows_of(periodic_runs.find_runs(docs, plant=plant, with_text=False).select(*names)) == want
    assert periodic_runs.find_runs(documents([])).count() == 0


def test_find_runs_gives_runs_and_text(documents):
    found = {r.doc_id: r for r in periodic_runs.find_runs(documents(RUN_TEXTS)).collect()}
    assert (found[8].n_words, found[8].starts, found[8].lengths, found[8].periods, found[8].collapsed) == (30_000, [0], [30_000], [1], "q")
    assert (found[7].starts, found[7].periods, found[7].collapsed) == ([0, 13], [2, 2], "x y z x y")
    assert found[1].collapsed == "" and found[1].n_runs == 0 and found[1].start is None
    assert (found[4].exponent_milli, found[5].n_runs) == (12_000, 0)


# Byte strings.


def brute_kept(rows, length):
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for (key, _), d in zip(rows, data, strict=True):
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        out.append((key, len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


KEPT = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_cover_meets_every_distance():
    cover = suffix_dedup.COVER
    assert {(a - b) % suffix_dedup.PERIOD for a in cover for b in cover} == set(range(suffix_dedup.PERIOD))


@pytest.mark.parametrize("length", [40, 64, 200])
def test_repeated_starts(length):
    draw = random.Random(length)
    for _ in range(40):
        pool = [bytes(draw.choice(b"ab") for _ in range(draw.randint(100, 400))) for _ in range(3)]
        text = b""
        while len(text) < draw.randint(300, 3000):
            text += draw.choice(pool) if draw.random() < 0.5 else bytes(draw.choice(b"abc") for _ in range(draw.randint(1, 200)))
        starts = np.array(sorted(draw.sample(range(len(text) - length + 1), (len(text) - length) // 2 + 1)))
        seen = Counter(text[s : s + length] for s in starts.tolist())
        assert suffix_dedup.repeated_starts(text, starts, length).tolist() == [seen[text[s : s + length]] > 1 for s in starts.tolist()]


def test_equal_windows_have_equal_anchors(monkeypatch):
    draw = random.Random(1)
    text = b"".join(draw.choice([b"abcdefgh" * 9, b"x" * 130, bytes(draw.choice(b"abcdefg") for _ in range(150))]) for _ in range(60))
    for stride in (suffix_dedup.STRIDE, 700):
        monkeypatch.setattr(suffix_dedup, "STRIDE", stride)
        of = defaultdict(set)
        covered = 0
        for h, at, first, last in zip(*(x.tolist() for x in suffix_dedup.anchors(np.frombuffer(text, np.uint8))), strict=True):
            covered += last - first + 1
            for start in range(first, last + 1):
                assert start <= at <= start + 200 - suffix_dedup.PIECE
                of[text[start : start + 200]].add((h, at - start))
        assert covered == len(text) - 199 and {len(v) for v in of.values()} == {1}


def copied_texts(draw):
    passage = "".join(draw.choice("abcdefg äö") for _ in range(350))
    letters = lambda n: "".join(draw.choice("abcdefgh \n") for _ in range(n))
    rows = [(n, letters(draw.randint(0, 500)) + passage[draw.randint(0, 80) : draw.randint(260, 350)] + letters(draw.randint(0, 300))) for n in range(30)]
    rows += [(n, letters(draw.randint(100, 600))) for n in range(30, 45)]
    rows += [(50, None), (51, ""), (52, passage[:199]), (53, rows[3][1]), (53, rows[3][1]), (None, rows[4][1]), (54, "x" * 199), (55, "y" * 200), (56, "z" * 201)]
    return rows + [(57, passage * 3), (58, "lonely " * 400), (59, "ab" * 150 + letters(50)), (60, "q" * 2000)]


@pytest.mark.parametrize("crowded", [2, suffix_dedup.CROWDED])
def test_remove_repeats(spark, documents, clashing, crowded):
    rows = copied_texts(random.Random(8))
    for docs in (documents(rows), clashing(documents(rows))):
        assert rows_of(suffix_dedup.remove_repeats(docs, crowded=crowded, with_bytes=False).select(*KEPT)) == brute_kept(rows, 200)
    release(spark)


def test_remove_repeats_shuffled_when_large(spark, documents, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BROADCAST_LIMIT_BYTES", -1)
    rows = copied_texts(random.Random(9))
    assert rows_of(suffix_dedup.remove_repeats(documents(rows), with_bytes=False).select(*KEPT)) == brute_kept(rows, 200)
    release(spark)


def test_remove_repeats_gives_bytes(spark, documents):
    text = "".join(random.Random(3).choices("abcdefgh", k=300))
    found = {r.doc_id: r for r in suffix_dedup.remove_repeats(documents([(1, "head" + text), (2, text + "tail"), (3, "short")])).collect()}
    assert (bytes(found[1].kept), found[1].begins, found[1].ends) == (b"head", [4], [304])
    assert (bytes(found[2].kept), bytes(found[3].kept), found[3].begins) == (b"tail", b"short", [])
    assert suffix_dedup.remove_repeats(documents([])).count() == 0
    release(spark)


# Conversations.

TURNS = "conv_id bigint, turn bigint, role string, text string"
NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute_trie(rows, rebuild):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            order = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, order, role, text))
    own = {c: [t[3:] for t in sorted(v)] for c, v in own.items()}
    whole = own
    if rebuild:
        heads = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
        whole = {c: own.get(c - c % 5, [])[: heads[c]] + v[heads[c] :] for c, v in own.items()}
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(path[:-1] for path in members if path)
    leaves, saved = Counter(), Counter()
    for path, convs in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(convs) - 1) * len(path[-1][1].encode()) if path else 0
    out = []
    for path, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(whole[c]) == len(path))
        above = min(members[path[:-1]]) if path else None
        out.append((min(convs), len(path), above, len(convs), children[path], leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def random_turns(draw, conversations):
    rows = []
    for c in conversations:
        rows += [(c, n, draw.choice(["user", "bot"]), draw.choice(["a", "b", "ää"])) for n in range(draw.randint(1, 7))]
    return rows


@pytest.mark.parametrize("rebuild", [False, True])
def test_conversation_trie(spark, rebuild):
    draw = random.Random(11)
    rows = random_turns(draw, [*range(0, 60), *range(1003, 1030), 5001])
    rows += [(70, None, None, None), (70, None, "user", "x"), (70, 3, "user", ""), (70, 3, "user", ""), (70, 3, "bot", "long " * 9000), (None, 1, "user", "no one")]
    rows += [(80 + n, t, "user", f"same {t}") for n in range(30) for t in range(4)]
    df = spark.createDataFrame(rows, TURNS)
    want = brute_trie(rows, rebuild)
    assert rows_of(prefix_trie.conversation_trie(df, rebuild).select(*NODE)) == want
    more = df.selectExpr("*", "'x' AS c", "'x' AS depth", "'x' AS x1", "'x' AS content", "'x' AS size")
    assert rows_of(prefix_trie.conversation_trie(more, rebuild).select(*NODE)) == want
    release(spark)


def test_trie_of_nothing_and_of_full_sketch(spark, monkeypatch):
    assert prefix_trie.conversation_trie(spark.createDataFrame([], TURNS), True).count() == 0
    monkeypatch.setattr(prefix_trie, "sketch_cells", lambda n: 2)
    rows = random_turns(random.Random(5), range(40))
    assert rows_of(prefix_trie.conversation_trie(spark.createDataFrame(rows, TURNS), True).select(*NODE)) == brute_trie(rows, True)
    release(spark)


def test_long_conversations_are_split(spark, monkeypatch):
    """Blocks of four turns and blocks of four ids: totals carry over."""
    monkeypatch.setattr(prefix_trie, "BLOCK_TURNS", 4)
    monkeypatch.setattr(prefix_trie, "ID_BLOCK", 4)
    rows = [(c, t, "user", f"{t}{'x' if (c, t) in ((7, 20), (11, 33)) else ''}") for c in (5, 6, 7, 11, 12) for t in range(40)]
    rows += [(c, t, "user", "same") for c in range(20, 50) for t in range(2)]
    for rebuild in (False, True):
        assert rows_of(prefix_trie.conversation_trie(spark.createDataFrame(rows, TURNS), rebuild).select(*NODE)) == brute_trie(rows, rebuild)
    release(spark)


def test_screening_shows_singletons(spark):
    """At eight cells a beginning nearly all of a table of lonely conversations is proved alone and never grouped."""
    rows = [(c, t, "user", f"{c} {t}") for c in range(500) for t in range(4)]
    turns = prefix_trie.turns_of(spark.createDataFrame(rows, TURNS))
    found = prefix_trie.prefixes(turns, turns.groupBy("c").agg(prefix_trie.F.count("*").alias("turns")))
    cells = prefix_trie.sketch_cells(found.count())
    marked = prefix_trie.screened(found, cells, prefix_trie.crowded_cells(found, cells))
    assert marked.where("shared").count() < 40
    release(spark)
