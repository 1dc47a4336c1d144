"""Exact, line and near duplicates against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pricelake.llm import common, components, exact_dedup, line_dedup, near_dedup


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


EDGE = [
    (1, None), (2, ""), (3, "a b c"), (4, "a b c"), (5, " a b c"), (6, "ä\nb"), (7, "ä\nb"), (7, "ä\nb"), (None, "ä\nb"), (None, "only"),
    (8, "x " * 60_000), (9, "x " * 60_000), (10, "\t \n"),
]


def brute_exact(rows):
    groups = defaultdict(list)
    for key, text in rows:
        groups[text or ""].append(key)
    out, seen = [], set()
    for key, text in rows:
        group = groups[text or ""]
        keep = max((k for k in group if k is not None), default=None)
        kept = key == keep and (text or "") not in seen
        if kept:
            seen.add(text or "")
        out.append((key, keep, len(group), kept, hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def test_exact_duplicates(documents, clashing):
    docs = documents(EDGE)
    assert rows_of(exact_dedup.exact_duplicates(docs)) == brute_exact(EDGE)
    assert rows_of(exact_dedup.exact_duplicates(clashing(docs))) == brute_exact(EDGE)
    assert exact_dedup.exact_duplicates(documents([])).count() == 0


def test_exact_duplicates_with_a_full_filter(documents, monkeypatch):
    """A filter whose every cell is hit lets all rows through to the exact grouping."""
    monkeypatch.setattr(exact_dedup, "filter_cells", lambda rows: 2)
    assert rows_of(exact_dedup.exact_duplicates(documents(EDGE))) == brute_exact(EDGE)


def test_bloom_filter_clears_most_single_rows(spark):
    digests = spark.range(20_000).selectExpr("unhex(sha2(cast(id as string), 256)) as digest")
    digests = digests.unionAll(digests.limit(100))
    cells = exact_dedup.filter_cells(digests.count())
    marked = exact_dedup.possibly_repeated(digests, exact_dedup.repeated_cells(digests, cells), cells)
    suspects = marked.where("suspect")
    assert suspects.groupBy("digest").count().where("count > 1").count() == 100
    assert suspects.count() < 200 + 0.05 * 20_000


def test_keep_one_keeps_all_columns(documents, clashing):
    kept = exact_dedup.keep_one(clashing(documents(EDGE)))
    assert kept.columns == clashing(documents(EDGE)).columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted(
        [(2, ""), (4, "a b c"), (5, " a b c"), (7, "ä\nb"), (0, "only"), (9, "x " * 60_000), (10, "\t \n")]
    )
    assert exact_dedup.keep_one(documents([])).count() == 0


def test_row_numbers_in_runs(spark):
    start, numbered = common.runs(common.F.col("copies"), "nth", run=3)
    df = spark.createDataFrame([("a", 7), ("b", 1)], "k string, copies bigint")
    got = df.select("k", start.alias("s")).join(df, "k").select("k", numbered(common.F.col("s")))
    assert rows_of(got) == [("a", n) for n in range(1, 8)] + [("b", 1)]


# Lines.


def brute_lines(rows, least):
    sites = defaultdict(set)
    for _, text, _, site in rows:
        for line in (text or "").split("\n"):
            if line.strip(" "):
                sites[line].add(site or "")
    out = []
    for key, text, _, _ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(sites[x]) < least]
        out.append((key, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def test_shared_lines(documents, clashing):
    rows = [(n, f"own {n}\nshared\n\nshared by a few {n % 4 > 1}\nshared", "en", f"s{n % 12}") for n in range(40)]
    rows += [(50, None, None, None), (51, "", None, "s1"), (52, "shared", None, None), (None, "shared\nalone", None, "s2"), (53, "\n \nshared", None, "s3")]
    rows += [(7, rows[7][1], "en", "other"), (54, "shared\n" + "long " * 50_000, None, "s4")]
    for least in (3, 10, 12, 13):
        assert rows_of(line_dedup.remove_shared_lines(documents(rows), least_sites=least)) == brute_lines(rows, least)
    assert rows_of(line_dedup.remove_shared_lines(clashing(documents(rows)))) == brute_lines(rows, 10)
    assert line_dedup.remove_shared_lines(documents([])).count() == 0


def test_texts_that_lose_no_line_are_not_shuffled(spark, documents):
    """The filter lets a text pass only if no line of it goes, and lets nearly all of those pass."""
    digests = spark.range(3000).selectExpr("unhex(md5(cast(id as string))) as digest", "id")
    cells = exact_dedup.filter_cells(300)
    filter_ = exact_dedup.hit_cells(digests.where("id < 300").select("digest"), cells)
    found = {r.id: r.suspect for r in exact_dedup.possibly_repeated(digests, filter_, cells).collect()}
    assert all(found[n] for n in range(300)) and sum(found.values()) < 310
    nothing = exact_dedup.possibly_repeated(digests, exact_dedup.hit_cells(digests.where("id < 0").select("digest"), cells), cells)
    assert nothing.where("suspect").count() == 0
    rows = [(n, f"own {n}", "en", f"s{n}") for n in range(20)]
    assert rows_of(line_dedup.remove_shared_lines(documents(rows))) == brute_lines(rows, 10)


def test_near_the_limit_lines_are_counted_exactly(spark):
    """Sites far more than a sketch holds exactly, at the limit and one below it."""
    lines = spark.range(5000).selectExpr("'a' as line", "cast(id as string) as site").unionAll(
        spark.range(4999).selectExpr("'b' as line", "cast(id as string) as site")
    )
    docs = lines.selectExpr("monotonically_increasing_id() as doc_id", "line as text", "site as source")
    removed = line_dedup.remove_shared_lines(docs, least_sites=5000)
    assert {(r.n_removed, r["count"]) for r in removed.groupBy("n_removed").count().collect()} == {(1, 5000), (0, 4999)}


# Fingerprints.


def brute_fingerprint(text):
    lowered = "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in text or "")
    parts = re.findall("[^ \t-\r]+", lowered)
    if not parts:
        return 0
    runs = [" ".join(parts[n : n + 3]) for n in range(len(parts) - 2)] or [" ".join(parts)]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", "One", "ONE two", "a b c", "a b c d É É", "x y z " * 3000, "t\tab  b c d e f"])
def test_fingerprint(text):
    assert near_dedup.fingerprint(text) & (1 << 64) - 1 == brute_fingerprint(text)


def test_golay_code_is_perfect():
    table = near_dedup.golay_table()
    assert set(np.bincount(table, minlength=4096)) == {2048}
    words = np.random.default_rng(0).integers(0, 1 << 23, 500)
    for bit in range(23):
        same = np.flatnonzero(table[words] == table[words ^ (1 << bit)])
        assert len(same)


def test_golay_keys_meet_within_two_bits():
    draw = random.Random(3)
    for _ in range(300):
        a = draw.getrandbits(64)
        b = a
        for bit in draw.sample(range(64), draw.randint(0, 2)):
            b ^= 1 << bit
        pair = np.array([a, b], np.uint64)
        stored, looked_up = set(), set()
        for row, key, plain in near_dedup.segment_keys(pair):
            stored |= set(key[(row == 0) & plain].tolist())
            looked_up |= set(key[row == 1].tolist())
        assert stored & looked_up


def brute_components(prints):
    parent = {p: p for p in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    distinct = sorted(parent)
    for n, a in enumerate(distinct):
        for b in distinct[:n]:
            if (a ^ b).bit_count() <= 2:
                parent[root(a)] = root(b)
    return {p: root(p) for p in distinct}


@pytest.mark.parametrize("crowded", [1, 64])
def test_links_against_all_pairs(spark, crowded):
    draw = random.Random(5)
    prints = set()
    for _ in range(25):
        value = draw.getrandbits(64)
        for _ in range(12):
            prints.add(value)
            for bit in draw.sample(range(64), draw.randint(1, 3)):
                value ^= 1 << bit
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    nodes = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    links = near_dedup.linked_fingerprints(nodes, crowded)
    found = {r.node & (1 << 64) - 1: r.root & (1 << 64) - 1 for r in components.connected_components(links).collect()}
    expected = brute_components(prints)
    sizes = Counter(expected.values())
    assert {frozenset(p for p in found if found[p] == r) for r in set(found.values())} == {
        frozenset(p for p in expected if expected[p] == r) for r, n in sizes.items() if n > 1
    }


def test_near_duplicates(documents, clashing):
    base = " ".join(f"w{n}" for n in range(400))
    rows = [(5, base), (3, base), (9, base.replace("w7 ", "w7x ")), (4, None), (2, ""), (6, " \n"), (None, "lonely words"), (8, "Lonely WORDS"), (7, "other text"), (7, "other text")]
    prints = [brute_fingerprint(t) for _, t in rows]
    root = brute_components(prints)
    expected = []
    for (key, _), p in zip(rows, prints, strict=True):
        ids = [k for (k, _), q in zip(rows, prints, strict=True) if root[q] == root[p] and k is not None]
        expected.append((key, f"{p:016x}", min(ids, default=None)))
    assert rows_of(near_dedup.near_duplicates(documents(rows))) == sorted(expected, key=repr)
    assert rows_of(near_dedup.near_duplicates(clashing(documents(rows)))) == sorted(expected, key=repr)
    assert near_dedup.near_duplicates(documents([])).count() == 0


def test_near_keep_one(documents, clashing):
    rows = [(5, "a b c d"), (3, "A b c d"), (None, "a b c d"), (7, "something else")]
    kept = near_dedup.keep_one(clashing(documents(rows)))
    assert kept.columns == clashing(documents(rows)).columns
    assert sorted(repr(r.doc_id) for r in kept.collect()) == ["3", "7"]
    assert near_dedup.keep_one(documents([])).count() == 0


def test_near_keep_one_of_rows_without_own_keys(documents):
    """NULL and repeated keys: one of each group stays, and a row goes by its own text, not by its key."""
    base = [f"w{n}" for n in range(400)]
    copy = lambda n: " ".join([*base[:50], "W50" if n else "w50", *base[51:]])
    rows = [(None, copy(0)), (None, copy(1)), (5, "first text of its own"), (5, "second text of its own"), (8, "one of a pair here")]
    rows += [(9, "ONE of a pair here"), (9, "clean text of its own"), (11, None), (12, ""), (13, " \n")]
    kept = rows_of(near_dedup.keep_one(documents(rows)).select("doc_id", "text"))
    assert [k for k, _ in kept] == [11, 5, 5, 8, 9, None] and (9, "clean text of its own") in kept


@pytest.mark.parametrize("crowded", [1, 64])
def test_near_keep_one_against_brute_force(documents, crowded):
    """Copies with a changed word in long texts: those within two bits of each other, however many, leave one."""
    draw, rows = random.Random(12), []
    for base in range(8):
        parts = [f"w{draw.randrange(3000)}" for _ in range(900)]
        for _ in range(15):
            changed = list(parts)
            for _ in range(draw.randrange(3)):
                changed[draw.randrange(900)] = "changed"
            rows.append((len(rows) * 7 % 1009, " ".join(changed)))
    prints = {k: brute_fingerprint(t) for k, t in rows}
    root = brute_components(prints.values())
    least = {}
    for k, p in prints.items():
        least[root[p]] = min(k, least.get(root[p], k))
    assert len(least) < len(rows)
    assert sorted(r.doc_id for r in near_dedup.keep_one(documents(rows), crowded=crowded).collect()) == sorted(least.values())


def test_long_chain_is_one_component(spark):
    links = spark.range(300).selectExpr("id as a", "id + 1 as b").unionAll(spark.createDataFrame([(500, 400), (400, 500), (600, 600)], "a bigint, b bigint"))
    found = {r.node: r.root for r in components.connected_components(links).collect()}
    assert found == {**dict.fromkeys(range(301), 0), 400: 400, 500: 400}
