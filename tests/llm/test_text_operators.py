"""Operators on single texts and trained models against brute force, round trips and held-out accuracy."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pricelake.llm import decontamination, language_id, language_model, licenses, piece_sampling, token_files, toxicity
from pricelake.session import work_path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


# Language model.


def tokens(text):
    lowered = "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in text or "")
    return [*re.findall("[^ \t-\r]+", lowered), None]


def test_base_scores_and_gain(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    extra = spark.createDataFrame([(-1, None), (-2, ""), (None, "the unseenword unseenword"), (-3, "THE\tof\n")], "doc_id bigint, text string")
    docs = docs.select("doc_id", "text").unionAll(extra).withColumns({n: F.lit("x") for n in ("id", "row", "word", "rare", "learns")})
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    counts = Counter()
    for key, text in texts:
        if zlib.crc32(str("" if key is None else key).encode()) % 5 != 1:
            counts.update(tokens(text))
    n, v = sum(counts.values()), len(counts)
    found = {r.doc_id: r for r in language_model.train_and_score(docs, language_model.training_rows("doc_id")).collect()}
    assert len(found) == len(texts)
    gain = [0.0, 0.0]
    for key, text in texts:
        own = tokens(text)
        row = found[key]
        assert (row.n_tokens, row.n_known, row.train_tokens) == (len(own), sum(counts[t] > 0 for t in own), n)
        base = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in own)
        assert math.isclose(row.base_score, base, rel_tol=1e-9)
        gain[0] += row.base_score
        gain[1] += row.score
    assert gain[1] > gain[0]


def test_model_probabilities_add_up():
    """All units after any context, and all words of a class with one unknown word."""
    draw = np.random.default_rng(2)
    counts = draw.integers(0, 50, language_model.UNITS).astype(float)
    model = language_model.Model.start(counts)
    model = model.moved_to(model.flat() + draw.normal(0, 0.3, model.flat().size))
    before = draw.integers(0, language_model.UNITS + 1, (language_model.CONTEXT, 1))
    every = np.arange(language_model.UNITS)
    logs = language_model.log_probabilities(model, every, np.repeat(before, len(every), axis=1))
    assert abs((10**logs).sum() - 1) < 1e-4
    words = {b"xab": 3, b"yab": 1, b"zcd": 2, b"": 0}
    vocabulary = language_model.Vocabulary(
        6, 3, words, [], {b"ab": language_model.END + 1}, np.array([4.0] + [0] * 126 + [2.0]), np.array([2.0] + [0] * 126 + [1.0]), counts
    )
    unknown = vocabulary.share_of(np.array([language_model.END + 1]), np.array([0]))
    assert abs((10 ** vocabulary.share[:2]).sum() + (10**unknown).sum() - 1) < 1e-12
    assert vocabulary.unit.tolist() == [language_model.END + 1] * 2 + [language_model.UNITS - 1, language_model.END]


def test_training_learns_what_follows_what():
    """Noise-contrastive estimation on a text where each unit is followed by one other."""
    counts = np.zeros(language_model.UNITS)
    counts[:4] = 5000
    trainer = language_model.Trainer(language_model.Model.start(counts), counts, 1)
    units = (np.arange(20_000) % 4).astype(np.int16)
    before = language_model.contexts(units, np.zeros(len(units), np.int64))
    for _ in range(30):
        for k in range(10):
            trainer.learn(units[k::10], before[:, k::10])
    logs = language_model.log_probabilities(trainer.model, units[100:200], before[:, 100:200])
    assert logs.mean() > 3 * math.log10(0.25) / 10


def test_language_model_without_training_texts(documents):
    found = language_model.train_and_score(documents([(1, "a b"), (2, None)]), F.lit(False)).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in sorted(found)] == [(3, 0, 0), (1, 0, 0)]
    assert language_model.train_and_score(documents([]), F.lit(True)).count() == 0


# Languages.


def brute_bundle(text):
    first, second, third = (v.astype(np.int64) for v in language_id.letter_vectors())
    codes = language_id.trigrams(text)
    return sum((first[c // 4096] * second[c // 64 % 64] * third[c % 64] for c in codes), np.zeros(language_id.DIMENSIONS, np.int64))


def test_bundles_are_sums_of_bound_letters():
    texts = ["Ab, cd", "äöü ß", "x" * 3000, "abc abc"]
    assert (language_id.bundle([language_id.trigrams(t) for t in texts]) == np.array([brute_bundle(t) for t in texts])).all()


def test_languages_of_held_out_texts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language_id.learn(docs.where(language_id.training_rows("doc_id")))
    found = language_id.predict_languages(docs, model).join(docs, "doc_id").where(~language_id.training_rows("doc_id"))
    right, every = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right >= 0.95 * every


def test_language_edge_cases(documents, clashing):
    rows = [(1, "the cat and the dog", "en"), (2, "der Hund und die Katze", "de"), (3, None, "en"), (4, "123 !?", "de"), (5, "", None), (6, "the dog", None), (None, "die Katze", None)]
    docs = documents(rows)
    model = language_id.learn(clashing(docs))
    found = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict_languages(clashing(docs), model).collect()}
    assert [found[n] for n in (3, 4, 5)] == [("und", 0.0)] * 3
    assert found[6][0] == "en" and found[None][0] == "de" and 0 < found[6][1] <= 1
    kept = language_id.keep_identified(clashing(docs), model)
    assert kept.columns == clashing(docs).columns and kept.count() == 4
    nothing = language_id.learn(documents([(1, "text", None)]))
    assert rows_of(language_id.predict_languages(docs.limit(1), nothing)) == [(1, "und", 0.0)]
    assert language_id.predict_languages(documents([]), model).count() == 0


def test_texts_stay_where_no_language_was_learned(documents):
    docs = documents([(1, "a clean text", None), (2, "123 !?", None), (3, None, None), (4, "", None)])
    kept = language_id.keep_identified(docs, language_id.learn(docs))
    assert [r.doc_id for r in kept.collect()] == [1]


# Token files.


@pytest.mark.parametrize("top", [1, 200, 300, 70_000, 20_000_000, 2**32 - 1])
def test_packed_ranks_come_back(top):
    ranks = np.random.default_rng(top).integers(0, top + 1, 1003, dtype=np.uint64).astype(np.uint32)
    for count in (0, 1, 4, 1003):
        control, data = token_files.pack(ranks[:count])
        assert len(control) == -(-count // 4)
        assert (token_files.unpack(control, data, count) == ranks[:count]).all()


WORDY = [
    (3, "Hello, the WORLD!! it's <|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>"), (1, None), (2, ""), (9, "café café ́x ΣΑΣ ΣΑΣ. İ"),
    (7, "tabs\tand\x0bfeeds\x0c\x1c\x85  wide"), (None, "no key"), (5, "long " * 30_000), (4, "日本語 テキスト 123456"), (4, "the same key"),
]


def brute_files(rows):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    found = [(key, tokenizer.encode(text or "", add_special_tokens=False).ids + [2]) for key, text in rows]

    def digest(ids):
        """What Spark gives: seed 42, signed."""
        found = xxhash.xxh64_intdigest(np.array(ids, "<u2").tobytes(), seed=42)
        return found - (found >> 63 << 64)

    found.sort(key=lambda r: (r[0] is not None, r[0], digest(r[1])))
    out, start = [], 0
    for key, ids in found:
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [1 << 20, 50])
def test_token_files(documents, clashing, block, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", block)
    docs = clashing(documents(WORDY))
    assert rows_of(token_files.checksums(token_files.token_files_round_trip(docs, TOKENIZER))) == brute_files(WORDY)
    assert token_files.token_files_round_trip(documents([]), TOKENIZER).count() == 0


def test_rows_of_one_key_fill_many_ranges(spark, documents):
    """Most rows have no key, half of them one text: their files are still written by many tasks."""
    rows = [(None, "the same text" if n % 2 else f"text {n}") for n in range(4000)] + [(n, "keyed") for n in range(50)]
    folder = work_path(spark, "token-files-of-one-key")
    joining = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(joining, "false")
    try:
        manifest = token_files.write_token_files(documents(rows).repartition(8), TOKENIZER, folder)
    finally:
        spark.conf.unset(joining)
    assert manifest.where("exists(keys, k -> k is null)").select("part").distinct().count() > 1
    assert rows_of(token_files.checksums(token_files.read_token_files(spark, folder))) == brute_files(rows)


def test_words_of_letters_and_punctuation_keep_their_ids(monkeypatch):
    """Words are taken apart and encoded many in a line; the ids are those of the whole text, in small generations too."""
    monkeypatch.setattr(token_files, "KEPT_WORDS", 300)
    draw = random.Random(12)
    signs = "aeb\u00df\u00fc\u00c4\u00c9\u00d7\u00f7 .,!?;:<>|'\"-_()\u0301\u00a0\u3000\u00f11\u0663\u6f22\u2014`{}~^@#$\n\tst"
    texts = ["".join(draw.choices(signs, k=draw.randint(0, 14))) for _ in range(5000)]
    texts += ["a<|endoftext|>b. X.", "ab.\u0301 c", "ab<.", "a.<|", None]
    texts += [" ".join("".join(draw.choices("abcdeftou\u00e9\u00fc\u00df", k=draw.randint(1, 9))) for _ in range(40)) for _ in range(100)]
    encoder, plain = token_files.WordEncoder(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    assert encoder.lines is not encoder.tokenizer
    for found, text in zip(encoder.encode(texts), texts, strict=True):
        assert np.frombuffer(found, encoder.kind).tolist() == plain.encode(text or "", add_special_tokens=False).ids + [2]


def test_commonest_tokens_take_one_byte(spark):
    tokens = spark.createDataFrame([(np.array([5] * 9 + [7] * 3 + [40_000], "<u2").tobytes(),), (np.array([7], "<u2").tobytes(),)], "ids binary")
    assert token_files.frequency_ranks(tokens, "<u2").tolist() == [5, 7, 40_000]


# Toxicity.


def test_risk_is_corrected():
    """Toxic words are learned though most unlabelled texts that hold them are toxic."""
    draw = random.Random(4)
    plain = [f"w{n}" for n in range(300)]

    def text(toxic):
        found = draw.choices(plain, k=30)
        return " ".join([*found, "vile", "foul"] if toxic else found)

    positive = [toxicity.features(text(True)) for _ in range(80)]
    unlabelled = [toxicity.features(text(n % 10 == 0)) for n in range(1000)]
    counts = [np.bincount(np.concatenate(rows), minlength=2 * toxicity.FEATURES) for rows in (positive, unlabelled)]
    chosen = toxicity.chosen_features(np.arange(2 * toxicity.FEATURES), *counts, len(positive), len(unlabelled))
    sides = [[toxicity.places(row, chosen) for row in rows] for rows in (positive, unlabelled)]
    model = toxicity.fit(*sides, 0.1, chosen)
    assert all(model.scores([text(True) for _ in range(50)]) > 0.5)
    assert (model.scores([text(False) for _ in range(200)]) < 0.5).mean() > 0.97


def test_toxicity_of_held_out_texts(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    learns = toxicity.training_rows("doc_id")
    model = toxicity.learn(docs.where(learns), labels.where(learns))
    found = toxicity.score(docs, model).join(labels, "doc_id").where(~learns)
    row = found.selectExpr("sum(predicted * toxic) hit", "sum(predicted) said", "sum(toxic) there").first()
    assert row.hit >= 0.8 * row.there and row.hit >= 0.8 * row.said


def test_toxicity_edge_cases(spark, documents, clashing):
    docs = clashing(documents([(1, None), (2, ""), (3, "fine words"), (3, "fine words"), (None, "no key"), (4, "bad " * 100_000)]))
    labels = spark.createDataFrame([(3, 0, 1), (4, 0, None), (None, 0, 1), (9, 1, 0)], "doc_id bigint, quality int, toxic int")
    for known in (labels, labels.limit(0)):
        found = toxicity.score(docs, toxicity.learn(docs, known)).collect()
        assert len(found) == 6 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    assert toxicity.score(documents([]), toxicity.learn(documents([]), labels)).count() == 0


def test_bounds_choose_by_hash(documents, spark):
    docs = documents([(n, f"text {n}") for n in range(50)])
    labels = spark.createDataFrame([(n, 1, int(n < 20)) for n in range(50)], "doc_id bigint, quality int, toxic int")
    assert isinstance(toxicity.learn(docs, labels, most_positive=5, most_unlabelled=10), toxicity.Classifier)


# Pieces.


def edges_at(pieces, text, end):
    """(start, piece, weight) of the pieces that end at a place; the character itself in bytes if it is none."""
    found = [(s, text[s:end], pieces.weight[text[s:end]]) for s in range(max(0, end - 40), end) if text[s:end] in pieces.weight]
    if text[end - 1] not in pieces.weight:
        found.append((end - 1, text[end - 1], pieces.byte_weight * len(text[end - 1].encode())))
    return found


def brute_pieces(key, text, seed=piece_sampling.SEED, sharpness=1.0):
    """One forward pass over the whole text, one backward pass."""
    pieces = piece_sampling.Pieces(MODEL, sharpness)
    full = " " + text if text else ""
    ways, edges = [0.0], [[]]
    for end in range(1, len(full) + 1):
        found = edges_at(pieces, full, end)
        edges.append([(s, p, ways[s] + w) for s, p, w in found])
        top = max(w for _, _, w in edges[-1])
        ways.append(top + math.log(sum(math.exp(w - top) for _, _, w in edges[-1])))
    out, at = [], len(full)
    base = np.array([piece_sampling.row_seed(key, seed)], np.uint64)
    while at:
        u, reached = piece_sampling.drawn(base, np.array([at]))[0], 0.0
        for start, piece, weight in edges[at]:
            reached += math.exp(weight - ways[at])
            if u < reached:
                break
        ids = [pieces.ids[piece]] if piece in pieces.ids else [pieces.byte_ids[b] for b in piece.encode()]
        out[:0] = ids
        at = start
    return out


PIECED = [
    (1, "Hello world, unbelievable things"), (2, ""), (3, None), (4, "  two  spaces end  "), (5, "▁ literal ▁x 漢字𝒳 ́"), (6, "\n\ttabs\r\n"),
    (7, "x" * 500), (None, "no key here"), (1, "Hello world, unbelievable things"), (8, "<s> </s> <unk> <0x41>"),
]


def test_sampled_pieces_against_one_lattice(documents, clashing):
    found = piece_sampling.encode_and_decode(clashing(documents(PIECED)), MODEL).collect()
    assert sorted(((r.doc_id, r.text) for r in found), key=repr) == sorted(((k, t or "") for k, t in PIECED), key=repr)
    for r in found:
        assert r.pieces == brute_pieces(r.doc_id, r.text) and r.n_pieces == len(r.pieces)
    again = piece_sampling.decode(piece_sampling.encode(documents(PIECED), MODEL).drop("text"), MODEL)
    assert sorted(((r.doc_id, r.decoded) for r in again.collect()), key=repr) == sorted(((k, t or "") for k, t in PIECED), key=repr)
    assert documents(PIECED).count() and piece_sampling.decode(again.selectExpr("CAST(NULL AS ARRAY<INT>) AS pieces"), MODEL).first().decoded == ""
    assert piece_sampling.encode_and_decode(documents([]), MODEL).count() == 0


def test_long_text_comes_back(documents):
    text = "Ähm the quick brown fox. " * 20_000 + "y" * 3000
    row = piece_sampling.encode_and_decode(documents([(1, text)]), MODEL).first()
    assert row.text == text


def test_samples_follow_the_weights():
    """Frequencies of all segmentations of a short word against their exact probabilities."""
    pieces = piece_sampling.Pieces(MODEL, 1.0)
    full = " the"
    weights = {}

    def walk(at, so_far, weight):
        if at == len(full):
            weights[so_far] = math.exp(weight)
        for end in range(at + 1, len(full) + 1):
            if (piece := full[at:end]) in pieces.ids:
                walk(end, (*so_far, pieces.ids[piece]), weight + pieces.weight[piece])

    walk(0, (), 0.0)
    lattices = piece_sampling.Lattices(pieces)
    times = 20_000
    codes, counts = piece_sampling.sample_block(lattices, ["the"] * times, [piece_sampling.row_seed(n, 1) for n in range(times)])
    ends = np.cumsum(counts)
    seen = Counter(tuple(codes[e - n : e].tolist()) for e, n in zip(ends, counts, strict=True))
    total = sum(weights.values())
    for way, weight in weights.items():
        share = weight / total
        assert abs(seen[way] / times - share) < 5 * math.sqrt(share * (1 - share) / times) + 1e-9
    assert set(seen) <= set(weights)


# Contamination.


def brute_held(docs, items):
    """Of each document and item it holds: shingles of question, answer and whole, shared and in all, and whether it stands there letter for letter."""
    def bare(text):
        return [w for w in tokens(" ".join(re.sub(r"^[\W_]+|[\W_]+$", "", w) for w in (text or "").split()))[:-1]]

    def runs(parts, width):
        return {tuple(parts[n : n + width]) for n in range(len(parts) - width + 1)} if parts else set()

    out = []
    for key, text in docs:
        own = bare(text)
        for item, content in items:
            lines = [x for x in (content or "").split("\n") if tokens(x)[:-1]]
            question, answer = ("\n".join(lines[:-1]), lines[-1]) if len(lines) > 1 else (content or "", "")
            counts = []
            for piece in (question, answer, content):
                asked = bare(piece)
                width = min(5, len(asked))
                counts += [len(runs(asked, width) & runs(own, width)), len(runs(asked, width))]
            every = bare(content)
            verbatim = len(every) >= 5 and " ".join(every) in " ".join(own)
            found = [shared >= 0.8 * total - 1e-9 for shared, total in zip(counts[::2], counts[1::2], strict=True)]
            if every and (found[0] and found[1] or found[2] or verbatim):
                out.append((key, item, *counts, verbatim))
    return sorted(out, key=repr)


def brute_clean(docs, items):
    """Keys of the documents that hold no item."""
    held = {r[0] for r in brute_held(docs, items)}
    return [key for key, _ in docs if key not in held]


def test_contamination_against_brute_force(spark, documents, clashing):
    draw = random.Random(8)
    vocabulary = [f"v{int(draw.paretovariate(0.7)) % 400}" for _ in range(600)]
    items = [(n, " ".join(draw.choices(vocabulary, k=draw.randint(1, 40))) + ("\n" + " ".join(draw.choices(vocabulary, k=draw.randint(1, 9))) if n % 2 else "")) for n in range(60)]
    items += [(100, None), (101, " \n"), (5, items[5][1]), (102, "short one"), (103, "q w e\nanswer"), (None, "a b c d e f g")]
    docs = [(n, " ".join(draw.choices(vocabulary, k=draw.randint(0, 300)))) for n in range(60)]
    for n in range(120):
        planted = items[draw.randrange(60)][1].split()
        for _ in range(draw.randint(0, 6)):
            planted[draw.randrange(len(planted))] = "changed" if draw.random() < 0.5 else planted[0].upper()
        docs.append((1000 + n, f"before {' '.join(planted)} after"))
    docs += [(None, "Q w e answer"), (3000, None), (3001, ""), (3002, "a b c d e f g " * 5000), (3003, "q w eanswer short onex")]
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    for part_bytes in (4 << 20, 1500):
        found = decontamination.contaminated(clashing(documents(docs)), asked, part_bytes=part_bytes)
        assert rows_of(found) == brute_held(docs, items)
    held = Counter(r[0] for r in brute_held(docs, items))
    for part_bytes in (4 << 20, 1500):
        kept = decontamination.keep_clean(clashing(documents(docs)), asked, part_bytes=part_bytes)
        assert kept.columns == clashing(documents(docs)).columns
        assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((k for k, _ in docs if k not in held), key=repr)
    assert decontamination.contaminated(documents(docs), asked.limit(0)).count() == 0
    assert decontamination.contaminated(documents([]), asked).count() == 0


def test_walk_finds_what_full_scores_find():
    draw = random.Random(9)
    items = [(n, " ".join(draw.choices([f"t{k}" for k in range(30)], k=12))) for n in range(200)]
    index = decontamination.ItemIndex(items)
    for _ in range(200):
        query = [f"t{k}" for k in draw.sample(range(30), draw.randint(1, 12))]
        sums = defaultdict(float)
        for word in set(query) & index.vocabulary:
            for place, weight in index.postings[word]:
                sums[place] += weight
        assert index.retrieve(query) == sorted(p for p, s in sums.items() if s >= 1 - 1e-9)


def test_verbatim_items_with_glued_neighbours(spark, documents):
    """Items with something glued to either end, which the check of question and answer one by one does not see."""
    question = "Which of the rivers named here runs through the old town?"
    items = [(1, f"{question}\nThe Elbe."), (2, "One two three four five six"), (3, "tiny item\nyes"), (4, None), (5, "%%% ...")]
    docs = [(1, f"before {question}\nThe Elbe.%%% after"), (2, f"%%%{question} The Elbe.after"), (3, f"pre{question} The Elbe.%%%"),
            (4, "xOne two three four five sixty"), (5, "a (tiny item) \"yes\" b"), (6, f"x {question}\nThe Elbe. y")]
    clean = [(10, f"before {question} after"), (11, "The Elbe."), (12, "One two three four"), (13, "tiny items yes"), (14, None), (15, "")]
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    kept = decontamination.keep_clean(documents(docs + clean), asked)
    assert sorted(r.doc_id for r in kept.collect()) == [k for k, _ in clean]
    found = decontamination.contaminated(documents(docs + clean), asked)
    assert rows_of(found) == brute_held(docs + clean, items)
    assert {r.doc_id for r in found.collect()} == {k for k, _ in docs}


def test_whole_items_lose_nothing_in_the_index():
    """Items with changed words and glued ends, against a check of every item."""
    draw = random.Random(10)
    vocabulary = [f"v{int(draw.paretovariate(0.7)) % 300}" for _ in range(400)]
    items = [(n, " ".join(draw.choices(vocabulary, k=draw.randint(1, 40))) + ("\n" + " ".join(draw.choices(vocabulary, k=draw.randint(1, 9))) if n % 2 else "")) for n in range(80)]
    index = decontamination.ItemIndex(items)
    for _ in range(400):
        planted = items[draw.randrange(80)][1].split()
        for _ in range(draw.randint(0, 5)):
            planted[draw.randrange(len(planted))] = "changed"
        text = f"before{draw.choice(['', ' '])}{' '.join(planted)}{draw.choice(['', ' ', '.. '])}after {' '.join(draw.choices(vocabulary, k=60))}"
        assert sorted((0, *m) for m in index.matches(text)) == sorted(brute_held([(0, text)], items))


@pytest.mark.parametrize("size", [1, 4, 5, 6, 9, 13, 30])
def test_missing_words_are_bounded_by_missing_shingles(size):
    """The bound the thresholds rest on, for drawn passages and drawn missing words, repeated words included."""
    draw = random.Random(size)
    for trial in range(2000 if size > 9 else 200):
        passage = decontamination.Passage(" ".join(draw.choices([f"p{n}" for n in range(draw.choice([3, 50]))], k=size)))
        distinct = sorted(set(passage.words))
        gone = set(draw.sample(distinct, draw.randint(0, min(len(distinct), 7))))
        left = {s for s in passage.shingles if not gone & set(s.split())}
        for least in (0.5, 0.8, 0.95):
            if len(left) >= least * len(passage.shingles) - 1e-9:
                assert len(gone) <= passage.most_missing(least)


# Licences.


def brute_cosine(passage, template, idf, rarest):
    a, b = Counter(licenses.words(passage)), Counter(licenses.words(template))
    weigh = lambda c: {w: n * idf.get(w, rarest) for w, n in c.items()}
    a, b = weigh(a), weigh(b)
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    return sum(x * b.get(w, 0) for w, x in a.items()) / (norm(a) * norm(b))


FILES = [
    (1, "host/a/LICENSE", "Released under the MIT License."), (2, "host/a/b/c.txt", "plain"), (3, "host/a/b/COPYING.md", "Licensed under CC BY-NC 4.0."),
    (4, "host/a/b/d/e.txt", None), (5, "host/x.txt", ""), (6, "host/a/own.txt", "text\n\nLicensed under the Apache License, Version 2.0.\nmore text here"),
    (7, None, "no path"), (8, "/host//a/", "plain"), (9, "host/ab/file", "not below a"), (10, "host/a/licenses.txt", "nothing of the kind"), (2, "host/a/b/c.txt", "plain"),
    (11, "host/a/b/long", "word " * 50_000),
]


def test_licences_are_inherited(spark, clashing):
    files = spark.createDataFrame(FILES, "file_id bigint, path string, text string")
    found = {r.file_id: (r.licence, r.origin, r.licence_path) for r in licenses.scan_licences(clashing(files), "file_id").collect()}
    mit, cc = ("MIT", "inherited", "host/a/LICENSE"), ("CC-BY-NC-4.0", "inherited", "host/a/b/COPYING.md")
    assert found == {
        1: ("MIT", "own", "host/a/LICENSE"), 2: cc, 3: ("CC-BY-NC-4.0", "own", "host/a/b/COPYING.md"), 4: cc, 5: (None, None, None),
        6: ("Apache-2.0", "own", "host/a/own.txt"), 7: (None, None, None), 8: (None, None, None), 9: (None, None, None), 10: mit, 11: cc,
    }
    assert licenses.scan_licences(files, "file_id").count() == len(FILES)
    assert licenses.scan_licences(files.limit(0), "file_id").count() == 0


def test_cosines_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.lit("p").alias("path"), "text")
    texts = [(r.doc_id, r.text or "") for r in docs.collect()]
    vocabulary = {w for _, t in licenses.TEMPLATES for w in licenses.words(t)}
    counts = Counter(w for _, t in texts for w in set(licenses.words(t)) & vocabulary)
    idf = {w: 1 + math.log((1 + len(texts)) / (1 + counts[w])) for w in vocabulary}
    expected = {}
    for key, text in texts:
        best = max(((round(brute_cosine(p, t, idf, 1 + math.log(1 + len(texts))), 9), -n) for p in licenses.passages(text) if licenses.words(p) for n, (_, t) in enumerate(licenses.TEMPLATES)), default=(0, 0))
        expected[key] = licenses.TEMPLATES[-best[1]][0] if best[0] >= licenses.LEAST_COSINE else None
    found = {r.doc_id: r.licence for r in licenses.scan_licences(docs, "doc_id").collect()}
    assert found == expected and any(expected.values())


NOTICES = [
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-ND-4.0", "Licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0"), ("CC-BY-ND-4.0", "licensed under CC-BY-ND 4.0"),
    ("CC-BY-4.0", "Copyright 2021 Jane Doe. Licensed under CC BY 4.0."), (None, "Licensed under CC BY 2.5."), ("CC-BY-3.0", "Licensed under CC BY 3.0."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1"),
    ("GPL-3.0", "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\n"
     "the Free Software Foundation; either version 2 of the License, or\n(at your option) any later version."),
    ("ISC", "Copyright (c) 2020, A. Person\n\nPermission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, "
     "provided that the above\ncopyright notice and this permission notice appear in all copies."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"
     " which is available at https://www.eclipse.org/legal/epl-2.0"),
    ("BSD-2-Clause", BSD := "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n\n"
     "1. Redistributions of source code must retain the above copyright notice.\n2. Redistributions in binary form must reproduce it."),
    ("BSD-3-Clause", BSD + "\n3. Neither the name of the copyright holder nor the names of its\n   contributors may be used to endorse or promote products derived from\n"
     "   this software without specific prior written permission."),
    (None, "We were commercial travellers and released nothing under any terms."),
    ("Apache-2.0", "#!/bin/sh\n# SPDX-License-Identifier: Apache-2.0\nset -e"), ("MIT", "/* SPDX-License-Identifier: MIT */"),
    ("GPL-2.0", "// SPDX-License-Identifier: GPL-2.0-only"), ("GPL-3.0", "// SPDX-License-Identifier: GPL-3.0-or-later"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"), ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("CC-BY-NC-3.0", "SPDX-License-Identifier: CC-BY-NC-3.0"), (None, "SPDX-License-Identifier: Elsewhere-1.0"), (None, "SPDX-License-Identifier:"),
    ("CC-BY-3.0", "This work is licensed under a Creative Commons Attribution 3.0 Unported License."), ("CC-BY-SA-3.0", "licensed under CC BY-SA 3.0"),
    ("Zlib", "This software is provided 'as-is', without any express or implied\nwarranty. In no event will the authors be held liable for any damages\n"
     "arising from the use of this software."),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose,\nincluding commercial applications, and to alter it and redistribute it\n"
     "freely, subject to the following restrictions:"),
    ("BSL-1.0", "//          Copyright Joe Coder 2004 - 2006.\n// Distributed under the Boost Software License, Version 1.0.\n//    (See accompanying file LICENSE_1_0.txt)"),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003"),
    ("WTFPL", "        DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE\n                    Version 2, December 2004"),
]


def test_notices_that_differ_in_few_words():
    matcher = licenses.Matcher(licenses.TEMPLATES, 2500, {"the": 2400, "this": 1500, "and": 2300, "of": 2400, "to": 2400, "in": 2200, "is": 1800})
    assert [matcher.of_text(text, licenses.LEAST_COSINE)[0] for _, text in NOTICES] == [name for name, _ in NOTICES]


def test_common_words_stay_within_their_bound(spark):
    counts = spark.createDataFrame([(f"w{n}".encode(), 1 + n // 3) for n in range(12)], "word binary, times bigint")
    for most, least in ((12, 1), (11, 2), (6, 3), (5, 4), (3, 4), (2, None)):
        found = language_model.common_words(counts, most).collect()
        assert len(found) <= most and len(found) == (0 if least is None else 3 * (5 - least))


def test_examples_beyond_the_bound_have_the_smallest_hashes(documents, spark, monkeypatch):
    taken = {}
    monkeypatch.setattr(toxicity, "fit", lambda p, u, prior, chosen: taken.update(p=len(p), u=len(u)))
    docs = documents([(n, f"text {n}") for n in range(3000)])
    labels = spark.createDataFrame([(n, 1, int(n < 2000)) for n in range(3000)], "doc_id bigint, quality int, toxic int")
    toxicity.learn(docs, labels, most_positive=50, most_unlabelled=100)
    assert taken == {"p": 50, "u": 100}


def test_examples_stay_within_their_bound_when_keys_repeat(documents, spark, monkeypatch):
    """Keys of very many rows, toxic or not: a key is one example, and all the wanted keys are taken."""
    taken = {}
    monkeypatch.setattr(toxicity, "fit", lambda p, u, prior, chosen: taken.update(p=len(p), u=len(u)))
    docs = documents([(n, f"text {n}") for n in range(600)] + [(n % 3, f"again {n % 7}") for n in range(900)])
    labels = spark.createDataFrame([(n, 1, int(n < 200)) for n in range(600)] + [(1, 1, 1)] * 300, "doc_id bigint, quality int, toxic int")
    toxicity.learn(docs, labels, most_positive=40, most_unlabelled=80)
    assert taken == {"p": 40, "u": 80}


@pytest.mark.parametrize("prior", [0.1, 0.5, 0.9])
def test_fit_against_plain_lists(monkeypatch, prior):
    """The same steps on the non-negative risk, written with lists and sums."""
    monkeypatch.setattr(toxicity, "STEPS", 40)
    draw = random.Random(3)
    size = 8
    rows = lambda n, weights: [sorted({draw.choices(range(size), weights)[0] for _ in range(4)}) for _ in range(n)]
    positive, unlabelled = rows(20, [8, 4, 1, 1, 1, 1, 1, 1]), rows(60, [1, 1, 1, 4, 4, 4, 4, 4])
    theta, mean, square = [0.0] * (size + 1), [0.0] * (size + 1), [0.0] * (size + 1)
    theta[-1] = math.log(prior / (1 - prior))
    sigmoid = lambda x: 1 / (1 + math.exp(-x))
    for step in range(1, 41):
        score = lambda row: sum(theta[f] for f in row) + theta[-1]
        as_negative = lambda row: math.log1p(math.exp(score(row)))
        risk = sum(map(as_negative, unlabelled)) / 60 - prior * sum(map(as_negative, positive)) / 20
        slope = [toxicity.DECAY * t for t in theta[:-1]] + [0.0]
        sign = 1 if risk >= 0 else -1
        for group, each in ((positive, -prior / 20), (unlabelled, 1 / 60)):
            for row in group:
                outer = sign * each * sigmoid(score(row))
                if risk >= 0 and group is positive:
                    outer -= prior / 20 * sigmoid(-score(row))
                for f in [*row, size]:
                    slope[f] += outer
        mean = [0.9 * m + 0.1 * s for m, s in zip(mean, slope, strict=True)]
        square = [0.999 * q + 0.001 * s * s for q, s in zip(square, slope, strict=True)]
        theta = [
            t - toxicity.RATE * (m / (1 - 0.9**step)) / (math.sqrt(q / (1 - 0.999**step)) + 1e-8)
            for t, m, q in zip(theta, mean, square, strict=True)
        ]
    as_arrays = [[np.array(r, np.int32) for r in side] for side in (positive, unlabelled)]
    model = toxicity.fit(*as_arrays, prior, np.arange(size))
    assert np.allclose(model.weights[:size], theta[:-1], atol=1e-9) and abs(model.bias - theta[-1]) < 1e-6
