"""Registered corpus queries against their SQL, and the pipeline stage by stage against brute force."""

from __future__ import annotations

import corpus_pipeline
import duckdb
import public_tokenizers
import pytest
import test_dedup as dedup
import test_sequence_operators as sequences
import test_text_operators as texts
from pricelake.llm import language_id, piece_sampling, queries
from pricelake.session import release
from pyspark.sql import functions as F

TABLES = ("documents", "benchmark", "labels", "pages", "conversations")


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_equals_its_sql(spark, duck, sf_dir, name):
    found = queries.QUERIES[name](spark, sf_dir)
    want = duck.execute(queries.ORACLES[name])
    columns = [c[0] for c in want.description]
    assert sorted(found.columns) == sorted(columns)
    assert sorted((tuple(r) for r in found.select(*columns).collect()), key=repr) == sorted(want.fetchall(), key=repr)
    release(spark)


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in queries.ORACLES])
def test_query_returns_every_row(spark, sf_dir, name):
    table, key = ("pages", "page_id") if name.startswith("op10_") else ("documents", "doc_id")
    keys = sorted(r[0] for r in spark.read.parquet(f"{sf_dir}/{table}.parquet").select(key).collect())
    assert sorted(r[key] for r in queries.QUERIES[name](spark, sf_dir).collect()) == keys
    release(spark)


def test_near_duplicate_query_against_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    prints = {k: dedup.brute_fingerprint(t) for k, t in rows}
    root = dedup.brute_components(prints.values())
    least = {}
    for k, p in prints.items():
        least[root[p]] = min(k, least.get(root[p], k))
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op4_near_dedup(spark, sf_dir).collect()}
    assert found == {k: (f"{p:016x}", least[root[p]]) for k, p in prints.items()}


def test_token_files_query_against_the_library(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in queries.op5_token_files(spark, sf_dir).collect()]
    assert sorted(found, key=repr) == texts.brute_files(rows)


def test_periodic_runs_query_against_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = {r.doc_id: tuple(r) for r in queries.op11_periodic_runs(spark, sf_dir).collect()}
    assert found == {k: sequences.brute_found(k, t, True) for k, t in rows}


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    model = language_id.learn(docs.where(language_id.training_rows("doc_id")))
    kept = {k: r.text for k, r in rows.items() if model.predict([r.text])[0][0] != "und"}
    last = {}
    for k, t in kept.items():
        last[t] = max(k, last.get(t, k))
    kept = {k: t for t, k in last.items()}
    prints = {k: dedup.brute_fingerprint(t) for k, t in kept.items()}
    root = dedup.brute_components(prints.values())
    least = {}
    for k, p in prints.items():
        least[root[p]] = min(k, least.get(root[p], k))
    kept = {k: kept[k] for k in least.values()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    kept = {k: kept[k] for k in texts.brute_clean(list(kept.items()), items)}
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert {k: r.text for k, r in found.items()} == kept
    lattices = piece_sampling.Lattices(piece_sampling.Pieces(public_tokenizers.path("piece_bpe_32k.model"), 1.0))
    for k in list(kept)[:50]:
        codes, _ = piece_sampling.sample_block(lattices, [kept[k]], [piece_sampling.row_seed(k, piece_sampling.SEED)])
        assert found[k].pieces == codes.tolist()
    release(spark)


def test_stages_take_odd_rows(spark, tmp_path):
    """NULLs, empty and repeated rows, no rows, and columns named like internal ones."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    odd = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "no key here", "en", None, 3), (3, "a text a text", "en", "s", 4), (3, "a text a text", "en", "s", 4), (4, "x" * 50_000, None, "s", 1)]
    for n, rows in enumerate((odd, [])):
        folder = tmp_path / str(n)
        docs = spark.createDataFrame(rows, schema).select("*", *[F.lit("x").alias(c) for c in ("id", "row", "fp", "digest", "body")])
        docs.write.parquet(str(folder / "documents.parquet"))
        spark.createDataFrame([(1, "a b c d e f"), (2, None)], "item_id bigint, text string").write.parquet(str(folder / "benchmark.parquet"))
        given = spark.read.parquet(str(folder / "documents.parquet"))
        for _, apply in corpus_pipeline.STAGES[:-1]:
            assert apply(spark, given, str(folder)).columns == given.columns
        found = corpus_pipeline.run(spark, str(folder)).collect()
        assert sorted(repr(r.doc_id) for r in found) == (["3", "4", "None"] if rows else [])
