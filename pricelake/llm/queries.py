"""The registered query of each corpus operator, over its whole table, and the SQL it must equal."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm import (
    decontamination,
    exact_dedup,
    language_id,
    language_model,
    licenses,
    line_dedup,
    near_dedup,
    periodic_runs,
    piece_sampling,
    prefix_trie,
    suffix_dedup,
    token_files,
    toxicity,
)
from pricelake.llm.common import id_remainder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document, learned from four fifths of them."""
    scored = language_model.train_and_score(_table(spark, sf_dir, "documents"), language_model.training_rows("doc_id"))
    held_out = id_remainder("doc_id", language_model.FOLDS) == language_model.HELD_OUT
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten sources or more share, as counts and a digest of the remaining text."""
    cleaned = line_dedup.remove_shared_lines(_table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("clean_text").cast("binary"), 256).alias("clean_sha256"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three quarters of them."""
    docs = _table(spark, sf_dir, "documents")
    model = language_id.learn(docs.where(language_id.training_rows("doc_id")))
    held_out = id_remainder("doc_id", language_id.FOLDS) == language_id.HELD_OUT
    found = language_id.predict_languages(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's token ids, from the files they were written to."""
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return token_files.checksums(token_files.token_files_round_trip(_table(spark, sf_dir, "documents"), tokenizer))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from toxic examples and unlabelled text of four fifths of them."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.learn(docs.where(toxicity.training_rows("doc_id")), labels.where(toxicity.training_rows("doc_id")))
    held_out = id_remainder("doc_id", toxicity.FOLDS) == toxicity.HELD_OUT
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of equal texts of every document and which row stays."""
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


def op8_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled pieces of every document, counted and checked, and whether the decoded text is the text itself."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = piece_sampling.encode(docs, model, decoded="decoded")
    return found.select(
        "doc_id",
        F.size("pieces").alias("n_pieces"),
        F.xxhash64("pieces").alias("pieces_xxh64"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("lossless"),
    )


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, one row for each document and item."""
    return decontamination.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every page: its address is the path, its visible text the file."""
    pages = _table(spark, sf_dir, "pages")
    path = F.regexp_replace(F.regexp_replace("url", "[?#].*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    hidden = F.regexp_replace(F.coalesce("html", F.lit("")), r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", "\n")
    visible = F.regexp_replace(hidden, "<[^>]*>", "\n")
    return licenses.scan_licences(pages.select("page_id", path.alias("path"), visible.alias("text")), "page_id")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, after the tails of a tenth of them were made to repeat."""
    docs = _table(spark, sf_dir, "documents")
    found = periodic_runs.find_runs(docs, plant=True, with_text=False)
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the strings of 200 bytes that start anywhere else too, as counts and a digest of the rest."""
    cleaned = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"), with_bytes=False)
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trie of the common beginnings of rebuilt conversations."""
    return prefix_trie.conversation_trie(_table(spark, sf_dir, "conversations"), rebuild=True)


QUERIES = {
    "op1_language_model": op1_language_model,
    "op2_line_dedup": op2_line_dedup,
    "op3_language_id": op3_language_id,
    "op4_near_dedup": op4_near_dedup,
    "op5_token_files": op5_token_files,
    "op6_toxicity": op6_toxicity,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_piece_sampling": op8_piece_sampling,
    "op9_decontamination": op9_decontamination,
    "op10_licenses": op10_licenses,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLES = {
    "op2_line_dedup": """
        WITH split AS (
            SELECT doc_id, coalesce(source, '') AS site, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
        ), lines AS (
            SELECT doc_id, site, unnest(parts) AS line, generate_subscripts(parts, 1) AS position FROM split
        ), shared AS (
            SELECT line FROM lines WHERE trim(line, ' ') <> '' GROUP BY line HAVING count(DISTINCT site) >= 10
        ), marked AS (
            SELECT doc_id, position, line, line IN (SELECT line FROM shared) AS gone FROM lines
        )
        SELECT doc_id, CAST(count(*) AS INTEGER) AS n_lines, CAST(count(*) FILTER (gone) AS INTEGER) AS n_removed,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (NOT gone), '')) AS clean_sha256
        FROM marked GROUP BY doc_id
    """,
    "op7_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
            doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op9_decontamination": """
        WITH item_lines AS (
            SELECT item_id, list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS l
            FROM benchmark WHERE text IS NOT NULL
        ), parts AS (
            SELECT item_id, 'q' AS part, array_to_string(CASE WHEN len(l) > 1 THEN l[:-2] ELSE l END, chr(10)) AS t FROM item_lines
            UNION ALL
            SELECT item_id, 'a', l[-1] FROM item_lines WHERE len(l) > 1
            UNION ALL
            SELECT item_id, 'w', text FROM benchmark
        ), texts AS (
            SELECT item_id AS id, part, t FROM parts UNION ALL SELECT doc_id, 'd', text FROM documents
        ), word_lists AS (
            SELECT id, part, regexp_extract_all(
                translate(coalesce(t, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\\p{L}\\p{N}](?:[^\\x09-\\x0D\\x1c-\\x20\\x{85}\\p{Z}]*[\\p{L}\\p{N}])?') AS w
            FROM texts
        ), shingle_lists AS (
            SELECT id, part, len(w) AS n, list_distinct(
                list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS s,
                array_to_string(w, ' ') AS joined
            FROM word_lists WHERE len(w) > 0
        ), item_shingles AS (
            SELECT id, part, n, unnest(s) AS s FROM shingle_lists WHERE part <> 'd'
        ), totals AS (
            SELECT id AS item_id, coalesce(max(len(s)) FILTER (part = 'q'), 0) AS q, coalesce(max(len(s)) FILTER (part = 'a'), 0) AS a,
                coalesce(max(len(s)) FILTER (part = 'w'), 0) AS w
            FROM shingle_lists WHERE part <> 'd' GROUP BY id
        ), found AS (
            SELECT d.id AS doc_id, i.id AS item_id, i.part, count(*) AS shared
            FROM (SELECT id, unnest(s) AS s FROM shingle_lists WHERE part = 'd') d JOIN item_shingles i ON d.s = i.s AND i.n >= 5
            GROUP BY ALL
            UNION ALL
            SELECT d.id, i.id, i.part, 1
            FROM shingle_lists d JOIN item_shingles i ON d.part = 'd' AND i.n < 5 AND contains(' ' || d.joined || ' ', ' ' || i.s || ' ')
            UNION ALL
            SELECT d.id, i.id, 'v', 1
            FROM shingle_lists d JOIN shingle_lists i ON d.part = 'd' AND i.part = 'w' AND i.n >= 5 AND contains(d.joined, i.joined)
        ), shared AS (
            SELECT doc_id, item_id, coalesce(max(shared) FILTER (part = 'q'), 0) AS q, coalesce(max(shared) FILTER (part = 'a'), 0) AS a,
                coalesce(max(shared) FILTER (part = 'w'), 0) AS w, count(*) FILTER (part = 'v') > 0 AS verbatim
            FROM found GROUP BY doc_id, item_id
        )
        SELECT doc_id, item_id, CAST(s.q AS INTEGER) AS question_shared, CAST(t.q AS INTEGER) AS question_total,
            CAST(s.a AS INTEGER) AS answer_shared, CAST(t.a AS INTEGER) AS answer_total,
            CAST(s.w AS INTEGER) AS whole_shared, CAST(t.w AS INTEGER) AS whole_total, verbatim
        FROM shared s JOIN totals t USING (item_id)
        WHERE (s.q >= 0.8 * t.q AND s.a >= 0.8 * t.a) OR s.w >= 0.8 * t.w OR verbatim
    """,
    "op12_suffix_dedup": """
        WITH texts AS (
            SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents
        ), hexed AS (
            SELECT r, doc_id, octet_length(b) AS n, b, hex(b) AS x FROM texts
        ), strings AS (
            SELECT r, unnest(range(n - 199)) AS i, b FROM hexed WHERE n >= 200
        ), digests AS (
            SELECT r, i, md5(b[i + 1:i + 200]) AS s FROM strings
        ), repeated AS (
            SELECT r, i FROM digests JOIN (SELECT s FROM digests GROUP BY s HAVING count(*) > 1) USING (s)
        ), marked AS (
            SELECT r, i, CASE WHEN i > lag(i) OVER (PARTITION BY r ORDER BY i) + 200 THEN 1 ELSE 0 END AS new FROM repeated
        ), numbered AS (
            SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS span FROM marked
        ), spans AS (
            SELECT r, span, min(i) AS a, max(i) + 200 AS z FROM numbered GROUP BY r, span
        ), kept AS (
            SELECT r, z AS a, lead(a) OVER (PARTITION BY r ORDER BY a) AS z FROM spans
            UNION ALL SELECT r, 0, min(a) FROM spans GROUP BY r
        ), cut AS (
            SELECT r, string_agg(substr(x, 2 * a + 1, 2 * (coalesce(z, n) - a)), '' ORDER BY a) AS x
            FROM kept JOIN hexed USING (r) GROUP BY r
        ), removed AS (
            SELECT r, sum(z - a) AS gone, count(*) AS spans FROM spans GROUP BY r
        )
        SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed,
            CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(cut.x, hexed.x))) AS kept_sha256
        FROM hexed LEFT JOIN removed USING (r) LEFT JOIN cut USING (r)
    """,
    "op13_prefix_trie": """
        WITH ordered AS (
            SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                    md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS p
            FROM conversations WHERE conv_id IS NOT NULL
        ), plan AS (
            SELECT c, n, c - c % 5 AS base, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
                string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT)), lambda crc, byte: list_reduce(
                    list_prepend(xor(crc, byte), range(8)),
                    lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::BIGINT) ELSE v // 2 END)), 4294967295::BIGINT) % 9 AS h
            FROM (SELECT c, count(*) AS n FROM ordered GROUP BY c)
        ), rebuilt AS (
            SELECT plan.c, p, role, text FROM plan JOIN ordered o ON o.c = base AND p < h
            UNION ALL
            SELECT plan.c, p - h + least(h, coalesce(b.n, 0)), role, text
            FROM plan JOIN ordered o ON o.c = plan.c AND p >= h LEFT JOIN (SELECT c AS base, n FROM plan) b USING (base)
        ), chained AS (
            SELECT c, p + 1 AS depth, text, string_agg(md5(length(role) || ':' || role || text), ',') OVER (PARTITION BY c ORDER BY p) AS path
            FROM rebuilt
        ), members AS (
            SELECT c, depth, path, regexp_replace(path, ',?[0-9a-f]{32}$', '') AS above, strlen(text) AS size FROM chained
            UNION ALL SELECT c, 0, '', NULL, 0 FROM plan
        ), lasts AS (
            SELECT c, max(depth) AS turns FROM members GROUP BY c
        ), nodes AS (
            SELECT depth, path, any_value(above) AS above, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS saved,
                sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (depth = turns), '')) AS ends_sha256
            FROM members JOIN lasts USING (c) GROUP BY depth, path
        ), children AS (
            SELECT depth - 1 AS depth, above AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
        ), below AS (
            SELECT m.depth, m.path, count(*) FILTER (x.n_children IS NULL) AS n_leaves, sum(x.saved) AS saved_tokens
            FROM members m JOIN (SELECT * FROM nodes LEFT JOIN children USING (depth, path)) x ON x.conv_id = m.c AND x.depth >= m.depth
            GROUP BY m.depth, m.path
        )
        SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
            CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
        FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.above
        LEFT JOIN children k ON k.depth = n.depth AND k.path = n.path JOIN below b ON b.depth = n.depth AND b.path = n.path
    """,
}
