from __future__ import annotations

import datetime
import time
from pathlib import Path

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake import session, workload
from pricelake.fixed import RISE
from pricelake.operators import documents, jdbc, lookup, quality, ranking, registry, sinks
from pricelake.operators.snapshot import month_partitions, stamp_snapshot
from pricelake.plans import build, gold, loads, silver
from pricelake.plans.silver import product_codes
from pricelake.schemas import API10, PRODUCTS, SEASONS, SILVER
from pricelake.session import shared_dir
from pricelake.sources import landing, tables
from pricelake.workload import feeds


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def skewed(spark):
    """One group with most rows, copies of one row, NULL groups and NULL values."""
    return spark.range(3000).select(
        F.when(F.col("id") % 10 == 0, None).when(F.col("id") < 2000, "hot").otherwise(F.lit("cold")).alias("g"),
        F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 5).alias("v"),
        F.when(F.col("id") < 1000, 1).otherwise(F.col("id")).alias("t"),
    )


@pytest.mark.parametrize("run", [1, 7, 100_000])
def test_number_within_equals_row_number(spark, monkeypatch, run):
    monkeypatch.setattr(ranking, "RUN", run)
    df = skewed(spark)
    order = [F.col("v").desc_nulls_last(), F.col("t").asc_nulls_last()]
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy(*order)).cast("bigint"))
    assert rows(ranking.number_within(df, ["g"], order, "n"), "g", "v", "t", "n") == rows(want, "g", "v", "t", "n")


def test_rank_by_equals_rank(spark):
    df = skewed(spark)
    want = df.withColumn("r", F.rank().over(Window.orderBy(F.col("v").desc_nulls_last())).cast("bigint"))
    assert rows(ranking.rank_by(df, "v", "r"), "g", "v", "t", "r") == rows(want, "g", "v", "t", "r")


def test_newest_with_only_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "i int, dt string")
    assert ranking.newest(df, "dt").count() == 2
    assert ranking.newest(spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "i int, dt string"), "dt").count() == 1


def test_newest_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).withColumn("dt", (F.col("id") % 3).cast("string")).write.partitionBy("dt").parquet(path)
    found = ranking.newest(spark.read.schema("id bigint, dt string").parquet(path), "dt")
    assert found.count() == 3
    scans = [s for s in found._jdf.queryExecution().executedPlan().toString().split("\n") if "PartitionFilters" in s]
    assert any("Subquery" in s.split("PartitionFilters: [")[1].split("]")[0] for s in scans)


def test_top_per_group_trims_before_the_shuffle(spark):
    top = ranking.top_per_group(skewed(spark), ["g"], [F.col("v").desc_nulls_last(), F.col("t")], 3, "n")
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert top.groupBy("g").count().where("count > 3").count() == 0


@pytest.mark.parametrize("stored", [True, False])
def test_lookup_join(spark, stored):
    fact = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    dim = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "k int, d string")
    got = rows(lookup.lookup_join(fact, dim, ["k"], stored=stored), "k", "v", "d")
    assert got == sorted(
        [(1, "a", "x"), (1, "a", "y"), (1, "b", "x"), (1, "b", "y"), (2, "c", None), (None, "d", None)], key=repr
    )
    assert rows(lookup.duplicate_keys(dim.where("k IS NOT NULL"), ["k"]), "k", "count") == [(1, 2)]


def test_broadcast_is_measured(spark):
    dim = spark.range(100)
    assert lookup.fits_broadcast(dim, max_rows=100)
    assert not lookup.fits_broadcast(dim, max_rows=99)
    assert not lookup.fits_broadcast(dim, max_bytes=500)
    texts = dim.select(F.repeat(F.lit("x"), 10).alias("t"))
    assert lookup.fits_broadcast(texts, max_bytes=1000)
    assert not lookup.fits_broadcast(texts, max_bytes=999)


def test_no_temporary_folder_on_a_cluster():
    class Session:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session)
    Session.sparkContext.master = "local[2]"
    assert shared_dir(Session) == shared_dir(Session)


def test_stamp_uses_first_row(spark):
    df = spark.createDataFrame(
        [("b", "p1", 0, "2025-12-02"), ("b", "p0", 1, "2025-11-30"), ("b", "p0", 0, "2025-12-01"), ("c", "p", 0, "2024-01-05")],
        "batch string, file_path string, pos int, res_dt string",
    ).withColumn("res_dt", F.col("res_dt").cast("date"))
    stamped = stamp_snapshot(df)
    assert rows(stamped.groupBy("batch", "year", "month", "dt").count(), "batch", "year", "month", "dt", "count") == [
        ("b", "2025", "12", "20251201", 3),
        ("c", "2024", "01", "20240105", 1),
    ]


def test_merge_by_date_is_idempotent_and_first_of_month_lands_in_its_month(spark, tmp_path):
    path = str(tmp_path / "m")
    make = lambda data: month_partitions(
        spark.createDataFrame(data, "res_dt string, v int").withColumn("res_dt", F.col("res_dt").cast("date"))
    )
    schema = make([]).schema
    first = make([("2025-11-30", 1), ("2025-12-01", 2), ("2025-12-02", 3)])
    sinks.merge_by_date(tables.read_parquet(spark, path, schema), first, path)
    again = make([("2025-12-01", 20), ("2025-12-01", 21)])
    for _ in range(2):
        sinks.merge_by_date(tables.read_parquet(spark, path, schema), again, path)
    sinks.merge_by_date(tables.read_parquet(spark, path, schema), make([]), path)
    stored = tables.read_parquet(spark, path, schema).withColumn("day", F.col("res_dt").cast("string"))
    assert rows(stored, "day", "v", "month") == [
        ("2025-11-30", 1, "11"),
        ("2025-12-01", 20, "12"),
        ("2025-12-01", 21, "12"),
        ("2025-12-02", 3, "12"),
    ]


def test_missing_parquet_is_empty(spark, tmp_path):
    assert tables.read_parquet(spark, str(tmp_path / "none"), API10).count() == 0


def test_landing_keys_order_and_rerun(spark, tmp_path):
    root = str(tmp_path / "raw")
    docs = spark.createDataFrame([("{}", "04", "2025-12-11", "01")], "value string, product_rank string, dt string, product_cls string")
    for _ in range(2):
        assert sinks.land_documents(docs, root, normalize_dt=True) == ["dt", "product_cls", "product_rank"]
    assert (tmp_path / "raw" / "dt=20251211" / "product_cls=01" / "product_rank=04").is_dir()
    assert spark.read.text(root).count() == 1
    existing = docs.withColumn("dt", F.lit("20251211"))
    status = sinks.landing_status(docs.unionByName(existing).unionByName(existing), existing, ["dt"])
    assert rows(status, "status", "objects") == [("new", 1), ("overwrite", 1)]


def test_segments(spark):
    codes = ["100", "600", "500", "800", "700", None]
    df = spark.createDataFrame([(c,) for c in codes], "c string").select(sinks.segment_of(F.col("c")).alias("s"))
    assert [r.s for r in df.collect()] == ["main", "main", "livestock", "grocery", None, None]


def test_quality_checks(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, None), (None, 2, 3)], "k string, n int, m int")
    report = quality.all_checks(
        [
            quality.not_null(df, "t", ["k", "n"]),
            quality.accepted_values(df, "t", "k", ["b"]),
            quality.unique_key(df, "t", ["k", "n"]),
            quality.same_month(df, "t", "n", "m"),
            quality.not_empty(df, "t"),
            quality.not_empty(df.where("false"), "t"),
            quality.numeric_text(df, "t", "k"),
        ]
    )
    found = rows(report, "check_name", "column_name", "failing_rows", "passed")
    assert found == [
        ("accepted_values", "k", 2, False),
        ("not_empty", "", 0, True),
        ("not_empty", "", 1, False),
        ("not_null", "k", 1, False),
        ("not_null", "n", 0, True),
        ("numeric", "k", 2, False),
        ("same_month", "n,m", 1, False),
        ("unique", "k,n", 1, False),
    ]
    counts = quality.dropped_rows(df, "m").first()
    assert (counts.rows_before, counts.rows_after, counts.rows_dropped) == (3, 2, 1)


def test_jdbc_column_types():
    schema = T.StructType(
        [
            T.StructField("a", T.LongType()),
            T.StructField("b", T.DoubleType()),
            T.StructField("c", T.StringType()),
            T.StructField("d", T.DateType()),
            T.StructField("e", T.BooleanType()),
            T.StructField("f", T.ShortType()),
        ]
    )
    assert jdbc.column_types(schema) == "`a` BIGINT, `b` DOUBLE PRECISION, `c` TEXT, `d` DATE, `e` BOOLEAN, `f` SMALLINT"
    with pytest.raises(TypeError):
        jdbc.column_type(T.ArrayType(T.LongType()))


def empty_silver(spark, table):
    columns, partitions = SILVER[table]
    return spark.createDataFrame([], T.StructType([*columns.fields, *[T.StructField(p, T.StringType()) for p in partitions]]))


def test_landed_documents_to_checked_marts(spark, tmp_path):
    """Product documents through load, registration, the gold build and its checks."""
    record = (
        '{"product_cls_code":"01","category_code":"%s","productno":"%d","lastest_day":"2025-12-11","productName":"쌀/일반",'
        '"dpr1":"1,000","dpr2":"900","dpr3":[],"dpr4":"-","day1":"12/11","direction":"%s","value":"%s","county_code":"1101",'
        '"county_name":"서울","unit":"kg"}'
    )
    items = [record % ("100", n, "1", n) for n in range(1, 6)] + [record % ("500", 9, "0", "2.5"), record % ("700", 8, "0", "1")]
    docs = spark.createDataFrame(
        [('{"error_code":"000","price":[%s]}' % ",".join(items), "20251211", "01", "1101", "p")],
        "value string, dt string, product_cls string, country string, file_path string",
    )
    meta = spark.createDataFrame([(1, "01", "소매", "kg", "100", "식량작물", "111", "쌀", "01", "일반", "04", "상품")], PRODUCTS)
    root = str(tmp_path / "api10")
    for _ in range(2):
        loads.load_products(docs, product_codes(meta), root)
    registry.create_databases(spark, str(tmp_path / "db"), ("silver",))
    registry.register_silver(spark, "api10", f"{root}/segment=main")
    for table in ("api1", "api13", "api17"):
        sinks.write_parquet(empty_silver(spark, table), str(tmp_path / table), SILVER[table][1])
        registry.register_silver(spark, table, str(tmp_path / table))
    season = spark.createDataFrame([("겨울", 12, "쌀", "일반", 1.0, "식량작물")], SEASONS)
    report = build.build_gold(spark, str(tmp_path / "gold"), tables.coordinates(spark), season)
    failed = [r for r in report.collect() if not r.passed]
    # Only livestock fell, and livestock is not in the main segment.
    assert [(r.table_name, r.check_name) for r in failed] == [("mart_price_drop_top3", "not_empty")]
    top = spark.read.parquet(str(tmp_path / "gold" / "mart_price_rise_top3"))
    assert rows(top, "prev_1d_dir_pct", "ranking", "base_pr") == [(3.0, 3, 1000.0), (4.0, 2, 1000.0), (5.0, 1, 1000.0)]
    assert spark.read.parquet(str(tmp_path / "gold" / "mart_season_region_product")).first().latitude == 37.5666103
    counted = registry.inventory(spark, ["silver"]).where("table_name = 'api10'").first()
    assert (counted.column_count, counted.row_count) == (30, 5)


def test_top3_breaks_ties_the_same_way(spark, sf_dir):
    from pricelake.workload.gold import snapshot

    shuffled = snapshot(spark, sf_dir).repartition(5, F.rand(1))
    assert rows(gold.price_change_top3(shuffled, RISE), "*") == rows(gold.price_change_top3(snapshot(spark, sf_dir), RISE), "*")


# Loads that must not lose rows.


def test_merge_keeps_undated_rows_and_stored_columns(spark, tmp_path):
    path = str(tmp_path / "months")
    first = spark.sql("SELECT * FROM VALUES (1, DATE'2025-01-05', '2025', '01', 'x'), (2, NULL, NULL, NULL, 'y') t(k, res_dt, year, month, extra)")
    sinks.write_parquet(first, path, ("year", "month"))
    second = spark.sql("SELECT * FROM VALUES (3, DATE'2025-01-06', '2025', '01'), (4, CAST(NULL AS DATE), NULL, NULL) t(k, res_dt, year, month)")
    for _ in range(2):
        sinks.merge_by_date(tables.read_stored(spark, path, second.schema, ("year", "month")), second, path)
        stored = tables.read_stored(spark, path, second.schema, ("year", "month"))
        assert rows(stored, "k", "extra", "month") == sorted([(1, "x", "01"), (2, "y", None), (3, None, "01"), (4, None, None)], key=repr)
    assert tables.read_stored(spark, str(tmp_path / "none"), second.schema).schema == second.schema


def test_batch_date_is_that_of_the_first_dated_row(spark):
    df = spark.sql(
        "SELECT * FROM VALUES ('a', 'f1', 0, NULL), ('a', 'f1', 1, DATE'2025-03-02'), ('a', 'f2', 0, DATE'2025-03-01'), ('b', 'f1', 0, NULL) "
        "t(batch, file_path, pos, res_dt)"
    )
    assert rows(stamp_snapshot(df), "batch", "pos", "dt") == sorted([("a", 0, "20250302"), ("a", 1, "20250302"), ("a", 0, "20250302"), ("b", 0, None)], key=repr)


def test_documents_take_one_line(spark, tmp_path):
    root = str(tmp_path / "zone")
    docs = spark.createDataFrame([('{"a":\n1,\r\n"b":2}', "2025"), ('{"a":3}', None)], "value string, dt string")
    keys = sinks.land_documents(docs, root)
    read = landing.read_documents(spark, root, keys)
    assert [tuple(r) for r in read.selectExpr("from_json(value, 'a int, b int') f", "dt").select("f.*", "dt").collect()] == [(1, 2, "2025")]
    assert sinks.without_place(docs).count() == 1


def test_newest_date_opens_no_old_file(spark, tmp_path):
    root = str(tmp_path / "zone")
    docs = spark.createDataFrame([("{}", "2024", "01"), ("{}", "2025", "01"), ("{}", "2025", "02")], "value string, dt string, product_cls string")
    keys = sinks.land_documents(docs, root)
    for old in (tmp_path / "zone" / "dt=2024").rglob("part-*"):
        old.write_bytes(b"no longer readable")
        old.chmod(0)
    assert landing.folder_values(spark, root, "dt") == ["2024", "2025"]
    latest = landing.read_latest(spark, root, keys, "01")
    assert [(r.dt, r.product_cls) for r in latest.collect()] == [("2025", "01")]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "isnotnull(dt" in plan
    assert landing.read_latest(spark, str(tmp_path / "nothing"), keys).count() == 0


def test_newest_partition_comes_from_names(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS names_only")
    spark.sql(f"CREATE TABLE names_only.t (a INT, dt STRING) USING parquet PARTITIONED BY (dt) LOCATION '{tmp_path / 't'}'")
    assert tables.newest_partition(spark, "names_only.t") is None
    spark.sql("INSERT INTO names_only.t VALUES (1, '20240101'), (2, '20250101'), (3, NULL)")
    assert tables.newest_partition(spark, "names_only.t") == "20250101"
    spark.sql("DROP DATABASE names_only CASCADE")


def test_work_folders_are_removed(spark):
    ranked = ranking.number_within(spark.range(10).selectExpr("id % 2 AS g", "id AS v"), ["g"], [F.col("v")], "n")
    assert ranked.count() == 10
    assert session._handed_out
    session.release(spark)
    assert not session._handed_out


def test_outcomes_follow_the_explodes(spark):
    values = ['{"data":{"item":[{"item_name":"a"}, null]}}', '{"data":{"item":[{"item_name":"a"}]}}', '{"data":{"item":{"item_name":"a"}}}', '{"data":["001"]}', "{bad", "", '{"data":{"item":[]}}']
    docs = spark.createDataFrame([(str(n), v) for n, v in enumerate(values)], "file_path string, value string")
    outcome = {r.file_path: r.outcome for r in documents.with_outcome(docs, "category").collect()}
    assert list(outcome.values()) == ["bad_record", "rows", "rows", "empty", "unreadable", "unreadable", "empty"]
    given = {r.file_path for r in documents.explode_items(docs).collect()}
    assert given == {k for k, v in outcome.items() if v == "rows"}
    assert rows(documents.rejected(docs, "category"), "file_path", "reason") == [("0", "bad_record"), ("4", "unreadable"), ("5", "unreadable")]


# Months swapped in the catalog.

MONTHS = "id bigint, res_dt date, year string, month string"


def _months(spark, rows):
    return spark.createDataFrame([(n, None if d is None else datetime.date.fromisoformat(d), d and d[:4], d and d[5:7]) for n, d in rows], MONTHS)


@pytest.fixture
def prices(spark, tmp_path):
    """A registered table with three months, one of them that of rows without a date."""
    path = str(tmp_path / "prices")
    sinks.write_parquet(_months(spark, [(1, "2025-01-01"), (2, "2025-01-02"), (3, "2025-02-01"), (4, None), (4, None)]), path, ("year", "month"))
    spark.sql("DROP DATABASE IF EXISTS swap_test CASCADE")
    registry.create_databases(spark, str(tmp_path / "databases"), ("swap_test",))
    spark.sql(f"CREATE TABLE swap_test.prices ({MONTHS}) USING parquet PARTITIONED BY (year, month) LOCATION '{path}'")
    registry.sync_partitions(spark, ["swap_test.prices"])
    return path


def _stored(spark):
    return sorted(((r.id, r.res_dt and str(r.res_dt)) for r in spark.table("swap_test.prices").collect()), key=repr)


def test_broken_swap_leaves_the_old_months(spark, prices):
    before = _stored(spark)
    incoming = _months(spark, [(20, "2025-01-02"), (30, "2025-03-01")])
    registry.write_version(spark, "swap_test.prices", incoming)
    assert _stored(spark) == before
    registry.swap_months(spark, "swap_test.prices", incoming)
    want = sorted([(1, "2025-01-01"), (20, "2025-01-02"), (3, "2025-02-01"), (4, None), (4, None), (30, "2025-03-01")], key=repr)
    assert _stored(spark) == want
    assert len(registry.drop_old_versions(spark, "swap_test.prices")) == 1
    assert _stored(spark) == want and registry.drop_old_versions(spark, "swap_test.prices") == []
    registry.swap_months(spark, "swap_test.prices", _months(spark, []))
    assert _stored(spark) == want


def test_swap_opens_no_month_it_does_not_touch(spark, prices):
    """An unreadable file in another month does not matter, new columns included. Stored rows have NULL there, so an undated
    row with a value is another row."""
    for file in Path(prices, "year=2025", "month=02").glob("*.parquet"):
        file.write_bytes(b"no parquet")
    incoming = _months(spark, [(10, "2025-01-01"), (4, None)]).withColumn("revised", F.lit(True))
    registry.swap_months(spark, "swap_test.prices", incoming)
    rows = spark.table("swap_test.prices").where("month IS NULL OR month = '01'")
    assert sorted(((r.id, r.revised) for r in rows.collect()), key=repr) == [(10, True), (2, None), (4, None), (4, None), (4, True)]
    plan = spark.table("swap_test.prices").where("year = '2025' AND month = '01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_partitions_are_added_by_name(spark, prices):
    """Folders a load did not write are not looked for."""
    for month in range(4, 12):
        _months(spark, [(month, f"2025-{month:02}-01")]).drop("year", "month").write.parquet(f"{prices}/year=2025/month={month:02}")
    registry.add_partitions(spark, "swap_test.prices", _months(spark, [(5, "2025-05-01")]), ("year", "month"))
    named = {r.partition for r in spark.sql("SHOW PARTITIONS swap_test.prices").collect()}
    assert "year=2025/month=05" in named and "year=2025/month=04" not in named
    assert (5, "2025-05-01") in _stored(spark)


def test_undated_rows_are_counted(spark):
    stored, incoming = _months(spark, [(1, None), (1, None), (2, None)]), _months(spark, [(1, None), (2, None), (2, None), (3, None)])
    merged = sinks.merged_by_date(stored, incoming)
    assert sorted(r.id for r in merged.collect()) == [1, 1, 2, 2, 3]


# Loads.

ITEM = '{"item_name":"a","item_code":"1","kind_name":"k","kind_code":"01","rank":"r","rank_code":"04","unit":"kg","day1":"d","dpr1":"%s"}'


def _category(spark, rows):
    names = "file_path string, value string, dt string, product_cls string, country string, category string"
    return spark.createDataFrame([(f"f{n}", v, d, "01", "1101", "100") for n, (v, d) in enumerate(rows)], names)


def test_category_load_says_what_became_of_everything(spark, tmp_path):
    good = '{"data":{"error_code":"000","item":[%s,%s]}}' % (ITEM % "1,000", ITEM % "-")
    holed = '{"data":{"error_code":"000","item":[%s,null]}}' % (ITEM % "5")
    path, outcomes = str(tmp_path / "api1"), str(tmp_path / "outcomes")
    docs = _category(spark, [(good, "2025-01-02"), (good, "20250103"), (holed, "2025-01-02"), ("{", "2025-01-02"), ('{"data":["001"]}', "2025-01-02"), (good, "soon")])
    report = loads.load_category(docs, path, outcomes)
    assert report.documents == {"rows": 3, "empty": 1, "unreadable": 1, "bad_record": 1} and report.rejected == 2
    assert report.rows == {"kept": 2, "no_price": 2, "undated": 2}
    stored = spark.read.parquet(outcomes)
    assert {(r.dt, r.file_path, r.reason) for r in loads.rejects(stored).collect()} == {("2025-01-02", "f2", "bad_record"), ("2025-01-02", "f3", "unreadable")}
    # A run of one landing date replaces its outcomes and rows, and nothing else.
    assert loads.load_category(_category(spark, [(good, "2025-01-02")]), path, outcomes).rows == {"kept": 1, "no_price": 1}
    assert loads.rejects(spark.read.parquet(outcomes)).count() == 0
    assert sorted(str(r.res_dt) for r in tables.read_silver(spark, path, "api1").collect()) == ["2025-01-02", "2025-01-03"]
    empty = loads.load_category(docs.limit(0), path, outcomes)
    assert (empty.documents, empty.rows) == ({}, {})
    assert tables.read_silver(spark, path, "api1").count() == 2


def test_documents_without_a_place_are_kept_by_run(spark, tmp_path):
    docs = _category(spark, [("a", "2025-01-01"), ("b", None)])
    for run in ("one", "two", "two"):
        sinks.land_documents(docs, str(tmp_path / "zone"), unplaced=str(tmp_path / "unplaced"), run=run)
    assert sorted((r.value, r.run) for r in spark.read.parquet(str(tmp_path / "unplaced")).collect()) == [("b", "one"), ("b", "two")]


def test_files_of_their_own_are_written_by_many_tasks(spark, tmp_path):
    docs = spark.range(600).select(F.col("id").cast("string").alias("value"), F.lit("20250101").alias("dt"))
    sinks.land_documents(docs, str(tmp_path / "zone"), one_per_file=True)
    files = [p.name for p in (tmp_path / "zone").rglob("part-*")]
    assert len(files) == 600 and len({name.split("-")[1] for name in files}) == 3
    assert {int(r.value) for r in spark.read.text(str(tmp_path / "zone")).collect()} == set(range(600))


def test_document_queries_split_wide_methods_in_any_session(spark, sf_dir):
    limit, other = "spark.sql.codegen.hugeMethodLimit", spark.newSession()
    for given, expected in (("65535", "8000"), ("4000", "4000")):
        other.conf.set(limit, given)
        feeds.product_docs(other, sf_dir)
        assert other.conf.get(limit) == expected


def test_loads_leave_no_typed_rows_behind(spark, sf_dir, tmp_path):
    docs = feeds.region_docs(spark, sf_dir).limit(50)
    loads.load_regions(spark, docs, feeds.products(spark, sf_dir), str(tmp_path / "api17"))
    assert not [path for path in session._handed_out if "/region-typed-" in path]
    assert not list(Path(shared_dir(spark)).glob("pricelake/region-typed-*"))


def test_landed_lines_are_compressed_on_request(spark, tmp_path):
    docs = spark.range(5).select(F.col("id").cast("string").alias("value"), F.lit("20250101").alias("dt"))
    keys = sinks.land_documents(docs, str(tmp_path), compression="gzip")
    assert all(p.name.endswith(".gz") for p in tmp_path.rglob("part-*"))
    assert sorted(r.value for r in landing.read_documents(spark, str(tmp_path), keys).collect()) == list("01234")


def test_lookup_join_of_a_large_dimension_spreads_rows_without_key(spark, monkeypatch):
    monkeypatch.setattr(lookup, "measured", lambda dim: (lookup.BROADCAST_LIMIT_ROWS + 1, 1))
    fact = spark.range(200).selectExpr("IF(id < 100, NULL, id % 7) AS k", "id AS v")
    dim = spark.createDataFrame([(3, "three"), (3, "again"), (None, "none")], "k bigint, d string")
    joined = lookup.lookup_join(fact, dim, ["k"])
    got = sorted((r.v, r.d or "") for r in joined.collect())
    want = [(v, "") for v in range(200) if v < 100 or v % 7 != 3] + [(v, d) for v in range(100, 200) if v % 7 == 3 for d in ("again", "three")]
    assert got == sorted(want) and joined.columns == ["k", "v", "d"]
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and plan.count("_spread") and "SortMergeJoin" not in plan
    assert lookup.spread_nulls(fact, ["k"]).where("k IS NULL").select("_spread").distinct().count() == 100


def test_product_silver_parses_its_documents_once(spark):
    docs = spark.createDataFrame([("f", "{}", "20240101")], "file_path string, value string, dt string")
    codes = spark.createDataFrame([(1, "1", "1", "1", "a")], "product_no bigint, item_cd string, kind_cd string, rank_cd string, rank_nm string")
    plan = silver.product_silver(docs, codes)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate posexplode") == 1


def test_undated_rows_are_dealt_out_before_they_are_counted(spark):
    stored = spark.createDataFrame([(i // 2, None, None, None) for i in range(40)], "v bigint, res_dt date, year string, month string")
    again = spark.createDataFrame([(3, None, None, None)] * 3 + [(4, None, None, None)], stored.schema)
    merged = sinks.merged_by_date(stored, again)
    assert sorted(r.v for r in merged.collect()) == sorted([i // 2 for i in range(40)] + [3])
    plan = merged._jdf.queryExecution().executedPlan().toString().split("\n")
    counted = next(i for i, line in enumerate(plan) if "HashAggregate" in line and "count" in line and "res_dt" in line)
    assert not any("Exchange" in line for line in plan[counted + 1 : counted + 2]) and any("REPARTITION_BY_COL" in line for line in plan)


def test_typed_rows_are_not_parted_by_fate(spark):
    rows = spark.createDataFrame([(0, "rows", "kept"), (1, "rows", "no_price")], "pos int, outcome string, fate string")
    found, report, _ = loads._settled(rows, "typed")
    assert not [f for f in found.inputFiles() if "fate=" in f]
    assert report.rows == {"kept": 1, "no_price": 1} and report.documents == {"rows": 1}


def test_documents_without_line_breaks_pass_no_pattern(spark):
    df = spark.createDataFrame([("a b",), ("a\r\nb",), ("a\rb",), (None,)], "value string").select(sinks.one_line(F.col("value")).alias("v"))
    assert [r.v for r in df.collect()] == ["a b", "a b", "a b", None]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.find("Contains(") < plan.find("regexp_replace")


def test_category_load_without_outcomes_stores_no_typed_rows(spark, tmp_path, monkeypatch):
    """Both ways of a load write the same rows and say the same; a day written two ways is one file."""
    good = '{"data":{"error_code":"000","item":[%s,%s]}}' % (ITEM % "1,000", ITEM % "-")
    docs = _category(spark, [(good, "2025-01-02"), (good, "20250102"), ("{", "2025-01-02"), (good, "soon"), (good, None)])
    staged = loads.load_category(docs, str(tmp_path / "staged"), str(tmp_path / "outcomes"))
    monkeypatch.setattr(loads, "_settled", None)
    assert loads.load_category(docs, str(tmp_path / "api1")) == staged
    stored = [rows(tables.read_silver(spark, str(tmp_path / n), "api1"), "item_nm", "base_pr", "res_dt", "dt") for n in ("staged", "api1")]
    assert stored[0] == stored[1] and len(stored[0]) == 2
    assert len(list((tmp_path / "api1").rglob("part-*"))) == 1
    empty = loads.load_category(docs.limit(0), str(tmp_path / "api1"))
    assert (empty.documents, empty.rows) == ({}, {})


def test_partitions_are_added_many_a_statement(spark, prices, monkeypatch):
    asked, ask = [], type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *more, **named: (asked.append(text), ask(self, text, *more, **named))[1])
    monkeypatch.setattr(registry, "PARTITIONS_A_STATEMENT", 4)
    added = registry.add_partitions(spark, "swap_test.prices", _months(spark, [(m, f"2025-{m:02}-01") for m in range(4, 13)]), ("year", "month"))
    assert len(added) == 9 and len([text for text in asked if text.startswith("ALTER")]) == 3
    assert {f"year=2025/month={m:02}" for m in range(4, 13)} <= {r.partition for r in ask(spark, "SHOW PARTITIONS swap_test.prices").collect()}


def test_merge_into_nothing_stored_stages_nothing(spark, sf_dir, tmp_path, monkeypatch):
    names = []
    for module in (sinks, loads):
        stage = module.staged
        monkeypatch.setattr(module, "staged", lambda df, name, stage=stage: (names.append(name), stage(df, name))[1])
    incoming = _months(spark, [(1, "2025-01-01"), (1, "2025-01-01"), (2, None)]).withColumn("revised", F.lit(True))
    stored = tables.read_stored(spark, str(tmp_path / "months"), T.StructType([*incoming.schema.fields, T.StructField("price", T.DoubleType())]), ("year", "month"))
    sinks.merge_by_date(stored, incoming, str(tmp_path / "months"))
    assert names == [] and rows(spark.read.parquet(str(tmp_path / "months")), "id", "revised", "price") == [(1, True, None)] * 2 + [(2, True, None)]
    docs, products, path = feeds.region_docs(spark, sf_dir).limit(50), feeds.products(spark, sf_dir), str(tmp_path / "api17")
    first = loads.load_regions(spark, docs, products, path)
    assert names == [] and (once := tables.read_stored(spark, path, incoming.schema, ("year", "month")).count()) == first.rows["kept"]
    assert loads.load_regions(spark, docs, products, path) == first and names == ["region-rows", "merged-months"]
    assert tables.read_stored(spark, path, incoming.schema, ("year", "month")).count() == once


def _shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {str(f) for folder in folders for f in Path(folder.getPath()).rglob("shuffle_*")}


def test_writes_leave_no_shuffle_files(spark, tmp_path):
    """Though the frame that was written is still there."""
    docs, before = _category(spark, [(str(n), f"2025-01-{n:02}") for n in range(1, 29)]), _shuffle_files(spark)
    sinks.land_documents(docs, str(tmp_path / "zone"))
    sinks.write_parquet(docs, str(tmp_path / "table"), ("dt",))
    again = tables.staged(docs.repartition("dt"), "again")
    for _ in range(50):
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left and again.count() == 28
    assert spark.conf.get(session.SHUFFLE_CLEANUP, None) != "true"


class _Landed(Exception):
    pass


@pytest.mark.parametrize("query", ["api10_load", "load_rejects", "dated_scan", "json_landing_scan", "latest_date_scan", "backfill_landing"])
def test_zones_of_all_documents_are_compressed(spark, sf_dir, monkeypatch, query):
    def land(*given, compression="none", **more):
        raise _Landed(compression)

    monkeypatch.setattr(sinks, "land_documents", land)
    with pytest.raises(_Landed, match="gzip"):
        workload.queries()[query](spark, sf_dir)


def test_files_of_their_own_are_landed_alone_and_listed_by_date(spark, tmp_path):
    """No checksum file beside each, a rerun replaces its date only, and a date's documents are read without listing the others."""
    zone, days = str(tmp_path / "zone"), F.when(F.col("id") % 2 == 0, "2025:01").otherwise(F.lit("20250102"))
    docs = spark.range(600).select(F.col("id").cast("string").alias("value"), days.alias("dt"), F.lit("01").alias("product_cls"))
    for rerun in (docs, docs.where("dt = '20250102' AND value < 100")):
        keys = sinks.land_documents(rerun, zone, one_per_file=True)
    assert not list(Path(zone).rglob(".part-*.crc"))
    of_day = landing.read_documents(spark, zone, keys, one_per_file=True, day="2025:01")
    assert len(of_day.inputFiles()) == 300 and rows(of_day, "dt", "product_cls") == [("2025:01", "01")] * 300
    for day in ("2025:01", "20250102", "20250103"):
        sinks.compact_documents(spark, zone, str(tmp_path / "compact"), keys, day)
    found = landing.read_documents(spark, str(tmp_path / "compact"), keys)
    assert rows(found, F.trim("value"), "dt") == rows(docs.where("dt <> '20250102' OR value < 100"), "value", "dt")
