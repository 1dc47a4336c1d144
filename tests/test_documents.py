from __future__ import annotations

import json

from pyspark.sql import functions as F

from pricelake.operators import documents as ops
from pricelake.operators.landing_keys import category_keys, organic_keys, product_keys
from pricelake.operators.requests import category_requests, product_requests, tree_requests
from pricelake.plans import silver
from pricelake.schemas import PRODUCTS
from pricelake.sources import landing


def frame(spark, texts, **keys):
    rows = [(f"p{i}", t, *keys.values()) for i, t in enumerate(texts)]
    names = ", ".join(f"{k} string" for k in ("file_path", "value", *keys))
    return spark.createDataFrame(rows, names)


def by_path(df, column):
    found = {}
    for row in df.collect():
        found.setdefault(row.file_path, []).append(row[column])
    return found


def test_explode_items_shapes(spark):
    docs = frame(
        spark,
        [
            '{"data":{"item":[{"item_name":" a ","dpr1":"1,000"},{"item_name":"b","dpr1":"-"}]}}',
            '{"data":{"item":{"item_name":"one","dpr1":"5"}}}',
            '{"data":["001"]}',
            '{"data":[]}',
            "{}",
            '{"data":{"item":[]}}',
            '{"data":{"item":[{"item_name":"a"},"x"]}}',
            '{"data":{"item":[{"item_name":"a"},null]}}',
            '{"data":{"item":null}}',
            "{bad",
            '{"data":{"item":[{"item_name":null,"unit":["u"]}]}}',
            '{"data":"text"}',
        ],
    )
    rows = ops.explode_items(docs)
    assert by_path(rows, "item_nm") == {"p0": ["a", "b"], "p1": ["one"], "p10": [None]}
    assert by_path(rows, "base_pr") == {"p0": [1000.0, None], "p1": [5.0], "p10": [None]}
    assert by_path(rows, "kind_nm") == {"p0": ["", ""], "p1": [""], "p10": [""]}
    assert by_path(rows, "unit")["p10"] == ['["u"]']


def test_explode_prices_shapes(spark):
    docs = frame(
        spark,
        [
            '{"error_code":"000","condition":[["d"]],"price":[{"productno":"1","direction":[]},{"productno":["2"],"value":"[x"}]}',
            '{"price":"none"}',
            '{"price":{"productno":"1"}}',
            '{"price":null}',
            '{"price":[]}',
            "{}",
            '{"price":[{"productno":"1"},3]}',
            '{"price":[{"productno"',
        ],
    )
    rows = ops.explode_prices(docs)
    assert by_path(rows, "productno") == {"p0": ["1", "2"], "p1": [None], "p2": [None], "p3": [None]}
    assert by_path(rows, "direction")["p0"] == [None, None]
    assert by_path(rows, "value")["p0"] == [None, "[x"]
    assert by_path(rows, "price") == {"p0": [None, None], "p1": ["none"], "p2": ['{"productno":"1"}'], "p3": [None]}
    assert by_path(rows, "condition")["p0"] == ['["d"]', '["d"]']


def test_explode_parses_once(spark):
    docs = frame(spark, ["{}"])
    plan = ops.explode_prices(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("StructField(productno,StringType,true),StructField(lastest_day") == 1


def test_explode_records(spark):
    docs = frame(spark, ['[{"yyyy":"2025"},{"yyyy":"2024"}]', '{"yyyy":"2023"}', "[]", "[1]", '[{"yyyy":"1"},', "null"])
    assert by_path(ops.explode_records(docs), "yyyy") == {"p0": ["2025", "2024"], "p1": ["2023"]}


def test_status(spark):
    cases = {
        '{"data":{"error_code":"000"}}': "ok", '{"data":{"error_code":"200"}}': "error:200",
        '{"data":{"x":1}}': "error:", '{"data":{}}': "missing", '{"data":["001"]}': "empty", '{"data":[]}': "missing",
        '{"data":["900"]}': "ok", '{"data":[{"a":1}]}': "ok", "{}": "missing", '{"data":null}': "missing",
        '{"data":""}': "missing", '{"data":0}': "missing", '{"data":false}': "missing", '{"data":"x"}': "unexpected",
        '{"data":true}': "unexpected", '{"data":{"error_code":"000"': "broken", "{bad": "broken",
    }
    docs = frame(spark, list(cases))
    found = by_path(ops.with_status(docs, "status"), "status")
    assert [found[f"p{i}"][0] for i in range(len(cases))] == list(cases.values())
    allowed = by_path(ops.with_status(docs, "status", allow_empty=True), "status")
    assert (allowed["p4"], allowed["p5"]) == (["ok"], ["missing"])


def test_price_list_status(spark):
    docs = frame(spark, ['{"price":[1]}', '{"price":[]}', '{"price":"x"}', "{}", "{bad", '{"price":[{}]}'])
    found = by_path(ops.with_price_list_status(docs, "status"), "status")
    assert list(found.values()) == [["ok"], ["empty"], ["not_a_list"], ["not_a_list"], ["broken"], ["ok"]]


def test_condition(spark):
    docs = frame(spark, ['{"condition":[{"a":" x ","b":5,"c":null}]}', '{"condition":[["2025-12-11","y"]]}', "{}"])
    for key, want in {"a": ["x", "", ""], "b": ["", "", ""], "c": ["", "", ""], "d": ["", "", ""]}.items():
        got = docs.select("file_path", ops.condition_field(ops.first_condition(F.col("value")), key).alias("v")).orderBy("file_path").collect()
        assert [r.v for r in got] == want
    dates = docs.select("file_path", ops.condition_date(F.col("value")).alias("v")).orderBy("file_path").collect()
    assert [r.v for r in dates] == [None, "2025-12-11", None]


def test_landing_keys(spark):
    category = '{"condition":[{"p_regday":"2025-12-11","p_product_cls_code":"02","p_country_code":"","p_category_code":"100"}]}'
    keyed = category_keys(frame(spark, [category, "{}"])).drop("file_path", "value").collect()
    assert [tuple(r) for r in keyed] == [("2025-12-11", "02", "all", "100")]

    product = frame(spark, [' {"condition":[["2025-12-11"]],"price":[]}', '{"condition":[]}'], region="1101")
    row = product_keys(product, "region").collect()
    assert [(r.dt, r.product_cls, r.country) for r in row] == [("20251211", "01", "1101")]
    assert json.loads(row[0].value) == {"_country_code": "1101", "condition": [["2025-12-11"]], "price": []}

    organic = (
        '{"condition":[{"p_regday":"2025-12-11","p_itemcategorycode":"100","p_itemcode":"111","p_kindcode":"01",'
        '"p_productrankcode":"04"}]}'
    )
    keyed = organic_keys(frame(spark, [organic])).drop("file_path", "value").first()
    assert tuple(keyed) == ("2025-12-11", "01", "all", "100", "111", "01", "04")


def test_response_records_by_date(spark):
    docs = frame(
        spark,
        [
            '{"data":{"error_code":"000","item":[{"yyyy":"2025","regday":"12/17"},{"yyyy":"","regday":"12/18"}]}}',
            '{"data":{"error_code":"000","item":{"yyyy":"2025","regday":"12/16"}}}',
            '{"data":{"error_code":"900","item":{"yyyy":"2025","regday":"12/15"}}}',
        ],
    )
    rows = ops.group_by_date(ops.explode_response_records(docs))
    assert by_path(rows, "dt") == {"p0": ["2025-12-17"], "p1": ["2025-12-16"]}


def test_file_layout_and_rejects(spark, tmp_path):
    folder = tmp_path / "raw" / "dt=2025-12-11" / "product_cls=01" / "country=서울"
    folder.mkdir(parents=True)
    (folder / "data.json").write_text('{\n "data": {"error_code": "000",\n "item": {"item_name": "a"}}}', encoding="utf-8")
    (folder / "other.json").write_text("{", encoding="utf-8")
    (folder / "note.txt").write_text("x", encoding="utf-8")
    docs = landing.read_documents(spark, str(tmp_path / "raw"), ["dt", "product_cls", "country"], True, ".json")
    rows = {r.file_path.rsplit("/", 1)[1]: r for r in landing.scan_status(docs).collect()}
    assert {k: r.rejected for k, r in rows.items()} == {"data.json": False, "other.json": True}
    assert (rows["data.json"].product_cls, rows["data.json"].country) == ("01", "서울")
    assert landing.with_path_attributes(docs.select("file_path", "value")).first().country == "서울"
    assert [r.item_nm for r in ops.explode_items(docs).collect()] == ["a"]


def test_empty_documents_are_rejected(spark):
    texts = ["[]", "{}", "", "null", "[ ]", '{"a":1}', "[1]"]
    got = by_path(landing.scan_status(frame(spark, texts)), "rejected")
    assert [got[f"p{i}"][0] for i in range(len(texts))] == [True] * 5 + [False] * 2


def test_category_silver_codes(spark):
    text = '{"data":{"item":{"item_name":"a","dpr1":"5"}}}'
    docs = frame(spark, [text], dt="2025-12-29", product_cls="01", country="all", category="100")
    unknown = frame(spark, [text], dt="2025-12-29", product_cls="9", country="1", category="700")
    row = silver.category_silver(docs).first()
    assert (row.product_cls_nm, row.category_nm, row.country_nm) == ("소매", "식량작물", "전국")
    assert (str(row.res_dt), row.week_of_year, row.year, row.month, row.dt) == ("2025-12-29", 1, "2025", "12", "20251229")
    row = silver.category_silver(unknown).first()
    assert (row.product_cls_nm, row.category_nm, row.country_nm) == ("미분류", "미분류", "기타")


def test_region_silver_resolves_codes_and_names(spark):
    record = {"countyname": "x", "marketname": "m", "yyyy": "2025", "regday": "12/1", "price": "1,000"}
    pseudo = {**record, "countyname": "평균"}
    keys = {"product_cls": "01", "category": "100", "item": "111", "kind": "01", "product_rank": "04"}
    daily = frame(spark, [json.dumps([record, pseudo])], dt="2025-12-01", country="1101", **keys)
    yearly = frame(spark, [json.dumps([record])], dt="2025", country="서울", **keys)
    meta = spark.createDataFrame(
        [(7, "01", "소매", "1kg", "100", "식량작물", "111", "쌀", "01", "일반", "04", "상품")], PRODUCTS
    )
    rows = silver.region_silver(daily.unionByName(yearly), meta).collect()
    assert len(rows) == 2
    for row in rows:
        assert (row.country_cd, row.country_nm, row.product_no, row.price) == ("1101", "서울", 7.0, 1000.0)
        assert (str(row.res_dt), row.year, row.month) == ("2025-12-01", "2025", "12")


def test_requests(spark):
    days = spark.sql("SELECT DATE'2025-12-11' AS run_date")
    grid = category_requests(days)
    assert grid.count() == 36
    assert grid.where("country_code IS NULL").count() == 6
    assert {str(r.regday) for r in grid.collect()} == {"2025-12-10"}
    assert product_requests(days).count() == 24
    tree = '{"100":{"products":{"111":{"varieties":{"01":{"retail_codes":["04","05"]},"02":{"retail_codes":[]}}}}}}'
    rows = [tuple(r) for r in tree_requests(spark.createDataFrame([(tree,)], "value string")).collect()]
    assert rows == [("100", "111", "01", "04"), ("100", "111", "01", "05")]


def test_single_records_are_not_tried_as_a_list(spark):
    """The text says which shape comes first; the other one is still found, also where the text misleads."""
    texts = [
        '{"data":{"item":{"a":"1"}}}', '{"data":{"item":[{"a":"1"}]}}', '{"data": {"item": {"a": "1"}}}', '{"data": {"item" : [{"a": "1"}]}}',
        '{"x":{"item":{"a":"2"}},"data":{"item" :[{"a":"1"}]}}', '{"data":{"item":"text"}}', "{", None,
    ]
    found = ops.with_records(frame(spark, texts), "found", ["data", "item"], "struct<a:string>").orderBy("file_path").collect()
    assert [r.found and [i.a for i in r.found] for r in found] == [["1"]] * 5 + [None] * 3
    plan = ops.with_records(frame(spark, texts), "found", ["data", "item"], "struct<a:string>")._jdf.queryExecution().analyzed().toString()
    assert "Contains(value" in plan or "contains(value" in plan


def test_outcome_told_is_that_of_the_explode(spark):
    """A text after the end of a document is no matter to the parse, so its records count as rows in both."""
    docs = frame(spark, ['[{"price":"1"}]', '[{"price":"1"}] x', "[]", "[null]", "["])
    told = {r.file_path: r.outcome for r in ops.with_outcome(docs, "region").collect()}
    exploded = {r.file_path: r.outcome for r in ops.explode_records(docs, outcomes=True).collect()}
    assert told == exploded and told["p1"] == "rows"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_do_not_parse_documents_again(spark, sf_dir):
    from pricelake.workload import documents as queries

    for query in (queries.category_landing_keys, queries.product_landing_keys):
        assert not [line for line in _plan(query(spark, sf_dir)).split("\n") if "Filter" in line and "from_json" in line]


def test_documents_are_not_built_inside_the_parse(spark, sf_dir):
    from pricelake.workload import documents as queries

    for query in (queries.classify_price_lists, queries.condition_dates, queries.category_landing_keys):
        plan = _plan(query(spark, sf_dir))
        assert "StructsToJsonEvaluator" not in plan
        assert not [line for line in plan.split("\n") if "from_json" in line and "l_tax" in line]


def test_keys_are_looked_for_only_where_a_null_stands(spark):
    """A label that is missing, null, or NULL in a document with a null elsewhere."""
    texts = ['{"data":{"item":{"item_name":"a"}}}', '{"data":{"item":[{"item_name":null},{"rank":"r","x":null}]}}', '{"data":{"item":{"item_name":"null"}}}']
    found = ops.explode_items(frame(spark, texts)).orderBy("file_path", "pos").collect()
    assert [(r.item_nm, r.rank_nm) for r in found] == [("a", ""), (None, ""), ("", "r"), ("null", "")]
    plan = ops.explode_items(frame(spark, texts))._jdf.queryExecution().optimizedPlan().toString()
    assert any("has_gap" in line and "Contains(value" in line and "null)" in line for line in plan.split("\n"))
