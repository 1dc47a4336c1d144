from __future__ import annotations

from pricelake.operators.sinks import land_documents
from pricelake.plans.loads import load_category
from pricelake.streaming.incremental import load_new

KEYS = ["dt", "product_cls", "country", "category"]


def test_new_files_load_their_whole_dates(spark, tmp_path):
    root, silver, state = (str(tmp_path / name) for name in ("raw", "silver", "state"))

    def land(day, region, price):
        text = '{"data":{"item":{"item_name":"a","dpr1":"%s"}}}' % price
        row = [(text, day, "01", region, "100")]
        land_documents(spark.createDataFrame(row, "value string, " + ", ".join(f"{k} string" for k in KEYS)), root)

    def stored():
        found = spark.read.schema("country_cd string, base_pr double, dt string").parquet(silver)
        return sorted((r.dt, r.country_cd, r.base_pr) for r in found.select("dt", "country_cd", "base_pr").collect())

    def run():
        loaded = []

        def load(docs):
            loaded.append(docs.count())
            load_category(docs, silver)

        load_new(spark, root, KEYS, state, load)
        return loaded

    land("2025-12-10", "1101", "10")
    land("2025-12-11", "1101", "11")
    assert sum(run()) == 2
    land("2025-12-11", "2100", "12")
    assert run() == [2]
    assert stored() == [("20251210", "1101", 10.0), ("20251211", "1101", 11.0), ("20251211", "2100", 12.0)]
    assert run() == []
