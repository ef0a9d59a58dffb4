"""Files to gold through all layers, run after run."""

from collections import Counter
from datetime import date
from decimal import Decimal
from uuid import uuid4

import pytest

import strata.plans.medallion as medallion
from strata.config import LayerConfig
from strata.plans.medallion import run_gold, run_pipeline
from strata.plans.orders import orders_pipeline

D1, D2 = date(2024, 1, 1), date(2024, 2, 1)


@pytest.fixture
def shop(tmp_path):
    config = LayerConfig(str(tmp_path / "lake"), prefix=f"t{uuid4().hex[:8]}_")
    return orders_pipeline(config, str(tmp_path / "landing")), tmp_path / "landing"


def land(landing, **files):
    for name, text in files.items():
        feed, _, number = name.rpartition("_")
        suffix = "csv" if feed.startswith("product") else "json"
        folder = landing / feed
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{number}.{suffix}").write_text(text)


FIRST = {
    "products_1": "product_id,product_type_id,size,price\nham_s,ham,S,$9.75\nham_l,ham,L,$20.50\n",
    "product_types_1": 'product_type_id,name,category,ingredients\nham,Ham,Classic,"ham, cheese"\n',
    "headers_1": '{"order_id":1,"date":"2015-01-01","time":"11:38:36"}\n',
    "lines_1": '{"line_id":1,"order_id":1,"product_id":"ham_s","quantity":2}\n'
    '{"line_id":2,"order_id":9,"product_id":"ham_l","quantity":1}\n'
    '{"line_id":3,"order_id":1,"product_id":"none","quantity":1}\n',
}
SECOND = {
    "products_2": "price,product_id,product_type_id,size\n$10.00,ham_s,ham,S\n",
    "lines_2": '{"line_id":4,"order_id":1,"product_id":"ham_s","quantity":"many"}\n',
}


def gold(spark, plan):
    rows = spark.table(plan.gold.table).collect()
    return Counter((r.line_id, r.order_date, r.order_time, r.product_name, r.total_price) for r in rows)


def test_runs(spark, shop):
    plan, landing = shop
    land(landing, **FIRST)
    run_pipeline(spark, plan, D1)
    seen = (date(2015, 1, 1), "11:38:36", "Ham")
    first = Counter([(1, *seen, Decimal("19.50")), (2, None, None, "Ham", Decimal("20.50"))])
    assert gold(spark, plan) == first
    run_pipeline(spark, plan, D2)
    assert gold(spark, plan) == first

    land(landing, **SECOND)
    run_pipeline(spark, plan, D2)
    products = spark.table(plan.gold.products).collect()
    assert sorted((r.product_id, r.price, r.end_date, r.status) for r in products if r.product_id == "ham_s") == [
        ("ham_s", Decimal("9.75"), D2, "i"),
        ("ham_s", Decimal("10.00"), None, "a"),
    ]
    assert gold(spark, plan) == first + Counter(
        [(1, *seen, Decimal("20.00")), (4, *seen, None), (4, *seen, None)]
    )
    rescued = spark.table(plan.feeds[2].table).filter("_rescued_data LIKE '%many%'")
    assert rescued.count() == 1


def test_a_failed_step_is_resumed(spark, shop, monkeypatch):
    plan, landing = shop
    land(landing, **FIRST)
    real = medallion.merge_dimension

    def broken(spark, dim, effective_date=None):
        if dim.key == "product_id":
            raise RuntimeError("crash")
        real(spark, dim, effective_date)

    monkeypatch.setattr(medallion, "merge_dimension", broken)
    with pytest.raises(RuntimeError, match="crash"):
        run_pipeline(spark, plan, D1)
    monkeypatch.setattr(medallion, "merge_dimension", real)
    run_pipeline(spark, plan, D1)
    assert sum(gold(spark, plan).values()) == 2
    run_gold(spark, plan)
    assert sum(gold(spark, plan).values()) == 2
