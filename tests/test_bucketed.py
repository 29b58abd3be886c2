"""Views over inputs bucketed by product id (JO5-JO7, JO9, JO11): the same rows, and no
shuffle of the wide product rows; one scan of the clusters (JO13)."""

from __future__ import annotations

import os
import re

import pytest
from conftest import D, benchmark, destination, insight, inputs, plan_text, product, rows, stat
from test_best_sellers import cluster, mapping

from shelfwise import schemas
from shelfwise.plans import best_sellers, inventory
from shelfwise.sources import readers

DAY, PREV = D(2024, 1, 8), D(2024, 1, 7)


def _inputs(spark):
    products = [product(day=DAY, pid=f"p{k}", offer=f"Sku{k}", destinations=[destination(approved=["US", "DE"][: 1 + k % 2])])
                for k in range(40)]
    products += [product(day=DAY, pid="p1", offer="Sku7"), product(day=PREV, pid="p1", offer="Sku1")]
    return inputs(
        spark, products=products, stats=[stat(PREV, item=f"SKU{k}", clicks=k) for k in range(20)],
        pc=[benchmark(DAY, f"p{k}", "US", 9_000_000 + k) for k in range(0, 40, 3)],
        pi=[insight(DAY, f"p{k}", 8_000_000 + k) for k in range(0, 40, 4)],
        clusters=[cluster(f"e{k}", rank=k) for k in range(30)], mapping=[mapping(f"e{k}", f"p{k}") for k in range(0, 30, 2)])


@pytest.fixture()
def bucketed(spark, tmp_dir):
    i = _inputs(spark)
    names = {}
    for kind in readers.BUCKETED:
        names[kind] = f"bucketed_{kind}_{os.path.basename(tmp_dir).replace('-', '_')}"
        readers.write_bucketed(getattr(i, kind), names[kind], kind, 4, path=os.path.join(tmp_dir, kind))
    yield i, names
    for name in names.values():
        spark.sql(f"DROP TABLE {name}")


def _above(df, scan: str) -> list[list[str]]:
    """For each scan whose detail text matches, the operators between it and the top of the plan."""
    text = plan_text(df)
    tree, details = text.split("\n\n")[0].splitlines(), text.split("\n\n")[1:]
    numbers = {m.group(1) for d in details if re.search(scan, d) and (m := re.match(r"\((\d+)\) Scan", d.strip()))}
    lines = [(len(re.match(r"^[ :+|-]*", ln).group()), ln) for ln in tree if "(" in ln]
    found = []
    for at, (depth, line) in enumerate(lines):
        if re.search(r"Scan .*\((\d+)\)", line) and re.search(r"\((\d+)\)$", line.strip()).group(1) in numbers:
            path = []
            for d, ln in reversed(lines[:at]):
                if d < depth:
                    depth = d
                    path.append(ln.strip(" :+|-").split(" ")[0])
            found.append(path)
    return found


def _views(i):
    return inventory.inventory_view(i), best_sellers.best_sellers_view(i)


def _text(df):
    return sorted(map(str, df.collect()))


def test_bucketed_inputs_give_the_same_views(spark, bucketed):
    i, names = bucketed
    there = readers.read_bucketed(spark, i, names)
    for plain, other in zip(_views(i), _views(there), strict=True):
        assert _text(plain) == _text(other)
    some = readers.read_bucketed(spark, i, names, start=DAY)
    assert rows(inventory.inventory_view(some).select("date").distinct(), "date") == [(DAY,)]


def test_bucketed_products_are_not_shuffled(spark, bucketed):
    i, names = bucketed
    there = readers.read_bucketed(spark, i, names)
    wide = r"ReadSchema: struct<.*title"
    for view in _views(there)[:1]:
        paths = _above(view, wide)
        assert len(paths) == 1 and "Exchange" not in paths[0]
        assert any("Join" in x for x in paths[0])
    narrow = _above(_views(there)[0], r"ReadSchema: struct<(?!.*title).*destinations")
    assert narrow and all(p.index("Window") < p.index("Exchange") for p in narrow)


def test_tables_that_are_not_bucketed_alike_are_refused(spark, bucketed, tmp_dir):
    i, names = bucketed
    i.price_insights.write.format("parquet").option("path", os.path.join(tmp_dir, "x")).saveAsTable("not_bucketed")
    with pytest.raises(ValueError, match="not bucketed by id"):
        readers.read_bucketed(spark, i, names | {"price_insights": "not_bucketed"})
    spark.sql("DROP TABLE not_bucketed")
    readers.write_bucketed(i.price_insights, "eight", "price_insights", 8, path=os.path.join(tmp_dir, "y"))
    with pytest.raises(ValueError, match="numbers of buckets differ"):
        readers.read_bucketed(spark, i, names | {"price_insights": "eight"})
    spark.sql("DROP TABLE eight")


def test_clusters_and_mapping_are_joined_once(spark, tmp_dir):
    i = _inputs(spark)
    for name, schema in (("best_sellers_clusters", schemas.BEST_SELLERS_CLUSTERS), ("best_sellers_mapping", schemas.BEST_SELLERS_MAPPING)):
        path = os.path.join(tmp_dir, name)
        getattr(i, name).write.parquet(path)
        setattr(i, name, spark.read.schema(schema).parquet(path))
    view = best_sellers.best_sellers_view(i)
    assert len(_above(view, r"ReadSchema: struct<.*relative_demand")) == 1
    assert _text(view) == _text(best_sellers.best_sellers_view(_inputs(spark)))


def test_unmapped_clusters_are_dealt_by_entity(spark):
    clusters = [cluster(f"e{k}") for k in range(200)] + [cluster(None)]
    view = best_sellers.best_sellers_view(inputs(spark, products=[product(day=DAY, pid="p1")], clusters=clusters,
                                                 mapping=[mapping("e1", "p1"), mapping("e2", None), mapping("e3", "\0e3US")]))
    got = {r["entity_id"]: r["product_id"] for r in view.collect()}
    assert len(got) == 201 and {k for k, v in got.items() if v} == {"e1"}
    assert "dealt_by" in plan_text(view)
