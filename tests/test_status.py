"""Country status from nested destinations (N5, N7, N8, N9)."""

from __future__ import annotations

from conftest import destination, inputs, product, rows

from shelfwise.operators import status


def _status(spark, products):
    return status.product_country_status(inputs(spark, products=products).products)


def test_null_or_empty_destinations_give_no_rows(spark):
    out = _status(spark, [{**product(pid="a"), "destinations": None}, product(pid="b", destinations=[])])
    assert out.count() == 0


def test_only_shopping_destinations_count(spark):
    out = _status(spark, [product(destinations=[destination(name="Display", approved=["US"])])])
    assert out.count() == 0


def test_approved_and_disapproved_country_is_one_row(spark):
    d = destination(approved=["US"], pending=["DE"], disapproved=["US"])
    got = rows(_status(spark, [product(destinations=[d])]), "targeted_country", "is_disapproved")
    assert got == [("DE", False), ("US", True)]


def test_no_country_gives_one_row_with_false_flag(spark):
    d = destination(approved=[], pending=None, disapproved=[])
    got = rows(_status(spark, [product(destinations=[d])]), "targeted_country", "is_disapproved")
    assert got == [(None, False)]


def test_null_lists_count_as_empty(spark):
    d = destination(approved=["US"], pending=None, disapproved=None)
    got = rows(_status(spark, [product(destinations=[d])]), "targeted_country", "is_disapproved")
    assert got == [("US", False)]


def test_two_shopping_destinations_can_contradict(spark):
    d1 = destination(approved=["US"])
    d2 = destination(approved=[], disapproved=["US"])
    got = rows(_status(spark, [product(destinations=[d1, d2])]), "targeted_country", "is_disapproved")
    assert got == [("US", False), ("US", True)]


def test_has_shopping_destination_is_never_null(spark):
    df = inputs(spark, products=[{**product(pid="a"), "destinations": None},
                                 product(pid="b", destinations=[]),
                                 product(pid="c")]).products
    got = rows(df.select("product_id", status.has_shopping_destination().alias("x")),
               "product_id", "x")
    assert got == [("a", False), ("b", False), ("c", True)]
