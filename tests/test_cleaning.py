import datetime as dt

import pytest
from pyspark.errors import PySparkException

from tillstar.operators.cleaning import (
    CLEANERS, clean_cards, clean_dates, clean_orders, clean_products, clean_stores, clean_users,
    convert_weights, quarantine,
)

USERS = "country string, country_code string, date_of_birth string, join_date string, company string"


def users(spark, *rows):
    return spark.createDataFrame(list(rows), USERS)


def test_users(spark):
    raw = users(
        spark,
        ("Germany", "DE", "1968-10-16", "2006/09/03", "a"),
        ("United Kingdom", "GGB", "JUNK", "2006/09/03", "NULL"),
        ("United States", "US", "1968-10-16", None, "b"),
        ("United States", "US", "1968-10-16", "2006/09/03", None),
        ("France", "DE", "1968-10-16", "2006/09/03", "c"),
        ("Germany", "FR", "1968-10-16", "2006/09/03", "d"),
        (None, "DE", "1968-10-16", "2006/09/03", "e"),
    )
    got = {r.company: r for r in clean_users(raw).collect()}
    assert set(got) == {"a", "NULL"}  # the text NULL is not a null
    assert got["NULL"].country_code == "GB" and got["NULL"].date_of_birth is None
    assert got["a"].date_of_birth == dt.date(1968, 10, 16)

    reasons = {r.company: r.reject_reasons for r in quarantine(raw, "users").collect()}
    assert reasons["NULL"] == ["date_of_birth unreadable"]
    assert reasons["b"] == ["join_date missing", "join_date unreadable"]
    assert reasons[None] == ["company missing"]
    assert reasons["c"] == ["country not served"] and reasons["d"] == ["country_code not served"]
    assert reasons["e"] == ["country not served", "country missing"]
    assert "a" not in reasons


def test_users_strict_raises_on_a_bad_date(spark):
    raw = users(spark, ("Germany", "DE", "JUNK", "2006/09/03", "a"))
    with pytest.raises(PySparkException, match="unreadable date: JUNK"):
        clean_users(raw, strict=True).collect()
    dropped_first = users(spark, ("France", "DE", "JUNK", "2006/09/03", "a"))
    assert clean_users(dropped_first, strict=True).count() == 0


def test_cards(spark):
    raw = spark.createDataFrame(
        [("??4000", "01/24", "2001-02-03"), ("4001", "JUNK", "2001-02-03"), ("4002", None, "2001-02-03"),
         ("4003", "01/24", None), (None, "01/24", "2001-02-03"), ("4004", "01/24", "JUNK"),
         ("4000", "01/24", "2001-02-03")],
        "card_number string, expiry_date string, date_payment_confirmed string",
    )
    got = sorted((r.card_number, r.date_payment_confirmed) for r in clean_cards(raw).collect() if r[2])
    assert got == [("4000", dt.date(2001, 2, 3))] * 2  # duplicates stay
    assert {r.card_number for r in clean_cards(raw).collect()} == {"4000", "4004"}
    assert quarantine(raw, "cards").count() == 5


def test_integer_card_numbers_stay_integers(spark):
    raw = spark.createDataFrame(
        [(30060773296197, "1", "a", "b")],
        "card_number bigint, `1` string, first_name string, last_name string",
    )
    assert [tuple(r) for r in clean_orders(raw).collect()] == [("30060773296197",)]


def test_stores(spark):
    raw = spark.createDataFrame(
        [("A", "DE", "1990-01-01", "J78", "eeEurope"), ("B", "GGB", "1990-01-01", "1", "Europe"),
         ("C", "US", "JUNK", "", "eeAmerica"), ("D", None, "1990-01-01", "1", "Europe"),
         ("E", "GB", "1990-01-01", None, None)],
        "store_code string, country_code string, opening_date string, staff_numbers string, continent string",
    )
    got = {r.store_code: (r.staff_numbers, r.continent, r.opening_date) for r in clean_stores(raw).collect()}
    day = dt.date(1990, 1, 1)
    assert got == {"A": (78, "Europe", day), "C": (None, "America", None), "E": (None, None, day)}


def test_products(spark):
    raw = spark.createDataFrame(
        [("a", "£1.99", "5 x 15g", "Still_avaliable", "2005-01-01", "1"),
         ("b", "JUNK", "1kg", "Removed", "JUNK", "2"), ("c", "£2", "JUNK", "Removed", "2005-01-01", "3"),
         ("d", "£2", "1kg", "JUNK", "2005-01-01", "4"), ("e", "£2", "1kg", None, "2005-01-01", "5")],
        "product_code string, product_price string, weight string, removed string, date_added string, EAN string",
    )
    got = {r.product_code: r for r in clean_products(convert_weights(raw)).collect()}
    assert set(got) == {"a", "b"} and "ean" in got["a"].asDict()
    assert (got["a"].product_price, got["a"].weight, got["a"].removed) == (1.99, 0.075, "Still_available")
    assert got["b"].product_price is None and got["b"].date_added is None
    reasons = {r.product_code: r.reject_reasons for r in quarantine(raw, "products").collect()}
    assert reasons == {
        "b": ["product_price unreadable", "date_added unreadable"], "c": ["weight unreadable"],
        "d": ["removed not a known state"], "e": ["removed not a known state"],
    }


def test_strict_weights(spark):
    df = lambda w: spark.createDataFrame([(w,)], "weight string")
    assert convert_weights(df("JUNK"), strict=True).count() == 0  # no unit at all: only dropped
    for bad in ["2 x 1kg", "abcg", "g"]:
        with pytest.raises(PySparkException, match="unreadable weight"):
            convert_weights(df(bad), strict=True).collect()


def test_orders_need_their_columns_only_when_strict(spark):
    raw = spark.createDataFrame([("4000", "x")], "card_number string, first_name string")
    assert clean_orders(raw).columns == ["card_number"]
    with pytest.raises(KeyError, match="last_name"):
        clean_orders(raw, strict=True)


def test_dates(spark):
    raw = spark.createDataFrame(
        [("Evening",), ("Morning",), ("Midday",), ("Late_Hours",), ("JUNK",), (None,), ("evening",)],
        "time_period string",
    )
    assert sorted(r[0] for r in clean_dates(raw).collect()) == ["Evening", "Late_Hours", "Midday", "Morning"]


def test_cleaners_neither_shuffle_nor_leave_the_jvm(spark, plan_of):
    from tillstar.contract.queries import RAW

    for table, cleaner in CLEANERS.items():
        if table == "orders":  # its fixture joins
            continue
        text = plan_of(cleaner(RAW[table](spark, "/root/testdata/sf0.001")))
        assert "Exchange hashpartitioning" not in text and "Python" not in text, table


def test_allowed_values_reach_the_scan(spark, tmp_path, plan_of):
    path = str(tmp_path / "dates")
    spark.createDataFrame([("Evening", "1")], "time_period string, day string").write.parquet(path)
    assert "PushedFilters: [In(time_period" in plan_of(clean_dates(spark.read.parquet(path)))
