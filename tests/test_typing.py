import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tillstar.contract import fixtures as fx
from tillstar.operators.profiling import max_lengths, profile
from tillstar.operators.typing import STAR, type_changes
from tillstar.plans.warehouse import star_tables

SF = "/root/testdata/sf0.001"


def test_target_schema(spark):
    tables = star_tables(fx.raw_tables(spark, SF))
    types = {t: dict(df.dtypes) for t, df in tables.items()}
    assert types["orders"] == {
        "date_uuid": "string", "user_uuid": "string", "card_number": "string", "store_code": "string",
        "product_code": "string", "product_quantity": "smallint",
    }
    assert {c for c, t in types["users"].items() if t == "date"} == {"date_of_birth", "join_date"}
    assert types["stores"]["longitude"] == types["stores"]["latitude"] == "double"
    assert types["stores"]["staff_numbers"] == "smallint" and "lat" not in types["stores"]
    assert types["products"]["still_available"] == "boolean" and "removed" not in types["products"]
    assert types["products"]["product_price"] == types["products"]["weight"] == "double"
    assert types["dates"]["month"] == types["dates"]["timestamp"] == "string"
    assert types["cards"]["date_payment_confirmed"] == "date"


def store(latitude, lat, longitude="1.5", staff=1, kind="Local"):
    return ("A", longitude, "x" * 300, staff, dt.date(2000, 1, 2), kind, latitude, lat, "DE", "Europe")


STORE = (
    "store_code string, longitude string, locality string, staff_numbers bigint, opening_date date, "
    "store_type string, latitude string, lat string, country_code string, continent string"
)


@pytest.mark.parametrize("latitude, lat, want", [
    (None, "51.5", 51.5), ("51.5", None, 51.5), (None, "N/A", None), (None, None, None),
    ("N/A", "N/A", None), ("N/A", None, None),
])
def test_latitude_merge(spark, latitude, lat, want):
    df = STAR["stores"].apply(spark.createDataFrame([store(latitude, lat)], STORE))
    assert df.first().latitude == want


def test_store_limits(spark):
    raw = spark.createDataFrame([store("1", None, "N/A", 40000, None)], STORE)
    row = STAR["stores"].apply(raw).first()
    assert row.longitude is None and len(row.locality) == 255 and row.staff_numbers is None
    assert row.store_type is None and STAR["stores"].apply(raw).schema["store_type"].nullable
    with pytest.raises(PySparkException):
        STAR["stores"].apply(raw, strict=True).collect()


def test_uuid_strictness(spark):
    raw = spark.createDataFrame(
        [("JUNK", "1", "1", "1", "1", "t")],
        "date_uuid string, month string, year string, day string, time_period string, timestamp string",
    )
    assert STAR["dates"].apply(raw).first().date_uuid is None
    with pytest.raises(PySparkException, match="not a UUID: JUNK"):
        STAR["dates"].apply(raw, strict=True).collect()


def test_type_changes(spark):
    raw = spark.createDataFrame([store("1", None)], STORE)
    changes = {c: (old, new, nullable) for c, old, new, nullable in type_changes(raw, STAR["stores"].apply(raw))}
    assert changes["latitude"] == ("string", "double", True)
    assert changes["staff_numbers"] == ("bigint", "smallint", True)


def test_typing_is_one_projection(spark, plan_of):
    text = plan_of(star_tables({"products": fx.raw_products(spark, SF)})["products"])
    assert "Exchange" not in text and "Python" not in text


def test_profile_and_lengths_take_one_scan(spark, plan_of):
    df = spark.createDataFrame([("a", None, dt.date(2000, 1, 1)), ("abc", 1.0, None)], "s string, `d.x` double, t date")
    got = {r.column_name: (r.non_null, r.data_type) for r in profile(df).collect()}
    assert got == {"s": (2, "string"), "d.x": (1, "double"), "t": (1, "date")}
    parts = spark.read.parquet(f"{SF}/part.parquet")
    lengths = max_lengths(parts, ["p_name", "p_brand"])
    assert plan_of(lengths).count("FileScan") == 1
    want = parts.select(F.max(F.length("p_name")), F.max(F.length("p_brand"))).first()
    assert {r.column_name: r.max_length for r in lengths.collect()} == {"p_name": want[0], "p_brand": want[1]}
