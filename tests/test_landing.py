"""How the given tables are landed: the same rows, moved while they are narrow."""

import pytest
from pyspark.sql import functions as F

from tillstar.contract import fixtures as fx
from tillstar.contract import landing
from tillstar.contract.queries import QUERIES
from tillstar.plans.warehouse import build_warehouse

SF = "/root/testdata/sf0.01"


@pytest.fixture
def afresh(monkeypatch):
    monkeypatch.setattr(landing, "_WRITTEN", {})


@pytest.mark.parametrize("small_orders", [True, False])
def test_lines_of_an_order_land_together(spark, afresh, small_orders):
    name, several = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, before if small_orders else "-1")
    spark.conf.set(several, "false")
    try:
        landed = [landing.raw(spark, SF, "orders"), *landing.loaded(spark, SF, "orders").values()]
        wanted = [fx.raw_orders(spark, SF), fx.sales_fact(spark, SF)]
        for df, want in zip(landed, wanted, strict=True):
            assert df.dtypes == want.dtypes
            assert df.exceptAll(want).isEmpty() and want.exceptAll(df).isEmpty()
            files = df.select("date_uuid", F.input_file_name().alias("file")).distinct()
            assert files.select("file").distinct().count() > 1
            assert files.count() == df.select("date_uuid").distinct().count()
    finally:
        spark.conf.set(name, before)
        spark.conf.set(several, "true")


@pytest.mark.parametrize("small_orders", [True, False])
def test_lines_of_an_order_lie_side_by_side(spark, afresh, small_orders):
    """Where a file holds a key in one run, the key takes its bytes once."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, before if small_orders else "-1")
    try:
        for df in (landing.raw(spark, SF, "orders"), *landing.loaded(spark, SF, "orders").values()):
            keys = [(r.file, r.date_uuid) for r in df.select("date_uuid", F.input_file_name().alias("file")).collect()]
            runs = sum(a != b for a, b in zip(keys, keys[1:])) + 1
            assert runs == len(set(keys)) < len(keys)
    finally:
        spark.conf.set(name, before)


def test_keys_are_stored_compressed(spark, afresh, tmp_path):
    """Keys are hex digits of four bits each, which a codec without entropy coding can't shorten."""
    users = landing.raw(spark, SF, "users")
    built = build_warehouse(spark, {"users": users}, str(tmp_path / "star"))
    for df in (users, built.tables["users"]):
        assert df.inputFiles() and all(".zstd." in f for f in df.inputFiles())


def test_large_tables_read_once_are_not_landed(spark, afresh):
    """The foreign key report reads lines and dates once, so it doesn't write them first."""
    QUERIES["fk_orphans"](spark, SF)
    assert not {"orders", "dates"} & {name for *_, name in landing._WRITTEN}
    landing.raw(spark, SF, "dates")
    assert "/raw-dates-" in landing.raw_once(spark, SF, "dates")["dates"].inputFiles()[0]


def test_the_star_is_built_without_landing(spark, afresh):
    """Each raw table is read once to build a star, so none is written first."""
    shares = QUERIES["star_store_type_share"](spark, SF)
    assert not landing._WRITTEN and shares.count() == 5
