import json

import pytest
from pyspark.sql import functions as F

from tillstar import __main__ as cli
from tillstar.contract import fixtures as fx
from tillstar.operators.typing import STAR
from tillstar.plans.run import read_raw, run
from tillstar.plans.warehouse import build_warehouse, star_tables
from tillstar.sources import RAW_SCHEMAS, SourceRegistry

SF = "/root/testdata/sf0.001"


@pytest.fixture
def landed(spark, tmp_path):
    """The six raw tables as they would land, one kind of source each."""
    raw = fx.raw_tables(spark, SF)
    at = {t: str(tmp_path / t) for t in raw}
    for t in ("users", "orders"):
        raw[t].withColumn("index", F.monotonically_increasing_id()).write.parquet(f"{tmp_path}/db/{t}")
    raw["cards"].drop("expiry_date").limit(0).write.parquet(f"{at['cards']}/1")
    raw["cards"].write.parquet(f"{at['cards']}/2")
    numbered = raw["stores"].withColumn("index", F.substring("store_code", 4, 8).cast("bigint"))
    numbered.write.json(at["stores"])
    (tmp_path / "count.json").write_text(json.dumps({"number_stores": 10}))
    raw["products"].write.option("header", True).csv(f"{at['products']}.csv")
    names = RAW_SCHEMAS["dates"].fieldNames()
    columns = {n: {} for n in names}
    for i, row in enumerate(raw["dates"].select(names).collect()):
        for n in names:
            columns[n][str(i)] = row[n]
    (tmp_path / "dates.json").write_text(json.dumps(columns))
    job = {
        "databases": {"legacy": {"format": "parquet", "path": f"{tmp_path}/db"}},
        "sources": {
            "users": {"kind": "table", "source": "legacy", "name": "users"},
            "orders": {"kind": "table", "source": "legacy", "name": "orders"},
            "cards": {"kind": "pages", "path": f"{at['cards']}/*"},
            "stores": {"kind": "stores", "path": at["stores"], "count": f"{tmp_path}/count.json"},
            "products": {"kind": "file", "path": f"{at['products']}.csv"},
            "dates": {"kind": "file", "path": f"{tmp_path}/dates.json"},
        },
        "out": str(tmp_path / "star"),
    }
    return raw, job


def content(df, columns):
    return sorted(map(repr, df.select(columns).collect()))


def test_landed_sources_give_the_star(spark, landed):
    raw, job = landed
    warehouse = run(spark, SourceRegistry(job["databases"]), job["sources"], job["out"], printed=False)
    for t, df in star_tables(raw).items():
        assert content(warehouse.tables[t], df.columns) == content(df, df.columns), t


def test_command_line(spark, landed, tmp_path, capsys, monkeypatch):
    _, job = landed
    monkeypatch.setenv("LANDED_AT", job["databases"]["legacy"]["path"])
    job["databases"]["legacy"]["path"] = "$LANDED_AT"
    (tmp_path / "job.json").write_text(json.dumps(job))
    cli.main(str(tmp_path / "job.json"))
    printed = capsys.readouterr().out
    assert "Time between sales" in printed and "Foreign keys without a match" in printed
    assert all((tmp_path / "star" / spec.name).is_dir() for spec in STAR.values())


def test_columns_beyond_the_known_ones(spark, tmp_path):
    """A null in any column of a card drops the card, so columns nobody listed count."""
    rows = [("1", "01/24", "2001-02-03", "visa"), ("2", "01/24", "2001-02-03", None)]
    cards = spark.createDataFrame(
        rows, "card_number string, expiry_date string, date_payment_confirmed string, provider string"
    )
    cards.write.parquet(str(tmp_path / "cards"))
    source = {"kind": "pages", "path": str(tmp_path / "cards")}
    got = star_tables({"cards": read_raw(spark, SourceRegistry(), "cards", source)})["cards"]
    assert got.columns == ["card_number", "expiry_date", "date_payment_confirmed", "provider"]
    assert [(r.card_number, r.provider) for r in got.collect()] == [("1", "visa")]


def test_broken_lines_go_to_quarantine(spark, tmp_path):
    good = {"store_code": "S1", "country_code": "DE", "continent": "Europe", "staff_numbers": "3", "opening_date": "2001-02-03", "latitude": "abc"}
    (tmp_path / "stores.jsonl").write_text(json.dumps(good) + "\n{broken\n")
    source = {"kind": "stores", "path": str(tmp_path / "stores.jsonl")}
    built = run(spark, SourceRegistry(), {"stores": source}, str(tmp_path / "star"))
    assert [r.store_code for r in built.tables["stores"].collect()] == ["S1"]
    counts = {r.reason: r.rows_rejected for r in built.reject_counts().collect()}
    assert counts == {"input unreadable": 1, "latitude unreadable": 1}
    written = spark.read.parquet(str(tmp_path / "star" / "rejects_stores"))
    assert {r.broken_input for r in written.collect()} == {None, "{broken"}
    with pytest.raises(Exception, match="broken input|not a coordinate"):
        run(spark, SourceRegistry(), {"stores": source}, str(tmp_path / "strict"), strict=True)


def test_strict_coordinates(spark):
    stores = spark.createDataFrame(
        [("S1", "DE", "Europe", "3", "2001-02-03", "1.5", None, "junk", "Local", "town")],
        "store_code string, country_code string, continent string, staff_numbers string, opening_date string, "
        "latitude string, lat string, longitude string, store_type string, locality string",
    )
    assert star_tables({"stores": stores})["stores"].first().longitude is None
    with pytest.raises(Exception, match="not a coordinate"):
        star_tables({"stores": stores}, strict=True)["stores"].collect()


def test_keys_that_cannot_be_read_are_reported(spark, tmp_path):
    orders = spark.createDataFrame(
        [("JUNK", "93caf182-e4e9-4c6e-bebb-60a1a9dcf9b8", 1, "S1", "P1", 40000), ("{93CAF182-E4E9-4C6E-BEBB-60A1A9DCF9B8}", None, 2, "S1", "P1", 3)],
        "date_uuid string, user_uuid string, card_number long, store_code string, product_code string, product_quantity int",
    )
    built = build_warehouse(spark, {"orders": orders}, str(tmp_path / "star"))
    assert [r.reject_reasons for r in built.rejects["orders"].collect()] == [["date_uuid no UUID", "product_quantity no small whole number"]]
    assert sorted(map(str, (r.product_quantity for r in built.tables["orders"].collect()))) == ["3", "None"]


def test_job_without_a_fact(spark, tmp_path, capsys):
    raw = fx.raw_tables(spark, SF)
    raw["stores"].write.json(str(tmp_path / "stores"))
    built = run(spark, SourceRegistry(), {"stores": {"kind": "stores", "path": str(tmp_path / "stores")}}, str(tmp_path / "star"))
    printed = capsys.readouterr().out
    assert built.fk_report is None and "Stores per country" in printed and "Share of each" not in printed
    assert "Tables: dim_store_details, pk_violations, rejects_stores" in printed


def test_all_violations_are_written(spark, tmp_path):
    users = spark.createDataFrame(
        [("A", "B", "1990-01-01", "Germany", "DE", "2001-01-01", f"93caf182-e4e9-4c6e-bebb-{i // 2:012d}") for i in range(300)],
        "first_name string, last_name string, date_of_birth string, country string, country_code string, join_date string, user_uuid string",
    )
    built = build_warehouse(spark, {"users": users}, str(tmp_path / "star")).store_reports()
    assert spark.read.parquet(str(tmp_path / "star" / "pk_violations")).count() == 150
    assert [(r.key_values, r.row_count) for r in built.key_counts().collect()] == [(150, 300)]


def test_star_in_the_catalog(spark):
    raw = {"dates": fx.raw_dates(spark, SF)}
    built = build_warehouse(spark, raw, {"format": "catalog"}).tables["dates"]
    assert built.count() == spark.table("dim_date_times").count() > 0


def test_unknown_kind(spark):
    with pytest.raises(ValueError, match="unknown kind"):
        read_raw(spark, SourceRegistry(), "users", {"kind": "fax"})
