import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tillstar.contract import fixtures as fx
from tillstar.operators.cleaning import ROUTE, ROUTES, quarantine
from tillstar.operators.profiling import max_lengths
from tillstar.operators.typing import STAR
from tillstar.plans import sales
from tillstar.plans.warehouse import _apart, build_warehouse, profile_star, star_tables
from tillstar.streaming import clean_stream

SF = "/root/testdata/sf0.001"


def content(df):
    return sorted(map(repr, df.collect()))


def test_build_twice_gives_the_same_star(spark, tmp_path):
    raw = fx.raw_tables(spark, SF)
    out = str(tmp_path / "star")
    first = build_warehouse(spark, raw, out)
    before = {t: content(df) for t, df in first.tables.items()}
    second = build_warehouse(spark, raw, out)
    assert {t: content(df) for t, df in second.tables.items()} == before
    assert all((tmp_path / "star" / spec.name).is_dir() for spec in STAR.values())
    assert second.pk_report.count() == 0
    assert {r.key_column: r.orphan_rows > 0 for r in second.fk_report.collect()} == {
        "user_uuid": True, "store_code": True, "product_code": True, "date_uuid": True, "card_number": True,
    }
    assert second.rejects["orders"].count() == 0 and second.rejects["products"].count() > 0
    assert sales.sale_gap_formatted(second.tables).count() == 5

    second.create_views()
    by_sql = spark.sql("""
        SELECT s.store_type, sum(o.product_quantity * p.product_price) AS total_sales
        FROM orders_table o JOIN dim_store_details s ON o.store_code = s.store_code
        JOIN dim_products p ON o.product_code = p.product_code
        WHERE s.country_code = 'DE' GROUP BY s.store_type""")
    answers = {r.store_type: r.total_sales for r in sales.country_sales_by_store_type(second.tables).collect()}
    assert {r.store_type: pytest.approx(r.total_sales) for r in by_sql.collect()} == answers


def test_strict_build_raises(spark, tmp_path):
    with pytest.raises(Exception, match="unreadable date: JUNK"):
        build_warehouse(spark, {"users": fx.raw_users(spark, SF)}, str(tmp_path / "star"), strict=True)
    raw = {t: df for t, df in fx.raw_tables(spark, SF).items() if t in ("orders", "dates")}
    with pytest.raises(ValueError, match="violated"):
        build_warehouse(spark, raw, str(tmp_path / "keys"), strict=True)


@pytest.mark.parametrize("table, make", [("users", fx.raw_users), ("products", fx.raw_products), ("stores", fx.raw_stores)])
def test_stream_of_files_equals_batch(spark, tmp_path, table, make):
    raw = make(spark, SF)
    landed, out, checkpoint = (str(tmp_path / x) for x in ("landed", "out", "checkpoint"))

    def run():
        clean_stream(spark, table, landed, raw.schema, out, checkpoint).awaitTermination()

    raw.limit(0).union(raw).repartition(3).write.mode("append").json(landed)
    run()
    run()  # nothing new: nothing is taken twice
    batch = star_tables({table: raw})[table]
    assert content(spark.read.parquet(out).select(batch.columns)) == content(batch)
    raw.write.mode("append").json(landed)
    run()
    assert spark.read.parquet(out).count() == 2 * batch.count()


def test_every_raw_row_is_read_once(spark, tmp_path):
    """Star, quarantine, counts and lengths from one pass over a source that never says the
    same twice."""
    raw = fx.raw_tables(spark, SF)
    read = {t: spark.sparkContext.accumulator(0) for t in raw}

    def counting(df, seen):
        def run(batches):
            for pdf in batches:
                seen.add(len(pdf))
                yield pdf

        return df.mapInPandas(run, df.schema)

    built = build_warehouse(spark, {t: counting(df, read[t]) for t, df in raw.items()}, str(tmp_path / "star")).store_reports()
    assert built.reject_counts().count() > 5 and built.profile().count() > 20
    for t, df in raw.items():
        assert read[t].value == df.count()
        assert content(built.tables[t]) == content(star_tables({t: df})[t])
        assert content(built.rejects[t].select("*")) == content(quarantine(df, t))
    assert content(built.profile()) == content(profile_star(built.tables).select("column_name", "non_null", "data_type", "table_name"))
    longest = {(r.table_name, r.column_name): r.max_length for r in built.max_lengths().collect()}
    for t, spec in STAR.items():
        for r in max_lengths(built.tables[t], list(spec.measured)).collect():
            assert longest[spec.name, r.column_name] == r.max_length
        assert built.measured[t].rows == built.tables[t].count()


def test_routes_of_odd_rows(spark, tmp_path):
    """Further columns with odd names, nothing but rejects, an empty table."""
    stores = fx.raw_stores(spark, SF).withColumn("a column, with; odd name", F.lit(1)).withColumn("route", F.lit("own"))
    rejects = stores.withColumn("country_code", F.lit("XX"))
    for k, df in enumerate([stores, rejects, stores.limit(0)]):
        built = build_warehouse(spark, {"stores": df}, str(tmp_path / f"star{k}"))
        assert content(built.tables["stores"]) == content(star_tables({"stores": df})["stores"])
        assert content(built.rejects["stores"]) == content(quarantine(df, "stores"))


def test_routes_are_written_without_a_sort(spark, tmp_path, monkeypatch):
    """Rows of all routes in one task come to three files at once, in the order they had."""
    name, write, limits = "spark.sql.maxConcurrentOutputFileWriters", DataFrameWriter.parquet, []
    before = spark.conf.get(name)
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, **more: (limits.append(spark.conf.get(name)), write(self, path, **more)))
    stores = fx.raw_stores(spark, SF)
    undated = stores.withColumns({"store_code": F.concat(F.lit("U"), "store_code"), "opening_date": F.lit("JUNK")})
    stores = stores.unionByName(undated).coalesce(1)
    routes = _apart(spark, stores, "stores")
    assert limits == ["3"] and spark.conf.get(name) == before
    want = [r.store_code for r in star_tables({"stores": stores})["stores"].collect()]
    got = {r.store_code: r.asDict()[ROUTE] for r in routes.collect()}
    assert set(got.values()) == set(ROUTES) and len(got) == stores.count()
    assert sorted(k for k, route in got.items() if route != "dropped") == sorted(want)
    assert len(routes.inputFiles()) == len(ROUTES)
