import json

import pytest
from pyspark.errors import PySparkException

from tillstar.plans.run import read_raw
from tillstar.session import scratch_path, shared_dir
from tillstar.sources import (
    RAW_SCHEMAS, SourceRegistry, fetch_store_count, fetch_stores, list_tables, load, read_csv, read_json_columns, read_pages, read_stores,
    read_table, stack_pages, store_count, write_table,
)
from tillstar.sources.readers import BROKEN, text_schema
from tillstar.sources.tables import bounds_query, jdbc_options, predicates_of, quantiles_query, split_of


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_csv_by_name_with_null_tokens(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text(',b,a,c\n0,"x, ""y""",1,z\n1,N/A,2,z\n2,,NULL,z\n')
    df = read_csv(spark, str(path), text_schema("a", "b"))
    assert df.columns == ["a", "b", "_c0", "c"] and df.count() == 3
    assert rows(df.select("a", "b")) == sorted([("1", 'x, "y"'), ("2", None), (None, None)], key=repr)
    assert rows(df.select("c")) == [("z",)] * 3
    assert rows(read_csv(spark, str(path), text_schema("b"), null_tokens=()).select("b")) == sorted(
        [('x, "y"',), ("N/A",), (None,)], key=repr
    )
    with pytest.raises(ValueError, match="lacks the columns"):
        read_csv(spark, str(path), text_schema("a", "missing"))


def test_csv_rows_with_surplus_fields(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text('a,b\n1,2\n3\n4,5,6\n7,8,\n"x,y",9\n')
    kept = read_csv(spark, str(path), text_schema("a", "b"), broken=BROKEN)
    assert rows(kept) == sorted(
        [("1", "2", None), ("3", None, None), (None, None, "4,5,6"), (None, None, "7,8,"), ("x,y", "9", None)], key=repr
    )
    assert kept.count() == 5 and kept.select("b").distinct().count() == 3
    strict = read_csv(spark, str(path), text_schema("a", "b"))
    for use in (strict.collect, strict.count, strict.select("a").collect):
        with pytest.raises(PySparkException, match="broken input"):
            use()


def test_csv_line_breaks_in_quotes(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text('a,b\n1,"x\ny"\n')
    assert rows(read_csv(spark, str(path), text_schema("a", "b"), multi_line=True)) == [("1", "x\ny")]


def test_json_columns(spark, tmp_path):
    schema = text_schema("a", "b")
    same = {"a": {"0": "x", "1": None, "10": "z"}, "b": {"0": 1, "1": 2, "10": 3}}
    loose = {"b": {"5": "q", "0": "p"}, "a": {"0": "m", "7": "n"}}
    lacking = {"a": {"0": "only"}}
    for i, doc in enumerate([same, loose, lacking]):
        (tmp_path / f"{i}.json").write_text(json.dumps(doc, indent=1))
    want = [("x", "1"), (None, "2"), ("z", "3"), (None, "q"), ("m", "p"), ("n", None), ("only", None)]
    assert rows(read_json_columns(spark, str(tmp_path), schema)) == sorted(want, key=repr)
    lines = tmp_path / "lines"
    lines.mkdir()
    (lines / "x.json").write_text("\n".join(map(json.dumps, [same, loose, lacking])) + "\n")
    assert rows(read_json_columns(spark, str(lines), schema, one_per_line=True)) == sorted(want, key=repr)


def test_json_columns_said_to_be_aligned(spark, tmp_path):
    schema = text_schema("a", "b")
    (tmp_path / "0.json").write_text('{"a": {"0": "x", "1": "y"}, "b": {"0": "1", "1": null}}')
    assert rows(read_json_columns(spark, str(tmp_path), schema, aligned=True)) == [("x", "1"), ("y", None)]
    (tmp_path / "1.json").write_text('{"a": {"0": "x"}, "b": {"1": "1"}}')
    with pytest.raises(PySparkException, match="different rows"):
        read_json_columns(spark, str(tmp_path), schema, aligned=True).collect()


def test_load_by_extension(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a\n1\n")
    (tmp_path / "t.json").write_text('{"a": {"0": "1"}}')
    (tmp_path / "t.jsonl").write_text('{"a": "1"}\n')
    for name in ("t.csv", "t.json", "t.jsonl"):
        assert rows(load(spark, str(tmp_path / name), text_schema("a"))) == [("1",)]
    (tmp_path / "t.dat").write_text("a\n1\n")
    assert rows(load(spark, str(tmp_path / "t.dat"), text_schema("a"), fmt="csv")) == [("1",)]
    for name in ("t.xml", "folder/plain"):
        with pytest.raises(ValueError, match="no reader"):
            load(spark, str(tmp_path / name), text_schema("a"))


def test_pages(spark, tmp_path):
    one = spark.createDataFrame([("1", "01/24", "x")], "card_number string, expiry_date string, extra string")
    two = spark.createDataFrame([("d", "2")], "date_payment_confirmed string, card_number string")
    stacked = stack_pages([one, two])
    assert rows(stacked.select("card_number", "expiry_date", "date_payment_confirmed", "extra")) == [
        ("1", "01/24", None, "x"), ("2", None, "d", None)
    ]
    for fmt in ("parquet", "json"):
        path = str(tmp_path / fmt)
        one.write.format(fmt).mode("append").save(path)
        two.write.format(fmt).mode("append").save(path)
        assert rows(read_pages(spark, path, RAW_SCHEMAS["cards"], fmt)) == [("1", "01/24", None, "x"), ("2", None, "d", None)]
    with pytest.raises(ValueError, match="stack_pages"):
        read_pages(spark, path, RAW_SCHEMAS["cards"], "csv")


def test_stores(spark, tmp_path):
    (tmp_path / "count.json").write_text('{"statusCode": 200, "number_stores": 2}')
    assert store_count(spark, str(tmp_path / "count.json")) == 2
    (tmp_path / "none.json").write_text('{"message": "Forbidden"}')
    with pytest.raises(ValueError, match="number_stores"):
        store_count(spark, str(tmp_path / "none.json"))
    schema = text_schema("store_code", "staff_numbers")
    docs = [{"index": i, "store_code": f"S{i}", "staff_numbers": str(i)} for i in range(4)]
    (tmp_path / "lines.jsonl").write_text("\n".join(map(json.dumps, docs)))
    assert rows(read_stores(spark, str(tmp_path / "lines.jsonl"), schema, count=2)) == [("S0", "0"), ("S1", "1")]
    files = tmp_path / "files"
    files.mkdir()
    for i, doc in enumerate(docs):
        (files / f"{i}.json").write_text(json.dumps(doc, indent=2))
    assert len(rows(read_stores(spark, str(files), schema, one_per_line=False))) == 4


def test_stores_of_a_service(spark, tmp_path):
    """The service is a folder behind file: addresses; no server may run here."""
    for i in range(7):
        (tmp_path / f"{i}.json").write_text(json.dumps({"index": i, "store_code": f"S{i}", "staff_numbers": i or None}))
    (tmp_path / "count.json").write_text('{"number_stores": 7}')
    base, schema = tmp_path.as_uri(), text_schema("store_code", "staff_numbers")
    assert fetch_store_count(f"{base}/count.json") == 7
    stores = fetch_stores(spark, base + "/{store_number}.json", schema, 7, {"x-api-key": "none"}, tasks=3)
    assert rows(stores) == sorted([("S0", None)] + [(f"S{i}", str(i)) for i in range(1, 7)], key=repr)
    with pytest.raises(PySparkException):
        fetch_stores(spark, base + "/{store_number}.json", schema, 8)

    source = {"kind": "api", "endpoint": base + "/{store_number}.json", "count": f"{base}/count.json"}
    assert read_raw(spark, SourceRegistry(), "stores", source).count() == 7


def test_registry_and_tables(spark, tmp_path):
    registry = SourceRegistry({
        "landed": {"format": "parquet", "path": str(tmp_path)}, "catalog": {"format": "catalog"},
    })
    with pytest.raises(KeyError, match="no source named 'other'"):
        read_table(spark, registry, "other", "t")
    df = spark.createDataFrame([(0, "a"), (1, "b")], "index int, v string")
    write_table(df, registry, "landed", "t")
    write_table(df.where("index = 1"), registry, "landed", "t", show_profile=True)
    assert rows(read_table(spark, registry, "landed", "t")) == [("b",)]
    write_table(df, registry, "catalog", "kept")
    write_table(df.where("index = 0"), registry, "catalog", "kept")
    assert rows(read_table(spark, registry, "catalog", "kept")) == [("a",)]
    assert "kept" in list_tables(spark)
    plain = spark.createDataFrame([("b",), ("a",)], "v string")
    write_table(plain, registry, "catalog", "numbered", index_by=("v",))
    assert rows(spark.table("numbered")) == [(0, "a"), (1, "b")]
    assert rows(read_table(spark, registry, "catalog", "numbered")) == [("a",), ("b",)]


def test_jdbc_options():
    source = {"url": "jdbc:postgresql://db/retail", "user": "u", "password": "p"}
    whole = jdbc_options(source, "users", None)
    assert whole["dbtable"] == "users" and "numPartitions" not in whole
    split = {"partitionColumn": "index", "lowerBound": "0", "upperBound": "1000", "numPartitions": "8"}
    assert jdbc_options(source, "users", split).items() >= split.items()
    with pytest.raises(ValueError, match="parallel"):
        jdbc_options(source, "users", {"numPartitions": "8"})


def test_scratch_is_under_the_shared_folder(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(shared_dir(spark))


def test_pages_with_numbers(spark, tmp_path):
    """Pages as their writer typed them, alike or not."""
    numbers = spark.createDataFrame([(1, "01/24")], "card_number bigint, expiry_date string")
    texts = spark.createDataFrame([("??2", "02/25")], "card_number string, expiry_date string")
    numbers.write.parquet(str(tmp_path / "pages" / "1"))
    path = str(tmp_path / "pages")
    assert rows(read_pages(spark, path, RAW_SCHEMAS["cards"])) == [("1", "01/24", None)]
    texts.write.parquet(str(tmp_path / "pages" / "2"))
    assert rows(read_pages(spark, path, RAW_SCHEMAS["cards"])) == [("1", "01/24", None), ("??2", "02/25", None)]


def test_columns_nobody_listed(spark, tmp_path):
    df = spark.createDataFrame([("1", 2, "x")], "a string, b int, c string")
    df.write.option("header", True).csv(str(tmp_path / "t.csv"))
    df.write.json(str(tmp_path / "t.jsonl"))
    df.write.parquet(str(tmp_path / "t.parquet"))
    (tmp_path / "t.json").write_text('{"c": {"0": "x"}, "b": {"0": 2}, "a": {"0": "1"}}')
    for name in ("t.csv", "t.jsonl", "t.json", "t.parquet"):
        got = load(spark, str(tmp_path / name), text_schema("b"))
        assert rows(got.select("a", "b", "c")) == [("1", "2", "x")], name
        assert got.columns[0] == "b"


def test_broken_json(spark, tmp_path):
    lines = tmp_path / "t.jsonl"
    lines.write_text('{"a": "1", "z": 5}\nnot json\n')
    documents = tmp_path / "documents"
    documents.mkdir()
    (documents / "good.json").write_text('{"a": {"0": "1"}}')
    (documents / "bad.json").write_text('{"a": {"0": ')
    assert rows(load(spark, str(lines), text_schema("a"), broken=BROKEN).select("a", "z", BROKEN)) == [("1", "5", None), (None, None, "not json")]
    assert rows(load(spark, str(documents), text_schema("a"), "json", BROKEN)) == [("1", None), (None, '{"a": {"0": ')]
    for path, fmt in ((lines, None), (documents, "json")):
        whole = load(spark, str(path), text_schema("a"), fmt)
        for use in (whole.collect, whole.count):
            with pytest.raises(PySparkException, match="broken input"):
                use()


def test_listed_tables(spark, tmp_path):
    registry = SourceRegistry({"landed": {"format": "parquet", "path": str(tmp_path / "db")}})
    assert list_tables(spark, registry=registry, source="landed") == []
    for name in ("b", "a"):
        write_table(spark.range(3).toDF("n"), registry, "landed", name)
    assert list_tables(spark, registry=registry, source="landed") == ["a", "b"]


def test_split_from_bounds():
    assert split_of(None, None, 0) is None and split_of(0, 9, 10, per_task=10) is None
    assert split_of(0, 99, 100, per_task=30) == {
        "partitionColumn": "index", "lowerBound": "0", "upperBound": "100", "numPartitions": "4"
    }
    assert bounds_query("users") == '(SELECT min("index") AS low, max("index") AS high, count(*) AS n FROM users) bounds'


@pytest.mark.parametrize("kind", ["bigint", "varchar", "date"])
def test_equal_shares_of_skewed_keys(kind):
    """Bounds and conditions as a database answers them: every row is read once, and no share is
    far larger than the others but where one value is."""
    import duckdb

    values = {
        "bigint": "CASE WHEN i % 3 = 0 THEN 7 WHEN i % 50 = 1 THEN NULL ELSE i * i * i END",
        "varchar": "CASE WHEN i % 3 = 0 THEN 'it''s hot' WHEN i % 50 = 1 THEN NULL ELSE repeat('x', i % 7) || i END",
        "date": "CASE WHEN i % 50 = 1 THEN NULL ELSE DATE '2000-01-01' + CAST(sqrt(i) AS INT) END",
    }
    con = duckdb.connect()
    con.execute(f"CREATE TABLE t AS SELECT i, CAST({values[kind]} AS {kind}) AS k FROM range(6000) r(i)")
    bounds = [r[0] for r in con.execute(f"SELECT bound FROM {quantiles_query('t', 'k', 12)} ORDER BY tile").fetchall()]
    assert len(bounds) == 12
    parts = predicates_of("k", bounds)
    counts = [con.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in parts]
    assert sum(counts) == 6000 == con.execute(f"SELECT count(*) FROM t WHERE {' OR '.join(f'({p})' for p in parts)}").fetchone()[0]
    single = [p for p in parts if "=" in p and "<" not in p]
    largest = max(c for p, c in zip(parts, counts, strict=True) if p not in single)
    assert largest <= 6000 / 12 + 200 and (kind == "date" or len(single) == 1)
    assert predicates_of("k", []) == ["1 = 1"]
