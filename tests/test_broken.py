"""Broken documents are kept whole."""

from pyspark.sql.types import StringType, StructField, StructType

from tillstar.sources import read_json_columns


def test_long_broken_document_is_kept_whole(spark, tmp_path):
    text = '{"a": {' + ", ".join(f'"{i}": "row {i}"' for i in range(500)) + "}, broken"
    (tmp_path / "d.json").write_text(text)
    df = read_json_columns(spark, str(tmp_path / "d.json"), StructType([StructField("a", StringType())]), broken="mark")
    assert [r["mark"] for r in df.collect()] == [text]


def test_broken_sources_are_read_once(spark, plan_of):
    """Quarantine, rows and clean rows are counted of what was read, not by reading anew."""
    from tillstar.contract.queries import QUERIES

    text = plan_of(QUERIES["broken_input"](spark, "/root/testdata/sf0.001"))
    assert not any(f"FileScan {kind}" in text for kind in ("text", "csv", "json"))
    assert text.count("FileScan parquet") == 9
