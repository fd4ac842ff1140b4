"""Input tables as they would stand in storage before a query is asked.

The engine cleans landed files and asks its questions of loaded tables. Here both
are derived from the given tables, so each is written to the shared folder when a
session first needs it, and read from there: scans then prune columns, push
filters down and know their sizes, as they would in production. No result of a
query is kept.
"""

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path
from . import fixtures as fx

RAW = {
    "users": fx.raw_users, "cards": fx.raw_cards, "stores": fx.raw_stores,
    "products": fx.raw_products, "orders": fx.raw_orders, "dates": fx.raw_dates,
}
LOADED = {
    "orders": fx.sales_fact, "products": fx.sales_products, "stores": fx.sales_stores,
    "dates": fx.raw_dates,
}
_WRITTEN: dict[tuple, tuple] = {}


def _stored(spark: SparkSession, sf_dir: str, zone: str, name: str, make) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, zone, name)
    if key not in _WRITTEN:
        df, path = make(spark, sf_dir, source=fx.even_table), scratch_path(spark, f"{zone}-{name}")
        df.write.option("compression", "zstd").parquet(path)
        _WRITTEN[key] = path, df.schema
    path, schema = _WRITTEN[key]
    return spark.read.schema(schema).parquet(path)


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A raw table with its dirt."""
    return _stored(spark, sf_dir, "raw", name, RAW[name])


def raw_tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {name: raw(spark, sf_dir, name) for name in names or RAW}


def raw_once(spark: SparkSession, sf_dir: str, *names: str, source=fx.even_table) -> dict[str, DataFrame]:
    """Raw tables for a query that reads each once. One that nothing has landed yet is derived in
    the query's own plan: to write it first would only be one more pass over it."""
    app = spark.sparkContext.applicationId
    return {
        name: raw(spark, sf_dir, name) if (app, sf_dir, "raw", name) in _WRITTEN else RAW[name](spark, sf_dir, source=source)
        for name in names or RAW
    }


def loaded(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """Ready tables for the sales questions: every store, every price, every date."""
    return {name: _stored(spark, sf_dir, "loaded", name, LOADED[name]) for name in names}
