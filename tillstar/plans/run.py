"""The whole job: read the six raw tables, build the star, report on it, answer the nine questions."""

from pyspark.sql import DataFrame, SparkSession

from ..sources import (
    RAW_SCHEMAS, SourceRegistry, fetch_store_count, fetch_stores, list_tables, load, read_pages, read_stores,
    read_table, store_count,
)
from ..sources.readers import BROKEN
from . import sales
from .report import show
from .warehouse import Warehouse, build_warehouse

QUESTIONS = {
    "Stores per country": sales.stores_per_country,
    "Localities with most stores": sales.top_localities,
    "Sales by month": sales.sales_by_month,
    "Web and offline": sales.web_vs_offline,
    "Share of each store type": sales.store_type_share,
    "Best months": sales.top_year_months,
    "Staff per country": sales.staff_per_country,
    "German sales by store type": sales.country_sales_by_store_type,
    "Time between sales": sales.sale_gap_formatted,
}


#: The tables each question needs.
NEEDS = {
    "Stores per country": "stores", "Localities with most stores": "stores", "Staff per country": "stores",
    "Sales by month": "orders products dates", "Web and offline": "orders stores",
    "Share of each store type": "orders products stores", "Best months": "orders products dates",
    "German sales by store type": "orders products stores", "Time between sales": "orders dates",
}


def read_raw(
    spark: SparkSession, registry: SourceRegistry, table: str, source: dict, strict: bool = False
) -> DataFrame:
    """One raw table from where `source` says it is, with every column it has there.

    kind `table`: `source` and `name` of a registered database, with the four split
    options if its parallel read is not to be worked out; `file`: `path`; `pages`:
    `path`, `format`; `stores`: `path`, and `count` if a document says how many stores
    there are; `api`: `endpoint` and `count` endpoint of a store service, `headers`.
    Input that can't be read becomes rows for `quarantine`, or an error when strict.
    """
    kind, schema = source["kind"], RAW_SCHEMAS[table]
    broken = None if strict else BROKEN
    if kind == "table":
        split = {k: v for k, v in source.items() if k not in ("kind", "source", "name")}
        return read_table(spark, registry, source["source"], source["name"], split or None)
    if kind == "file":
        return load(spark, source["path"], schema, source.get("format"), broken)
    if kind == "pages":
        return read_pages(spark, source["path"], schema, source.get("format", "parquet"), broken)
    if kind == "stores":
        count = store_count(spark, source["count"]) if "count" in source else None
        return read_stores(spark, source["path"], schema, count, broken=broken)
    if kind == "api":
        headers = source.get("headers")
        count = fetch_store_count(source["count"], headers)
        return fetch_stores(spark, source["endpoint"], schema, count, headers, broken=broken)
    raise ValueError(f"{table}: unknown kind of source {kind!r}")


def answers(tables: dict[str, DataFrame], strict: bool = False) -> dict[str, DataFrame]:
    """The answer to each question that the tables at hand allow."""
    asked = {t: q for t, q in QUESTIONS.items() if set(NEEDS[t].split()) <= set(tables)}
    return {t: q(tables, strict=strict) if q is sales.sale_gap_formatted else q(tables) for t, q in asked.items()}


def run(
    spark: SparkSession, registry: SourceRegistry, sources: dict[str, dict],
    out: str | dict[str, str], strict: bool = False, printed: bool = True,
) -> Warehouse:
    """Read every table of `sources`, write and check the star at `out`, print what it says.

    Beside the star's tables stand the raw rows that cleaning or typing could not use
    (`rejects_<table>`) and every violated key (`pk_violations`, `fk_orphans`).
    """
    raw = {table: read_raw(spark, registry, table, source, strict) for table, source in sources.items()}
    warehouse = build_warehouse(spark, raw, out, strict).store_reports()
    if printed:
        for title, answer in answers(warehouse.tables, strict).items():
            show(answer, title)
        show(warehouse.reject_counts(), "Rows rejected, in whole or in part")
        show(warehouse.key_counts(), "Primary keys missing or repeated")
        if warehouse.fk_report is not None:
            show(warehouse.fk_report, "Foreign keys without a match")
        show(warehouse.types, "Column types before and after")
        show(warehouse.profile(), "Filled values")
        found = list_tables(spark, registry=warehouse.registry, source="star")
        print(f"\nTables: {', '.join(found)}")
    return warehouse
