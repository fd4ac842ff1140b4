"""Queries over texts that are easily read wrong, columns nobody listed, and broken input."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import digits_only, parse_date, strict_double, to_kg, uuid_text
from ..operators.cleaning import CLEANERS, quarantine
from ..session import scratch_path
from ..sources import RAW_SCHEMAS, load, read_json_columns, read_pages, read_stores
from ..sources.readers import BROKEN
from . import fixtures as fx
from .landing import raw
from .oracle import _uuid as uuid_sql
from .registry import register

# Text and what it reads as (None: nothing).
WEIGHTS = [
    ("1.6kg", 1.6), ("0.4kg", 0.4), ("590g", 0.59), ("12 x 100g", 1.2), ("8 x 85g", 0.68), ("3 x 2kg", None), ("800ml", 0.8),
    ("16oz", 16 * 0.0283495), ("77g .", 0.077), (".5g .", 0.005), ("12.5f", None), ("3D", None), ("inf", None), ("infkg", None),
    ("nankg", None), ("1_000g", None), ("1e3g", 1.0), ("x", None), ("5 x g", None), ("KG5", None), ("5KG", None), ("", None),
    ("-3g", -0.003), (" 7kg", 7.0), ("2 x 3ml", None), ("GO9NZIF7", None),
]
NUMBERS = [
    ("12.5", 12.5), ("12.5f", None), ("3D", None), ("inf", None), ("-inf", None), ("nan", None), ("1_000", None), ("1,000", None),
    (".5", 0.5), ("5.", 5.0), (".", None), ("", None), ("1e3", 1000.0), ("1e", None), (" 7 ", 7.0), ("+4", 4.0), ("--4", None), ("0x10", None),
]
DIGITS = [("J78", 78), ("30e", 30), ("-12.5e", 125), ("", None), ("JUNK", None), ("3n9", 39), ("80R", 80)]
UUIDS = [
    ("93caf182-e4e9-4c6e-bebb-60a1a9dcf9b8", "93caf182-e4e9-4c6e-bebb-60a1a9dcf9b8"),
    ("93CAF182-E4E9-4C6E-BEBB-60A1A9DCF9B8", "93caf182-e4e9-4c6e-bebb-60a1a9dcf9b8"),
    ("{93caf182-e4e9-4c6e-bebb-60a1a9dcf9b8}", "93caf182-e4e9-4c6e-bebb-60a1a9dcf9b8"),
    ("93caf182e4e94c6ebebb60a1a9dcf9b8", "93caf182-e4e9-4c6e-bebb-60a1a9dcf9b8"),
    ("{93CAF182E4E94C6EBEBB60A1A9DCF9B8}", "93caf182-e4e9-4c6e-bebb-60a1a9dcf9b8"),
    ("93caf182-e4e9-4c6e-bebb-60a1a9dcf9b", None), ("g3caf182-e4e9-4c6e-bebb-60a1a9dcf9b8", None), ("", None), ("JUNK", None),
]
DATES = [
    ("2018-10-22", "2018-10-22"), ("2018 October 22", "2018-10-22"), ("October 2018 22", "2018-10-22"), ("2018/10/22", "2018-10-22"),
    ("10/22/2018", "2018-10-22"), ("22/10/2018", "2018-10-22"), ("01/02/2003", "2003-01-02"), ("20181022", "2018-10-22"),
    ("2018-10-22 08:00:00", "2018-10-22"), ("22 October 2018", "2018-10-22"), ("October 22, 2018", "2018-10-22"), ("2018 Oct 22", "2018-10-22"),
    ("Oct 2018 5", "2018-10-05"), ("October 22 2018", "2018-10-22"), ("22-10-2018", "2018-10-22"), ("10-11-2018", "2018-10-11"),
    ("2018-10-22T08:00:00", "2018-10-22"), ("2018-10-22 08:00", "2018-10-22"), ("2018-10-22T08:00:00.123Z", "2018-10-22"),
    ("2018.10.22", "2018-10-22"), ("22.10.2018", "2018-10-22"), ("22-Oct-2018", "2018-10-22"), ("2018-Oct-22", "2018-10-22"),
    ("Oct-22-2018", "2018-10-22"), ("10/22/2018 08:00:00", "2018-10-22"), ("10/22/2018 8:00 PM", "2018-10-22"), ("22nd October 2018", "2018-10-22"),
    ("October 1st, 2018", "2018-10-01"), ("october 22, 2018", "2018-10-22"), (" 2018-10-22 ", "2018-10-22"), ("May 2001 3", "2001-05-03"),
    ("Monday 22 October 2018", "2018-10-22"), ("Mon, 22 Oct 2018", "2018-10-22"), ("Sept 4 2018", "2018-09-04"), ("22/Oct/2018", "2018-10-22"),
    ("20181022T080000", "2018-10-22"), ("22. October 2018", "2018-10-22"), ("Oct. 22, 2018", "2018-10-22"), ("22 October, 2018", "2018-10-22"),
    ("2018 22 October", "2018-10-22"), ("22Oct2018", "2018-10-22"), ("22 of October 2018", "2018-10-22"), ("8:00 AM 22 October 2018", "2018-10-22"),
    ("20181022080000", "2018-10-22"), ("22 2018 Oct", "2018-10-22"), ("2018-22-10", None), ("10 2018 22", None), ("May 5 May 2018", None),
    ("the 22 October 2018", None), ("2018-10-22T25:00", None), ("20181322", None), ("Oct 22", None), ("22 October 18", None),
    ("2020-02-30", None), ("31/31/2003", None), ("October 2000", None), ("10/11/12", None), ("Octember 22 2018", None), ("5", None),
    ("", None), ("JUNK", None), ("08:00:00", None),
]


def _literal(value) -> str:
    if value is None:
        return "NULL"
    return repr(value) if isinstance(value, (int, float)) else "'" + value.replace("'", "''") + "'"


def _texts(spark: SparkSession, sf_dir: str, cases: list[tuple], read) -> DataFrame:
    """Every part with one of the texts, in turn, and what `read` makes of it."""
    texts = F.array(*(F.lit(text) for text, _ in cases))
    picked = fx.table(spark, sf_dir, "part").select("p_partkey", F.get(texts, (F.col("p_partkey") % len(cases)).cast("int")).alias("text"))
    return picked.select("p_partkey", "text", read(F.col("text")).alias("value"))


def _trap(name: str, cases: list[tuple], kind: str, read) -> None:
    values = ", ".join(f"({i}, {_literal(text)}, CAST({_literal(value)} AS {kind}))" for i, (text, value) in enumerate(cases))
    register(name, f"""
        SELECT p_partkey, text, value FROM part JOIN (VALUES {values}) cases(place, text, value) ON p_partkey % {len(cases)} = place""")(
        lambda spark, sf: _texts(spark, sf, cases, read)
    )


_trap("trap_weights", WEIGHTS, "DOUBLE", to_kg)
_trap("trap_numbers", NUMBERS, "DOUBLE", strict_double)
_trap("trap_uuids", UUIDS, "VARCHAR", uuid_text)


def _shown(read: Callable) -> Callable:
    return lambda text: read(text).cast("string")


_trap("trap_dates", DATES, "VARCHAR", _shown(parse_date))
_trap("trap_digits", [(t, None if v is None else str(v)) for t, v in DIGITS], "VARCHAR", _shown(digits_only))


# --- Columns nobody listed, broken input ---------------------------------------

def _documents(df: DataFrame, key: str, names: list[str], rows: int) -> DataFrame:
    """Column-oriented documents of up to `rows` rows each; `key` numbers the rows."""
    grouped = df.groupBy((F.col(key) / rows).cast("bigint").alias("doc")).agg(
        F.array_sort(F.collect_list(F.struct(key, *names))).alias("rows")
    )
    columns = [F.map_from_arrays(F.col(f"rows.{key}").cast("array<string>"), F.col(f"rows.{n}")).alias(n) for n in names]
    return grouped.select("doc", F.to_json(F.struct(*columns)).alias("value"))


@register("source_columns_kept", """
    SELECT 'products' AS source, 'note' AS column_name, count(*) FILTER (product_code LIKE '%7') AS filled, count(*) AS n_rows FROM raw_products
    UNION ALL SELECT 'dates', 'note', count(*) FILTER (date_uuid LIKE '%7'), count(*) FROM raw_dates
    UNION ALL SELECT 'stores', 'note', count(*) FILTER (store_code LIKE '%7'), count(*) FROM raw_stores
    UNION ALL SELECT 'cards', 'note', count(*) FILTER (card_number LIKE '%7'), count(*) FROM raw_cards
    UNION ALL SELECT 'clean cards', 'note', count(*), count(*) FROM clean_cards WHERE card_number LIKE '%7'""")
def source_columns_kept(spark, sf):
    """Sources with a column that no schema lists, filled where a key ends in 7.

    Of the cards only those are clean that have it: a null in any column drops a card.
    """
    noted = lambda df, key: df.withColumn("note", F.when(F.col(key).endswith("7"), "seven"))
    at = scratch_path(spark, "noted")
    noted(raw(spark, sf, "products"), "product_code").write.option("header", True).csv(f"{at}/products.csv")
    dates = noted(fx.raw_dates(spark, sf, "o_orderkey"), "date_uuid")
    names = [*RAW_SCHEMAS["dates"].fieldNames(), "note"]
    _documents(dates, "o_orderkey", names, 4096).select("value").write.text(f"{at}/dates.json")
    noted(raw(spark, sf, "stores"), "store_code").write.json(f"{at}/stores.jsonl")
    cards = noted(raw(spark, sf, "cards"), "card_number")
    cards.where("note IS NULL").drop("note").write.parquet(f"{at}/cards/1")
    cards.where("note IS NOT NULL").write.parquet(f"{at}/cards/2")
    pages = read_pages(spark, f"{at}/cards", RAW_SCHEMAS["cards"])
    found = {
        "products": load(spark, f"{at}/products.csv", RAW_SCHEMAS["products"]),
        "dates": read_json_columns(spark, f"{at}/dates.json", RAW_SCHEMAS["dates"], one_per_line=True),
        "stores": read_stores(spark, f"{at}/stores.jsonl", RAW_SCHEMAS["stores"]),
        "cards": pages,
        "clean cards": CLEANERS["cards"](pages),
    }
    counts = [
        df.agg(F.lit(s).alias("source"), F.lit("note").alias("column_name"), F.count("note").alias("filled"), F.count("*").alias("n_rows"))
        for s, df in found.items()
    ]
    return reduce(DataFrame.unionByName, counts)


@register("broken_input", """
    SELECT 'products' AS source, count(*) FILTER (product_code LIKE '%9') AS broken, count(*) AS n_rows,
      (SELECT count(*) FROM clean_products WHERE product_code NOT LIKE '%9') AS clean FROM raw_products
    UNION ALL SELECT 'stores', count(*) FILTER (store_code LIKE '%9'), count(*),
      (SELECT count(*) FROM clean_stores WHERE store_code NOT LIKE '%9') FROM raw_stores
    UNION ALL
    SELECT 'dates', count(DISTINCT doc) FILTER (doc % 3 = 1), count(DISTINCT doc) FILTER (doc % 3 = 1) + count(*) FILTER (doc % 3 <> 1),
      count(*) FILTER (doc % 3 <> 1 AND time_period <> 'JUNK')
    FROM (SELECT o_orderkey // 64 AS doc, time_period FROM orders
          JOIN (SELECT date_uuid, time_period FROM raw_dates) ON date_uuid = """ + uuid_sql("'d' || o_orderkey") + """)""")
def broken_input(spark, sf):
    """CSV rows with a field too many, lines that are no JSON, and cut documents.

    What can't be read is found in quarantine, the rest is clean as if it had been alone.
    """
    at = scratch_path(spark, "broken")
    names = RAW_SCHEMAS["products"].fieldNames()
    line = F.concat_ws(",", *(F.coalesce(F.col(n), F.lit("")) for n in names))
    more = F.when(F.col("product_code").endswith("9"), ",surplus").otherwise("")
    lines = raw(spark, sf, "products").select(F.concat(line, more).alias(",".join(names)))
    # One text column, whose name is the header; no quotes, as no value holds a comma.
    lines.write.options(header=True, sep="\u0001", quote="").csv(f"{at}/products.csv")
    stores = raw(spark, sf, "stores")
    stores.select(F.when(F.col("store_code").endswith("9"), '{"store_code": ').otherwise(F.to_json(F.struct("*"))).alias("value")).write.text(f"{at}/stores.jsonl")
    documents = _documents(fx.raw_dates(spark, sf, "o_orderkey"), "o_orderkey", RAW_SCHEMAS["dates"].fieldNames(), 64)
    cut = F.when(F.col("doc") % 3 == 1, F.col("value").substr(F.lit(1), F.length("value") - 5)).otherwise(F.col("value"))
    documents.select(cut.alias("value")).write.text(f"{at}/dates.json")
    found = {
        "products": load(spark, f"{at}/products.csv", RAW_SCHEMAS["products"], broken=BROKEN),
        "stores": read_stores(spark, f"{at}/stores.jsonl", RAW_SCHEMAS["stores"], broken=BROKEN),
        "dates": read_json_columns(spark, f"{at}/dates.json", RAW_SCHEMAS["dates"], one_per_line=True, broken=BROKEN),
    }
    counted = []
    for t, df in found.items():
        # Read once, as a job would land it; three counts are taken of it.
        df.write.option("compression", "zstd").parquet(f"{at}/read/{t}")
        df = spark.read.schema(df.schema).parquet(f"{at}/read/{t}")
        unread = F.array_contains("reject_reasons", "input unreadable")
        counted += [
            quarantine(df, t).where(unread).select(F.lit(t).alias("source"), F.lit("broken").alias("kind")),
            df.select(F.lit(t).alias("source"), F.lit("n_rows").alias("kind")),
            CLEANERS[t](df).select(F.lit(t).alias("source"), F.lit("clean").alias("kind")),
        ]
    kinds = ["broken", "n_rows", "clean"]
    return reduce(DataFrame.unionByName, counted).groupBy("source").agg(
        *(F.count(F.when(F.col("kind") == k, 1)).alias(k) for k in kinds)
    )
