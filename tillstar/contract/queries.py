"""Every registered query with its SQL twin.

Dates, and whole numbers that may be null, leave as text, so that both engines show
them alike.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import digits_only, parse_date, strict_double, weight_class
from ..operators.cleaning import CLEANERS, convert_weights
from ..operators.integrity import fk_orphans, pk_violations
from ..operators.profiling import max_lengths, profile
from ..operators.sequence import with_index
from ..operators.typing import STAR
from ..plans import sales
from ..plans.report import report
from ..plans.warehouse import build_warehouse, star_tables
from ..session import scratch_path
from ..sources import (
    RAW_SCHEMAS, SourceRegistry, load, read_json_columns, read_pages, read_stores, read_table,
    scalar, write_table,
)
from . import fixtures as fx
from .landing import RAW, loaded, raw, raw_once, raw_tables
from .registry import ORACLES, QUERIES, register

def printable(df: DataFrame, *nullable: str) -> DataFrame:
    as_text = {c: F.col(c).cast("string") for c, t in df.dtypes if t == "date" or c in nullable}
    return df.withColumns(as_text) if as_text else df


def _text(*names: str) -> str:
    return "* REPLACE (" + ", ".join(f"CAST({n} AS VARCHAR) AS {n}" for n in names) + ")"


# --- The sales questions -----------------------------------------------------

SALES = {
    "stores_per_country": (sales.stores_per_country, "stores", """
        SELECT country_code, count(country_code) AS total_no_stores FROM sales_stores GROUP BY country_code"""),
    "top_localities": (sales.top_localities, "stores", """
        SELECT locality, count(locality) AS total_no_stores FROM sales_stores GROUP BY locality
        ORDER BY total_no_stores DESC NULLS FIRST, locality LIMIT 7"""),
    "sales_by_month": (sales.sales_by_month, "orders products dates", """
        SELECT month, CAST(sum(amount) AS DOUBLE) AS total_sales FROM sold JOIN raw_dates USING (date_uuid)
        GROUP BY month"""),
    "sales_by_month_first_sale": (sales.sales_by_month_first_sale, "orders products dates", """
        , placed AS (SELECT *, sum(amount) OVER (PARTITION BY month) AS month_total,
            row_number() OVER (PARTITION BY month ORDER BY product_code, date_uuid, product_quantity) AS place
          FROM sold JOIN raw_dates USING (date_uuid) WHERE month IS NOT NULL)
        SELECT product_quantity, product_code, date_uuid, month, CAST(price AS DOUBLE) AS product_price,
          CAST(amount AS DOUBLE) AS total_price, CAST(month_total AS DOUBLE) AS total_sales
        FROM placed WHERE place = 1"""),
    "web_vs_offline": (sales.web_vs_offline, "orders stores", """
        SELECT if(coalesce(store_type = 'Web Portal', false), 'Web', 'Offline') AS location,
          count(DISTINCT date_uuid) AS numbers_of_sales,
          CAST(sum(product_quantity) AS BIGINT) AS product_quantity_count
        FROM fact JOIN sales_stores USING (store_code) GROUP BY location"""),
    "store_type_share": (sales.store_type_share, "orders products stores", """
        , by_type AS (SELECT store_type, sum(amount) AS total FROM sold JOIN sales_stores USING (store_code)
                      GROUP BY store_type)
        SELECT store_type, CAST(total AS DOUBLE) AS total_sales,
          CAST(total AS DOUBLE) / CAST((SELECT sum(total) FROM by_type) AS DOUBLE) * 100 AS sales_percentage
        FROM by_type"""),
    "top_year_months": (sales.top_year_months, "orders products dates", """
        SELECT year, month, CAST(sum(amount) AS DOUBLE) AS total_sales FROM sold JOIN raw_dates USING (date_uuid)
        GROUP BY year, month ORDER BY total_sales DESC NULLS FIRST, year, month LIMIT 10"""),
    "staff_per_country": (sales.staff_per_country, "stores", """
        SELECT country_code, CAST(sum(staff_numbers) AS BIGINT) AS total_staff_numbers FROM sales_stores
        GROUP BY country_code"""),
    "country_sales_by_store_type": (sales.country_sales_by_store_type, "orders products stores", """
        SELECT store_type, country_code, CAST(sum(amount) AS DOUBLE) AS total_sales
        FROM sold JOIN sales_stores USING (store_code) WHERE country_code = 'DE' GROUP BY store_type, country_code"""),
    "sale_gap_by_year": (sales.sale_gap_by_year, "orders dates", "SELECT sale_year, mean_gap_us FROM mean_gaps"),
    "sale_gap_by_year_window": (sales.sale_gap_by_year_window, "orders dates", "SELECT sale_year, mean_gap_us FROM mean_gaps"),
    "next_sale_moments": (lambda t: printable(sales.next_sale_moments(t), "next_at", "gap_us"), "orders dates", """
        , sold_at AS (SELECT DISTINCT year, ts FROM fact JOIN moments USING (date_uuid))
        SELECT CAST(year(ts) AS INTEGER) AS sale_year, epoch_us(ts) AS at,
          CAST(epoch_us(lead(ts) OVER same_year) AS VARCHAR) AS next_at,
          CAST(epoch_us(lead(ts) OVER same_year) - epoch_us(ts) AS VARCHAR) AS gap_us
        FROM sold_at WINDOW same_year AS (PARTITION BY year ORDER BY ts)"""),
    "sale_gap_formatted": (sales.sale_gap_formatted, "orders dates", """
        , texts AS (SELECT sale_year, printf('%02d:%02d:%02d.%03d', mean_gap_us // 3600000000,
            mean_gap_us % 3600000000 // 60000000, mean_gap_us % 60000000 // 1000000,
            mean_gap_us % 1000000 // 1000) AS actual_time_taken FROM mean_gaps)
        SELECT sale_year, actual_time_taken, regexp_split_to_array(actual_time_taken, '[:.]')[1] AS h,
          regexp_split_to_array(actual_time_taken, '[:.]')[2] AS m,
          regexp_split_to_array(actual_time_taken, '[:.]')[3] AS s,
          regexp_split_to_array(actual_time_taken, '[:.]')[4] AS ms
        FROM texts ORDER BY actual_time_taken DESC NULLS FIRST, sale_year LIMIT 5"""),
}

for _name, (_question, _needed, _oracle) in SALES.items():
    register(_name, _oracle)(
        lambda spark, sf, q=_question, needed=_needed.split(): q(loaded(spark, sf, *needed))
    )


@register("store_share_report", """
    , by_type AS (SELECT store_type, CAST(sum(amount) AS DOUBLE) AS total FROM sold JOIN sales_stores USING (store_code)
                  GROUP BY store_type)
    SELECT store_type, printf('%.2f', total) AS total_sales,
      printf('%.2f', total / (SELECT CAST(sum(amount) AS DOUBLE) FROM sold) * 100) AS sales_percentage FROM by_type""")
def store_share_report(spark, sf):
    return report(sales.store_type_share(loaded(spark, sf, "orders", "products", "stores")))


# --- Column operators --------------------------------------------------------

@register("weights_to_kg", """
    SELECT product_code, r.weight AS raw_weight, c.weight FROM clean_weights c JOIN raw_products r USING (product_code)""")
def weights_to_kg(spark, sf):
    weights = raw(spark, sf, "products").select("product_code", "weight", F.col("weight").alias("raw_weight"))
    return convert_weights(weights)


@register("weight_class", """
    , sized AS (SELECT p_partkey, CAST(p_size AS DOUBLE) * 4 AS kg FROM part)
    SELECT p_partkey, kg, class_name AS weight_class FROM sized LEFT JOIN weight_limits ON kg >= from_kg AND kg < to_kg""")
def weight_classes(spark, sf):
    sized = fx.table(spark, sf, "part").select("p_partkey", (F.col("p_size").cast("double") * 4).alias("kg"))
    return sized.withColumn("weight_class", weight_class(F.col("kg")))


@register("parse_dates", """
    SELECT u.user_uuid, u.date_of_birth AS dob_text, CAST(p.dob AS VARCHAR) AS dob, u.join_date AS join_text,
      CAST(p.joined AS VARCHAR) AS joined
    FROM raw_users u JOIN parsed_users p USING (user_uuid)""")
def parse_dates(spark, sf):
    return printable(raw(spark, sf, "users").select(
        "user_uuid",
        F.col("date_of_birth").alias("dob_text"), parse_date(F.col("date_of_birth")).alias("dob"),
        F.col("join_date").alias("join_text"), parse_date(F.col("join_date")).alias("joined"),
    ))


@register("strict_numbers", """
    SELECT product_code, product_price AS price_text, TRY_CAST(replace(product_price, '£', '') AS DOUBLE) AS price
    FROM raw_products""")
def strict_numbers(spark, sf):
    text = F.replace("product_price", F.lit("£"), F.lit(""))
    return raw(spark, sf, "products").select(
        "product_code", F.col("product_price").alias("price_text"), strict_double(text).alias("price")
    )


@register("staff_digits", """
    SELECT store_code, staff_numbers AS staff_text, coalesce(staff.n, -1) AS staff_numbers
    FROM raw_stores, LATERAL (
      SELECT TRY_CAST(nullif(regexp_replace(staff_numbers, '[^0-9]', '', 'g'), '') AS BIGINT) AS n) staff""")
def staff_digits(spark, sf):
    staff = F.coalesce(digits_only(F.col("staff_numbers")), F.lit(-1).cast("bigint"))
    return raw(spark, sf, "stores").select(
        "store_code", F.col("staff_numbers").alias("staff_text"), staff.alias("staff_numbers")
    )


@register("merge_latitude", "SELECT store_code, latitude, longitude FROM typed_stores")
def merge_latitude(spark, sf):
    return star_tables({"stores": raw(spark, sf, "stores")})["stores"].select(
        "store_code", "latitude", "longitude"
    )


@register("availability_flag", "SELECT product_code, still_available FROM typed_products")
def availability_flag(spark, sf):
    return star_tables({"products": raw(spark, sf, "products")})["products"].select(
        "product_code", "still_available"
    )


# --- Cleaning, typing, quarantine --------------------------------------------

SHOWN_AS_TEXT = {
    "users": ["date_of_birth", "join_date"], "cards": ["date_payment_confirmed"],
    "stores": ["opening_date", "staff_numbers"], "products": ["date_added"], "orders": [], "dates": [],
}

for _table in RAW:
    _columns = _text(*SHOWN_AS_TEXT[_table]) if SHOWN_AS_TEXT[_table] else "*"
    register(f"clean_{_table}", f"SELECT {_columns} FROM clean_{_table}")(
        lambda spark, sf, t=_table: printable(CLEANERS[t](raw(spark, sf, t)), *SHOWN_AS_TEXT[t])
    )
    register(f"typed_{_table}", f"SELECT {_columns} FROM typed_{_table}")(
        lambda spark, sf, t=_table: printable(star_tables({t: raw(spark, sf, t)})[t], *SHOWN_AS_TEXT[t])
    )


# --- Keys and profiles -------------------------------------------------------

@register("pk_violations", """
    , keys AS (
      SELECT 'dim_users' AS table_name, 'user_uuid' AS key_column, user_uuid AS key_value FROM doubled_users
      UNION ALL SELECT 'dim_store_details', 'store_code', store_code FROM typed_stores
      UNION ALL SELECT 'dim_products', 'product_code', product_code FROM typed_products
      UNION ALL SELECT 'dim_date_times', 'date_uuid', date_uuid FROM typed_dates
      UNION ALL SELECT 'dim_card_details', 'card_number', card_number FROM doubled_cards)
    SELECT table_name, key_column, key_value, count(*) AS row_count FROM keys
    GROUP BY ALL HAVING count(*) > 1 OR key_value IS NULL""")
def pk_report(spark, sf):
    """With German users in twice, and cards of unreadable payment again without number, to find."""
    tables = star_tables(raw_tables(spark, sf, "users", "cards", "stores", "products", "dates"))
    users, cards = tables["users"], tables["cards"]
    again = users.where(F.col("country_code") == "DE")
    unpaid = cards.where(F.col("date_payment_confirmed").isNull())
    unkeyed = unpaid.withColumn("card_number", F.lit(None).cast("string"))
    return pk_violations({**tables, "users": users.unionByName(again), "cards": cards.unionByName(unkeyed)})


@register("fk_orphans", """
    , checks AS (
      SELECT 'user_uuid' AS key_column, 'dim_users' AS table_name, user_uuid AS k FROM typed_orders ANTI JOIN typed_users USING (user_uuid)
      UNION ALL SELECT 'store_code', 'dim_store_details', store_code FROM typed_orders ANTI JOIN typed_stores USING (store_code)
      UNION ALL SELECT 'product_code', 'dim_products', product_code FROM typed_orders ANTI JOIN typed_products USING (product_code)
      UNION ALL SELECT 'date_uuid', 'dim_date_times', date_uuid FROM typed_orders ANTI JOIN typed_dates USING (date_uuid)
      UNION ALL SELECT 'card_number', 'dim_card_details', card_number FROM typed_orders ANTI JOIN typed_cards USING (card_number))
    SELECT key_column, table_name, count(DISTINCT k) AS orphan_keys, count(k) AS orphan_rows FROM checks
    GROUP BY key_column, table_name""")
def fk_report(spark, sf):
    """The small tables are landed, as stored ones know their sizes; the large ones only pass through."""
    small = raw_tables(spark, sf, "users", "cards", "stores", "products")
    return fk_orphans(star_tables(small | raw_once(spark, sf, "dates", "orders", source=fx.table)))


@register("max_lengths", """
    SELECT 'orders_table' AS table_name, unnest(['card_number', 'store_code', 'product_code']) AS column_name,
      unnest([max(length(card_number)), max(length(store_code)), max(length(product_code))]) AS max_length FROM typed_orders
    UNION ALL SELECT 'dim_users', 'country_code', max(length(country_code)) FROM typed_users
    UNION ALL SELECT 'dim_store_details', unnest(['store_code', 'country_code']),
      unnest([max(length(store_code)), max(length(country_code))]) FROM typed_stores
    UNION ALL SELECT 'dim_products', unnest(['ean', 'product_code', 'weight_class']),
      unnest([max(length(ean)), max(length(product_code)), max(length(weight_class))]) FROM typed_products
    UNION ALL SELECT 'dim_date_times', unnest(['month', 'year', 'day', 'time_period']),
      unnest([max(length(month)), max(length(year)), max(length(day)), max(length(time_period))]) FROM typed_dates
    UNION ALL SELECT 'dim_card_details', unnest(['card_number', 'expiry_date']),
      unnest([max(length(card_number)), max(length(expiry_date))]) FROM typed_cards""")
def longest_texts(spark, sf):
    union = None
    for t, df in star_tables(raw_tables(spark, sf)).items():
        spec = STAR[t]
        one = max_lengths(df, list(spec.measured)).withColumn("table_name", F.lit(spec.name))
        union = one if union is None else union.unionByName(one)
    return union


@register("profile_table", """
    SELECT unnest(['product_code', 'product_price', 'weight', 'ean', 'date_added', 'removed', 'uuid']) AS column_name,
      unnest([count(product_code), count(product_price), count(weight), count(ean), count(date_added),
              count(removed), count(uuid)]) AS non_null,
      unnest(['string', 'double', 'double', 'string', 'date', 'string', 'string']) AS data_type
    FROM clean_products""")
def profile_table(spark, sf):
    return profile(CLEANERS["products"](raw(spark, sf, "products")))


@register("indexed_rows", """
    SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS "index", o_orderkey, o_orderstatus FROM orders""")
def indexed_rows(spark, sf):
    orders = fx.table(spark, sf, "orders").select("o_orderdate", "o_orderkey", "o_orderstatus")
    return with_index(orders, "o_orderdate", "o_orderkey").select("index", "o_orderkey", "o_orderstatus")


# --- Sources and sinks -------------------------------------------------------

@register("scan_csv", """
    SELECT product_code, product_price, weight, EAN, date_added, removed, uuid FROM raw_products""")
def scan_csv(spark, sf):
    path = scratch_path(spark, "products") + ".csv"
    raw(spark, sf, "products").write.option("header", True).csv(path)
    return load(spark, path, RAW_SCHEMAS["products"])


@register("scan_json_lines", f"""
    SELECT {', '.join(RAW_SCHEMAS['stores'].fieldNames())} FROM raw_stores""")
def scan_json_lines(spark, sf):
    path = scratch_path(spark, "stores") + ".jsonl"
    raw(spark, sf, "stores").write.json(path)
    return read_stores(spark, path, RAW_SCHEMAS["stores"])


@register("scan_json_columns", """
    SELECT timestamp, month, year, day, time_period, date_uuid FROM raw_dates""")
def scan_json_columns(spark, sf):
    """Date rows written as column-oriented documents of up to 4,096 rows, one per line."""
    path = scratch_path(spark, "dates") + ".json"
    _date_documents(spark, sf, 4096).select("value").write.text(path)
    return read_json_columns(spark, path, RAW_SCHEMAS["dates"], one_per_line=True)


def _date_documents(spark, sf, rows):
    """doc and value: date rows as column-oriented documents of up to `rows` rows."""
    names = RAW_SCHEMAS["dates"].fieldNames()
    grouped = fx.raw_dates(spark, sf, "o_orderkey").groupBy((F.col("o_orderkey") / rows).cast("bigint").alias("doc")).agg(
        F.array_sort(F.collect_list(F.struct("o_orderkey", *names))).alias("rows")
    )
    columns = [F.map_from_arrays(F.col("rows.o_orderkey").cast("array<string>"), F.col(f"rows.{n}")).alias(n) for n in names]
    return grouped.select("doc", F.to_json(F.struct(*columns)).alias("value"))


#: Rows of one column that stand on a line of a long document.
LINE_ROWS = 1024


def _long_date_documents(spark, sf, rows):
    """doc and value: the documents of `_date_documents` in lines of up to `LINE_ROWS` rows of a
    column, those of a document together and in order, so that no task holds a document whole."""
    names = RAW_SCHEMAS["dates"].fieldNames()

    def dealt_out(spark, sf, name):
        """Rows of a document together, about eight documents to a task."""
        orders = fx.table(spark, sf, name)
        tasks = max(spark.sparkContext.defaultParallelism, orders.count() // (8 * rows))
        return orders.withColumn("doc", (F.col("o_orderkey") / rows).cast("bigint")).repartition(tasks, "doc")

    part = (F.col("o_orderkey") / LINE_ROWS).cast("bigint")
    parts = fx.raw_dates(spark, sf, "o_orderkey", "doc", source=dealt_out).groupBy("doc", part.alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("o_orderkey", *names))).alias("rows")
    )
    cells = [F.to_json(F.map_from_arrays(F.col("rows.o_orderkey").cast("array<string>"), F.col(f"rows.{n}"))) for n in names]
    lines = parts.select("doc", "part", F.posexplode(F.array(*cells)).alias("place", "cells"))
    in_order = Window.partitionBy("doc").orderBy("place", "part")
    lines = lines.withColumns({"last": F.lag("place").over(in_order), "next": F.lead("place").over(in_order)})
    begins = F.array(*(F.lit(f'{"," if i else "{"}"{n}":{{') for i, n in enumerate(names)))[F.col("place")]
    value = F.concat(
        F.when(F.col("last") == F.col("place"), ",").otherwise(begins),
        F.expr("substring(cells, 2, length(cells) - 2)"),
        F.when(F.col("next") == F.col("place"), "").when(F.col("next").isNotNull(), "}").otherwise("}}"),
    )
    return lines.sortWithinPartitions("doc", "place", "part").select("doc", value.alias("value"))


@register("scan_json_ranges", """
    SELECT timestamp, month, year, day, time_period, date_uuid FROM raw_dates""")
def scan_json_ranges(spark, sf):
    """Date rows written as documents of up to 32,768 rows, a file each, and read by ranges."""
    path = scratch_path(spark, "dates")
    _long_date_documents(spark, sf, 32768).write.partitionBy("doc").text(path)
    return read_json_columns(spark, path, RAW_SCHEMAS["dates"], large_file=1)


@register("paged_union", """
    SELECT card_number, expiry_date, CASE WHEN card_number LIKE '??%' THEN NULL ELSE date_payment_confirmed END
      AS date_payment_confirmed FROM raw_cards""")
def paged_union(spark, sf):
    """Cards on two kinds of pages, one of which has no payment column."""
    cards, path = raw(spark, sf, "cards"), scratch_path(spark, "cards")
    noisy = F.col("card_number").startswith("??")
    cards.where(noisy).drop("date_payment_confirmed").write.parquet(f"{path}/page=1")
    cards.where(~noisy).write.parquet(f"{path}/page=2")
    return read_pages(spark, path, RAW_SCHEMAS["cards"])


@register("json_scalar", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def json_scalar(spark, sf):
    return fx.table(spark, sf, "events").select("event_id", scalar(F.col("props"), "k").cast("bigint").alias("k"))


@register("write_overwrite", "SELECT * FROM typed_dates")
def write_overwrite(spark, sf):
    """Written twice over; the second write replaces the first."""
    registry = SourceRegistry({"shop": {"format": "parquet", "path": scratch_path(spark, "sink")}})
    dates = star_tables({"dates": raw(spark, sf, "dates")})["dates"]
    write_table(dates.select("date_uuid"), registry, "shop", "dim_date_times")
    write_table(dates, registry, "shop", "dim_date_times")
    return read_table(spark, registry, "shop", "dim_date_times")


@register("star_store_type_share", """
    , amounts AS (SELECT store_type, CAST(product_price AS DECIMAL(18, 2)) * product_quantity AS amount
        FROM typed_orders JOIN typed_products USING (product_code) JOIN typed_stores USING (store_code)),
    by_type AS (SELECT store_type, CAST(sum(amount) AS DOUBLE) AS total_sales FROM amounts GROUP BY store_type)
    SELECT store_type, total_sales,
      total_sales / (SELECT CAST(sum(amount) AS DOUBLE) FROM amounts) * 100 AS sales_percentage FROM by_type""")
def star_store_type_share(spark, sf):
    """End to end: raw tables cleaned, typed, written, and a sales question asked of what was written."""
    tables = raw_once(spark, sf, "orders", "products", "stores")
    return sales.store_type_share(build_warehouse(spark, tables, scratch_path(spark, "star")).tables)


from . import job, traps  # noqa: E402, F401  they enter their queries as well
