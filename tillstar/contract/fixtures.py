"""Raw and ready retail tables derived from the given TPC-H-like tables.

The raw tables carry the dirt the cleaners are for: junk dates, missing values,
wrong spellings, mixed units. `oracle.py` states the same derivations in SQL.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import digits_only
from ..operators.joins import broadcastable, lookup

DATE_TEXTS = ["yyyy-MM-dd", "yyyy MMMM dd", "MMMM yyyy dd", "yyyy/MM/dd"]


# Stated, so that opening a table costs no look into its files.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str, *_by: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def even_table(spark: SparkSession, sf_dir: str, name: str, *by: str) -> DataFrame:
    """`table` in even partitions, whatever the splits of its files; rows alike in `by` stay together.

    Only the columns that are used later move, and before any text is made of them.
    """
    return table(spark, sf_dir, name).hint("rebalance", *by)


def uuid_of(prefix: str, key: Column) -> Column:
    h = F.md5(F.concat(F.lit(prefix), key.cast("string")))
    return F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-")


def code_of(prefix: str, key: Column, width: int = 0) -> Column:
    text = key.cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, width, "0") if width else text)


def dirty_date(start: str, days: Column, layout: Column, junk: Column) -> Column:
    day = F.date_add(F.to_date(F.lit(start)), days.cast("int"))
    first, *rest = DATE_TEXTS
    text = F.when(layout % 4 == 0, F.date_format(day, first))
    for i, pattern in enumerate(rest, 1):
        text = text.when(layout % 4 == i, F.date_format(day, pattern))
    return F.when(junk, "JUNK").otherwise(text)


def nations(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    """Nations keyed as `key`; 25 rows at any scale, so always fit to broadcast."""
    return F.broadcast(table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", key))


def raw_users(spark: SparkSession, sf_dir: str, source=table) -> DataFrame:
    k, region = F.col("c_custkey"), F.col("n_regionkey")
    uuid = uuid_of("u", k)
    country = F.when(region == 1, "United States").when(region == 2, "United Kingdom")
    code = F.when(region == 1, "US").when(region == 2, F.when(k % 3 == 0, "GGB").otherwise("GB"))
    return source(spark, sf_dir, "customer").join(nations(spark, sf_dir, "c_nationkey"), "c_nationkey").select(
        F.lit("Customer").alias("first_name"),
        F.substring("c_name", 10, 1000).alias("last_name"),
        dirty_date("1950-01-01", k * 37 % 18000, k, k % 97 == 0).alias("date_of_birth"),
        F.when(k % 17 != 0, F.col("c_mktsegment")).alias("company"),
        country.when(region == 3, "Germany").otherwise("JUNK").alias("country"),
        code.when(region == 3, "DE").otherwise("XX").alias("country_code"),
        F.when(k % 2 == 0, F.upper(uuid)).otherwise(uuid).alias("user_uuid"),
        dirty_date("1995-01-01", k * 13 % 9000, k + 1, (k + 1) % 89 == 0).alias("join_date"),
    )


def raw_cards(spark: SparkSession, sf_dir: str, source=table) -> DataFrame:
    k = F.col("c_custkey")
    number = (F.lit(4_000_000_000_000_000) + k).cast("string")
    expiry = F.concat(F.lpad((k % 12 + 1).cast("string"), 2, "0"), F.lit("/"), (k % 6 + 24).cast("string"))
    paid = dirty_date("2000-01-01", k * 11 % 8000, k, k % 101 == 0)
    return source(spark, sf_dir, "customer").select(
        F.when(k % 9 == 0, F.concat(F.lit("??"), number)).otherwise(number).alias("card_number"),
        F.when(k % 23 == 0, "JUNK").otherwise(expiry).alias("expiry_date"),
        F.when(k % 31 != 0, paid).alias("date_payment_confirmed"),
    )


def raw_stores(spark: SparkSession, sf_dir: str, source=table) -> DataFrame:
    k, region = F.col("s_suppkey"), F.col("n_regionkey")
    staff = (k % 50 + 1).cast("string")
    kind = F.when(k % 5 == 0, "Web Portal").when(k % 5 == 1, "Local").when(k % 5 == 2, "Super Store")
    return source(spark, sf_dir, "supplier").join(nations(spark, sf_dir, "s_nationkey"), "s_nationkey").select(
        code_of("ST-", k, 8).alias("store_code"),
        F.when(region == 3, "DE").when(region == 1, "US").when(region == 2, "GB")
        .otherwise("XX").alias("country_code"),
        F.col("n_name").alias("locality"),
        kind.when(k % 5 == 3, "Mall Kiosk").alias("store_type"),
        F.when(k % 11 == 0, F.concat(F.lit("J"), staff, F.lit("e"))).when(k % 29 == 1, "")
        .otherwise(staff).alias("staff_numbers"),
        F.when(k % 7 == 0, "eeEurope").otherwise("Europe").alias("continent"),
        F.when((k % 5 != 0) & (k % 2 == 0), (k % 90 + 0.5).cast("string")).alias("latitude"),
        F.when(k % 5 == 0, "N/A").when(k % 2 == 1, (k % 90 + 0.25).cast("string")).alias("lat"),
        F.when(k % 5 == 0, "N/A").otherwise((k % 180 - 90.5).cast("string")).alias("longitude"),
        dirty_date("1990-01-01", k * 31 % 10000, k, k % 53 == 0).alias("opening_date"),
    )


def raw_products(spark: SparkSession, sf_dir: str, source=table) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size").cast("string")
    units = ["kg", "g", "g", "ml", "oz", "g ."]
    weight = F.when(k % 7 == 0, F.concat(size, F.lit(units[0])))
    for i, unit in enumerate(units[1:], 1):
        text = F.concat(F.lit("3 x "), size) if i == 2 else size
        weight = weight.when(k % 7 == i, F.concat(text, F.lit(unit)))
    state = F.when(k % 10 == 0, "JUNK").when(k % 3 == 0, "Still_avaliable").when(k % 3 == 1, "Removed")
    price = F.concat(F.lit("£"), F.col("p_retailprice").cast("string"))
    return source(spark, sf_dir, "part").select(
        code_of("P-", k).alias("product_code"),
        F.when(k % 41 == 0, "JUNK").otherwise(price).alias("product_price"),
        weight.otherwise("JUNK").alias("weight"),
        (F.lit(5_000_000_000_000) + k).cast("string").alias("EAN"),
        dirty_date("2005-01-01", k * 3 % 5000, k, k % 103 == 0).alias("date_added"),
        state.otherwise("Still_available").alias("removed"),
        uuid_of("p", k).alias("uuid"),
    )


def raw_dates(spark: SparkSession, sf_dir: str, *keep: str, source=table) -> DataFrame:
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    second = k * 7919 % 86400
    parts = [second / 3600, second / 60 % 60, second % 60]
    clock = F.format_string("%02d:%02d:%02d", *(p.cast("bigint") for p in parts))
    period = F.when(k % 37 == 0, "JUNK").when(second < 21600, "Late_Hours").when(second < 43200, "Morning")
    return source(spark, sf_dir, "orders").select(
        clock.alias("timestamp"),
        F.month(day).cast("string").alias("month"),
        F.year(day).cast("string").alias("year"),
        F.dayofmonth(day).cast("string").alias("day"),
        period.when(second < 64800, "Midday").otherwise("Evening").alias("time_period"),
        uuid_of("d", k).alias("date_uuid"),
        *keep,
    )


def _fact(lines: DataFrame) -> dict[str, Column]:
    return {
        "date_uuid": uuid_of("d", F.col("l_orderkey")),
        "store_code": code_of("ST-", F.col("l_suppkey"), 8),
        "product_code": code_of("P-", F.col("l_partkey")),
        "product_quantity": F.col("l_quantity").cast("smallint"),
    }


def _side_by_side(lines: DataFrame) -> DataFrame:
    """Lines in the order of their orders, in each partition: repeated keys take few bytes."""
    return lines.sortWithinPartitions("l_orderkey")


def raw_orders(spark: SparkSession, sf_dir: str, source=table) -> DataFrame:
    """The whole fact. Needs the orders table for the customer behind user and card."""
    buyers = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    # A join that shuffles deals the lines out by itself.
    lines = source(spark, sf_dir, "lineitem", "l_orderkey") if broadcastable(buyers) else table(spark, sf_dir, "lineitem")
    lines = lines.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    customer = F.col("o_custkey")
    return _side_by_side(lookup(lines, buyers, "l_orderkey")).select(
        uuid_of("u", customer).alias("user_uuid"),
        (F.lit(4_000_000_000_000_000) + customer).alias("card_number"),
        F.lit(None).cast("string").alias("1"),
        F.lit("Customer").alias("first_name"),
        F.lit("Customer").alias("last_name"),
        *(c.alias(n) for n, c in _fact(lines).items()),
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    makers = {
        "users": raw_users, "cards": raw_cards, "stores": raw_stores,
        "products": raw_products, "dates": raw_dates, "orders": raw_orders,
    }
    return {name: make(spark, sf_dir) for name, make in makers.items()}


def sales_fact(spark: SparkSession, sf_dir: str, source=table) -> DataFrame:
    """The fact without user and card, which no sales question asks for, so without a join."""
    lines = source(spark, sf_dir, "lineitem", "l_orderkey").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    return _side_by_side(lines).select(*(c.alias(n) for n, c in _fact(lines).items()))


def sales_products(spark: SparkSession, sf_dir: str, source=table) -> DataFrame:
    return source(spark, sf_dir, "part").select(
        code_of("P-", F.col("p_partkey")).alias("product_code"),
        F.col("p_retailprice").alias("product_price"),
    )


def sales_stores(spark: SparkSession, sf_dir: str, source=table) -> DataFrame:
    staff = digits_only(F.col("staff_numbers")).cast("smallint")
    return raw_stores(spark, sf_dir, source).withColumn("staff_numbers", staff)
