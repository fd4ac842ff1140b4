"""Queries on the whole job: the star of all six tables, what it reports, the nine questions."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import quarantine
from ..operators.typing import STAR
from ..plans import sales
from ..plans.run import QUESTIONS, answers
from ..plans.warehouse import Warehouse, build_warehouse, reject_counts
from ..session import scratch_path
from ..sources import list_tables
from ..sources.tables import read_table
from . import fixtures as fx
from .landing import raw, raw_once, raw_tables
from .oracle import over_star
from .queries import SALES
from .registry import register

_BUILT: dict[tuple, Warehouse] = {}


def star(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The star of all raw tables, built and written once a session, as any job would find it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BUILT:
        _BUILT[key] = build_warehouse(spark, raw_once(spark, sf_dir), scratch_path(spark, "star")).store_reports()
    return _BUILT[key]


def again(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    registry = star(spark, sf_dir).registry
    return {t: read_table(spark, registry, "star", spec.name) for t, spec in STAR.items()}


_SAME = {
    "Stores per country": "stores_per_country", "Localities with most stores": "top_localities", "Sales by month": "sales_by_month",
    "Web and offline": "web_vs_offline", "Share of each store type": "store_type_share", "Best months": "top_year_months",
    "Staff per country": "staff_per_country", "German sales by store type": "country_sales_by_store_type",
    "Time between sales": "sale_gap_formatted",
}
for _title in QUESTIONS:
    if _SAME[_title] == "store_type_share":
        continue  # star_store_type_share builds the tables it needs itself
    register(f"star_{_SAME[_title]}", over_star(SALES[_SAME[_title]][2]))(
        lambda spark, sf, title=_title: answers(again(spark, sf))[title]
    )
register("star_sales_by_month_first_sale", over_star(SALES["sales_by_month_first_sale"][2]))(
    lambda spark, sf: sales.sales_by_month_first_sale(again(spark, sf))
)

# Columns of the star: type after cleaning, and in the star.
TYPES = {
    "orders_table": {
        "date_uuid": ("string", "string"), "user_uuid": ("string", "string"), "card_number": ("string", "string"),
        "store_code": ("string", "string"), "product_code": ("string", "string"), "product_quantity": ("smallint", "smallint"),
    },
    "dim_users": {
        "first_name": ("string", "string"), "last_name": ("string", "string"), "date_of_birth": ("date", "date"), "country_code": ("string", "string"),
        "user_uuid": ("string", "string"), "join_date": ("date", "date"), "company": ("string", "string"), "country": ("string", "string"),
    },
    "dim_store_details": {
        "longitude": ("string", "double"), "locality": ("string", "string"), "store_code": ("string", "string"), "staff_numbers": ("bigint", "smallint"),
        "opening_date": ("date", "date"), "store_type": ("string", "string"), "latitude": ("string", "double"), "country_code": ("string", "string"), "continent": ("string", "string"),
    },
    "dim_products": {
        "product_price": ("double", "double"), "weight": ("double", "double"), "ean": ("string", "string"), "product_code": ("string", "string"),
        "date_added": ("date", "date"), "uuid": ("string", "string"), "still_available": (None, "boolean"), "weight_class": (None, "string"),
    },
    "dim_date_times": {
        "month": ("string", "string"), "year": ("string", "string"), "day": ("string", "string"), "time_period": ("string", "string"),
        "date_uuid": ("string", "string"), "timestamp": ("string", "string"),
    },
    "dim_card_details": {"card_number": ("string", "string"), "expiry_date": ("string", "string"), "date_payment_confirmed": ("date", "date")},
}


def _quoted(text: str | None) -> str:
    return "CAST(NULL AS VARCHAR)" if text is None else f"'{text}'"


register("star_types", "SELECT * FROM (VALUES " + ", ".join(
    f"('{t}', '{c}', {_quoted(old)}, '{new}', true)" for t, columns in TYPES.items() for c, (old, new) in columns.items()
) + ") types(table_name, column_name, old_type, new_type, nullable)")(lambda spark, sf: star(spark, sf).types)

register("profile_star", " UNION ALL ".join(
    f"SELECT '{spec.name}' AS table_name, unnest([{', '.join(repr(c) for c in TYPES[spec.name])}]) AS column_name, "
    f"unnest([{', '.join(f'count({c})' for c in TYPES[spec.name])}]) AS non_null, "
    f"unnest([{', '.join(repr(new) for _, new in TYPES[spec.name].values())}]) AS data_type FROM typed_{t}"
    for t, spec in STAR.items()
))(lambda spark, sf: star(spark, sf).profile())

_TABLES = [*(spec.name for spec in STAR.values()), *(f"rejects_{t}" for t in STAR), "pk_violations", "fk_orphans"]


@register("listed_tables", f"SELECT unnest([{', '.join(repr(t) for t in _TABLES)}]) AS table_name")
def listed_tables(spark, sf):
    names = list_tables(spark, registry=star(spark, sf).registry, source="star")
    return spark.createDataFrame([(n,) for n in names], "table_name string")


# --- Rejects ------------------------------------------------------------------

JUNK_ORDERS = """junk_orders AS (
      SELECT *,
        CASE WHEN card_number % 101 = 0 THEN 'JUNK' WHEN card_number % 7 = 0 THEN '{' || upper(date_uuid) || '}' ELSE date_uuid END AS date_text,
        CASE WHEN card_number % 103 = 0 THEN 40000 WHEN card_number % 5 = 0 THEN NULL ELSE product_quantity END AS quantity
      FROM raw_orders)"""
JUNK_STORES = """junk_stores AS (
      SELECT *, CASE WHEN latitude IS NOT NULL THEN 'abc' ELSE lat END AS place,
        CASE WHEN store_code LIKE '%3' THEN '4000' || staff_numbers || 'x' ELSE staff_numbers END AS staff
      FROM raw_stores)"""


def junk_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of which some have keys or quantities that typing can't read, and some odd but good ones."""
    card, key = F.col("card_number"), F.col("date_uuid")
    braced = F.concat(F.lit("{"), F.upper(key), F.lit("}"))
    return raw(spark, sf_dir, "orders").withColumns({
        "date_uuid": F.when(card % 101 == 0, "JUNK").when(card % 7 == 0, braced).otherwise(key),
        "product_quantity": F.when(card % 103 == 0, 40000).when(card % 5 != 0, F.col("product_quantity").cast("int")),
    })


def junk_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    many = F.concat(F.lit("4000"), "staff_numbers", F.lit("x"))
    return raw(spark, sf_dir, "stores").withColumns({
        "latitude": F.when(F.col("latitude").isNotNull(), "abc"),
        "staff_numbers": F.when(F.col("store_code").endswith("3"), many).otherwise(F.col("staff_numbers")),
    })


@register("quarantine_counts", f"""
    , {JUNK_ORDERS}, {JUNK_STORES}, reasons AS (
      SELECT 'users' AS table_name, unnest(reasons) AS reason FROM rejected_users
      UNION ALL SELECT 'cards', unnest(reasons) FROM rejected_cards
      UNION ALL SELECT 'stores', unnest(reasons) FROM (
        SELECT list_concat(
          [CASE WHEN country_code = 'XX' THEN 'country_code not served' END,
           CASE WHEN opening_date = 'JUNK' THEN 'opening_date unreadable' END,
           CASE WHEN staff = '' THEN 'staff_numbers unreadable' END],
          [CASE WHEN CAST(nullif(regexp_replace(staff, '[^0-9]', '', 'g'), '') AS BIGINT) > 32767 THEN 'staff_numbers too large' END,
           CASE WHEN place = 'abc' OR place = 'abcN/A' THEN 'latitude unreadable' END]) AS reasons FROM junk_stores)
      UNION ALL SELECT 'products', unnest(reasons) FROM rejected_products
      UNION ALL SELECT 'orders', unnest([CASE WHEN date_text = 'JUNK' THEN 'date_uuid no UUID' END,
        CASE WHEN quantity > 32767 THEN 'product_quantity no small whole number' END]) FROM junk_orders
      UNION ALL SELECT 'dates', unnest(reasons) FROM rejected_dates)
    SELECT table_name, reason, count(*) AS rows_rejected FROM reasons WHERE reason IS NOT NULL GROUP BY table_name, reason""")
def quarantine_counts(spark, sf):
    """All six tables, with keys, quantities, coordinates and head counts that typing can't read."""
    tables = raw_tables(spark, sf) | {"orders": junk_orders(spark, sf), "stores": junk_stores(spark, sf)}
    return reject_counts({t: quarantine(df, t) for t, df in tables.items()})


@register("unreadable_keys", f"""
    , {JUNK_ORDERS}
    SELECT store_code, count(*) FILTER (date_text = 'JUNK') AS lost_dates, count(*) FILTER (quantity > 32767) AS lost_quantities
    FROM junk_orders WHERE date_text = 'JUNK' OR quantity > 32767 GROUP BY store_code""")
def unreadable_keys(spark, sf):
    """The sales that no question can see, as their quarantine shows them."""
    lost = quarantine(junk_orders(spark, sf), "orders")
    has = lambda reason: F.count(F.when(F.array_contains("reject_reasons", reason), 1))
    return lost.groupBy("store_code").agg(
        has("date_uuid no UUID").alias("lost_dates"), has("product_quantity no small whole number").alias("lost_quantities")
    )


# --- Odd prices and hot keys ---------------------------------------------------

ODD_SOLD = """odd_prices AS (
      SELECT 'P-' || p_partkey AS product_code,
        CASE p_partkey % 50 WHEN 0 THEN CAST('0.125' AS DECIMAL(30, 6)) WHEN 1 THEN CAST('100000000000000000' AS DECIMAL(30, 6))
          ELSE CAST(CAST(p_retailprice AS DECIMAL(18, 2)) AS DECIMAL(30, 6)) END AS price FROM part),
    odd_sold AS (SELECT fact.*, price * product_quantity AS amount FROM fact JOIN odd_prices USING (product_code))"""


def odd_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products of which some cost an eighth and some a fortune."""
    k = F.col("p_partkey")
    price = F.when(k % 50 == 0, 0.125).when(k % 50 == 1, 1e17).otherwise(F.col("p_retailprice"))
    return fx.table(spark, sf_dir, "part").select(fx.code_of("P-", k).alias("product_code"), price.alias("product_price"))


@register("odd_prices", f"""
    , {ODD_SOLD}
    SELECT month, CAST(CAST(sum(amount) AS VARCHAR) AS DOUBLE) AS total_sales FROM odd_sold JOIN raw_dates USING (date_uuid) GROUP BY month
    UNION ALL
    SELECT 'small', CAST(CAST(sum(amount) AS VARCHAR) AS DOUBLE) FROM odd_sold WHERE amount < 1000000000""")
def odd_prices(spark, sf):
    from .landing import loaded

    tables = loaded(spark, sf, "orders", "dates") | {"products": odd_products(spark, sf)}
    every = sales.sales_by_month(tables)
    small = {**tables, "products": tables["products"].where("product_price < 1000000")}
    alone = sales.sales_by_month({**small, "dates": tables["dates"].withColumn("month", F.lit("small"))})
    return every.unionByName(alone)


SKEWED = """skewed AS (
      SELECT CASE WHEN product_quantity % 3 = 0 THEN (SELECT min(date_uuid) FROM raw_dates WHERE time_period <> 'JUNK') ELSE date_uuid END AS date_uuid,
        CASE WHEN product_quantity % 3 = 0 THEN 'ST-00000001' ELSE store_code END AS store_code,
        CASE WHEN product_quantity % 3 = 0 THEN 'P-1' ELSE product_code END AS product_code, product_quantity FROM fact),
    skewed_sold AS (SELECT skewed.*, price, price * product_quantity AS amount FROM skewed JOIN prices USING (product_code))"""


def _skewed(question):
    """The question over a fact with a third of its rows on one date, store and product, no
    table broadcast, and keys of over 500 rows shared out. Answered at once, as the
    settings are put back."""
    from ..operators import joins
    from .landing import loaded

    def query(spark, sf):
        tables = loaded(spark, sf, "orders", "products", "stores", "dates")
        date = tables["dates"].where("time_period <> 'JUNK'").agg(F.min("date_uuid")).scalar()
        hot = F.col("product_quantity") % 3 == 0
        fact = tables["orders"].select(
            F.when(hot, date).otherwise(F.col("date_uuid")).alias("date_uuid"),
            F.when(hot, "ST-00000001").otherwise(F.col("store_code")).alias("store_code"),
            F.when(hot, "P-1").otherwise(F.col("product_code")).alias("product_code"), "product_quantity",
        )
        name, before, per_task = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), joins.ROWS_PER_TASK
        path = scratch_path(spark, "skewed")
        try:
            spark.conf.set(name, "-1")
            joins.ROWS_PER_TASK = 500
            answer = question({**tables, "orders": fact})
            answer.write.parquet(path)
        finally:
            spark.conf.set(name, before)
            joins.ROWS_PER_TASK = per_task
        return spark.read.schema(answer.schema).parquet(path)

    return query


for _name in ("sales_by_month_first_sale", "web_vs_offline", "store_type_share"):
    _text = SALES[_name][2].replace("FROM sold", "FROM skewed_sold").replace("FROM fact", "FROM skewed").strip().removeprefix(",")
    _text = f", {SKEWED}, {_text}" if SALES[_name][2].strip().startswith(",") else f", {SKEWED} {_text}"
    register(f"skewed_{_name}", _text)(_skewed(SALES[_name][0]))


# --- The star answers through a registry of its own ---------------------------

@register("star_reject_counts", """
    , reasons AS (
      SELECT 'users' AS table_name, unnest(reasons) AS reason FROM rejected_users
      UNION ALL SELECT 'cards', unnest(reasons) FROM rejected_cards
      UNION ALL SELECT 'stores', unnest(reasons) FROM rejected_stores
      UNION ALL SELECT 'products', unnest(reasons) FROM rejected_products
      UNION ALL SELECT 'dates', unnest(reasons) FROM rejected_dates)
    SELECT table_name, reason, count(*) AS rows_rejected FROM reasons WHERE reason IS NOT NULL GROUP BY table_name, reason""")
def star_reject_counts(spark, sf):
    """Rejects as the job wrote them beside the star."""
    return star(spark, sf).reject_counts()


