"""The nine sales questions over the star schema.

Every function takes `tables`, a dict with the DataFrames it needs of `orders`
(the fact), `stores`, `products` and `dates`, and returns a lazy DataFrame.

Money is summed as whole pence (`scale` decimals) in bigint: exact in any order,
and free of per-row decimal arithmetic. Prices that are finer or very large are summed
beside it as decimals of six places, so none is rounded or left out. Descending order puts nulls first and
ascending order last; equal rows at a cut are settled by their key.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions import clock_text, mean_micros, sale_moment, split_clock, to_micros
from ..functions.numbers import MONEY
from ..operators.joins import broadcastable, lookup, sum_then_lookup
from ..operators.sequence import first_in_group, gap_totals, next_moment

Tables = dict[str, DataFrame]
SCALE = 2
#: Prices from here on are summed as wide decimals, so that no sum of units overflows.
LARGE_PRICE = 1_000_000_000


def _priced(products: DataFrame, scale: int) -> DataFrame:
    """product_code with its price: in whole units of the last decimal (`unit_price`), or,
    where it is too fine or too large for that, as a wide decimal (`odd_price`)."""
    price = F.col("product_price")
    whole = price.try_cast(f"decimal(18,{scale})")
    plain = (whole.cast("double") == price.cast("double")) & (F.abs(whole) < LARGE_PRICE)
    return products.select(
        "product_code",
        F.when(plain, (whole * 10**scale).cast("bigint")).alias("unit_price"),
        F.when(~F.coalesce(plain, F.lit(False)), price.try_cast(MONEY)).alias("odd_price"),
    )


def _units() -> list[Column]:
    """Amounts of sales: in whole units, and those at odd prices."""
    quantity = F.col("product_quantity")
    odd = F.when(F.col("odd_price").isNotNull(), F.col("odd_price") * quantity.cast("decimal(18,0)"))
    return [(F.col("unit_price") * quantity).alias("units"), odd.cast("decimal(38,6)").alias("odd")]


def _money(units: Column, odd: Column, scale: int) -> Column:
    """Units and odd amounts together as a number; exact until it becomes one."""
    in_units = units.cast("double") / 10**scale
    both = (units.cast("decimal(19,0)") / 10**scale).cast("decimal(38,6)") + odd
    return F.when(odd.isNull(), in_units).when(units.isNull(), odd.cast("double")).otherwise(both.cast("double"))


def _total(scale: int) -> Column:
    return _money(F.sum("units"), F.sum("odd"), scale)


def _sold_units(tables: Tables, dim: DataFrame, key: str, scale: int) -> DataFrame:
    """Sales as `units`, next to the columns of `dim`, at least as fine as those columns need.

    The dimension Spark can broadcast is joined first, so that the fact is summed
    down before it meets the one it has to shuffle for. Where both are large, `key` goes
    first: no more than its attributes move on to the prices.
    """
    attributes = [c for c in dim.columns if c != key]
    fact = tables["orders"].select("product_code", key, "product_quantity")
    prices = _priced(tables["products"], scale)
    if not broadcastable(prices):
        per_product = lookup(fact, dim, key).groupBy("product_code", *attributes).agg(
            F.sum("product_quantity").alias("product_quantity")
        )
        return per_product.join(prices, "product_code").select(*attributes, *_units())
    sold = fact.join(prices, "product_code").select(key, *_units())
    return sum_then_lookup(sold, dim, key, "units", "odd")


def stores_per_country(tables: Tables) -> DataFrame:
    """How many stores each country has."""
    counts = tables["stores"].groupBy("country_code").agg(
        F.count("country_code").alias("total_no_stores")
    )
    return counts.orderBy(F.desc_nulls_first("total_no_stores"), F.asc_nulls_last("country_code"))


def top_localities(tables: Tables, top: int = 7) -> DataFrame:
    """The localities with the most stores."""
    counts = tables["stores"].groupBy("locality").agg(F.count("locality").alias("total_no_stores"))
    order = [F.desc_nulls_first("total_no_stores"), F.asc_nulls_last("locality")]
    return counts.orderBy(*order).limit(top)


def sales_by_month(tables: Tables, scale: int = SCALE) -> DataFrame:
    """Sales of each calendar month over all years, largest first."""
    dates = tables["dates"].select("date_uuid", "month")
    totals = _sold_units(tables, dates, "date_uuid", scale).groupBy("month").agg(
        _total(scale).alias("total_sales")
    )
    return totals.orderBy(F.desc_nulls_first("total_sales"), F.asc_nulls_last("month"))


def sales_by_month_first_sale(tables: Tables, scale: int = SCALE) -> DataFrame:
    """`sales_by_month` with one sample sale per month, first by product and date key.

    Sums per month and product tell the total and the first product of each month; only
    the sales of these few products are looked at again to find the sample.
    """
    fact = tables["orders"].select("product_code", "date_uuid", "product_quantity")
    dates = tables["dates"].select("date_uuid", "month").where(F.col("month").isNotNull())
    prices = _priced(tables["products"], scale)
    sold = lookup(fact, dates, "date_uuid").groupBy("month", "product_code").agg(
        F.sum("product_quantity").alias("product_quantity")
    )
    priced = sold.join(prices, "product_code").select("month", "product_code", *_units())
    first = priced.groupBy("month").agg(F.min("product_code").alias("product_code"), _total(scale).alias("total_sales"))
    # As many rows as the answer, so it is broadcast where it is needed again below. As one row
    # holds them all, no use is planned without the columns that it doesn't need: all uses
    # share the shuffles that it comes from.
    listed = first.agg(F.collect_list(F.struct("month", "product_code", "total_sales")).alias("months"))
    months = F.broadcast(listed.select(F.inline("months")))
    looked_at = fact.join(F.broadcast(months.select("product_code")), "product_code", "left_semi")
    sample = first_in_group(
        lookup(looked_at, dates, "date_uuid").join(months, ["month", "product_code"]),
        ["month", "product_code", "total_sales"], ["date_uuid"], ["product_quantity"],
    )
    priced_sample = prices.join(F.broadcast(sample), "product_code").withColumns(dict(zip(("units", "odd"), _units(), strict=True)))
    odd_price = F.col("odd_price").cast("decimal(38,6)")
    result = priced_sample.select(
        "product_quantity", "product_code", "date_uuid", "month",
        _money(F.col("unit_price"), odd_price, scale).alias("product_price"),
        _money(F.col("units"), F.col("odd"), scale).alias("total_price"),
        "total_sales",
    )
    return result.orderBy(
        F.desc_nulls_first("total_sales"), "month", "product_code", "date_uuid"
    )


def web_vs_offline(tables: Tables) -> DataFrame:
    """Sales moments and products sold on the web and in shops."""
    on_web = F.col("store_type").eqNullSafe(F.lit(fixed.WEB_STORE_TYPE))
    location = F.when(on_web, fixed.WEB).otherwise(fixed.OFFLINE).alias("location")
    stores = tables["stores"].select("store_code", location)
    fact = tables["orders"].select("store_code", "date_uuid", "product_quantity")
    sales = lookup(fact, stores, "store_code").groupBy("location").agg(
        F.count_distinct("date_uuid").alias("numbers_of_sales"),
        F.sum("product_quantity").alias("product_quantity_count"),
    )
    return sales.orderBy(F.desc_nulls_first("location"))


def store_type_share(tables: Tables, scale: int = SCALE) -> DataFrame:
    """Sales of each store type and their share of all sales."""
    stores = tables["stores"].select("store_code", "store_type")
    by_type = _sold_units(tables, stores, "store_code", scale).groupBy("store_type").agg(
        F.sum("units").alias("units"), F.sum("odd").alias("odd")
    )
    overall = by_type.agg(_total(scale)).scalar()
    total = F.col("total_sales")
    return (
        by_type.select("store_type", _money(F.col("units"), F.col("odd"), scale).alias("total_sales"))
        .withColumn("sales_percentage", F.try_divide(total, overall) * 100)
        .orderBy(F.desc_nulls_first("total_sales"), F.asc_nulls_last("store_type"))
    )


def top_year_months(tables: Tables, top: int = 10, scale: int = SCALE) -> DataFrame:
    """The months of single years that sold most."""
    dates = tables["dates"].select("date_uuid", "year", "month")
    totals = _sold_units(tables, dates, "date_uuid", scale).groupBy("year", "month").agg(
        _total(scale).alias("total_sales")
    )
    order = [F.desc_nulls_first("total_sales"), F.asc_nulls_last("year"), F.asc_nulls_last("month")]
    return totals.orderBy(*order).limit(top)


def staff_per_country(tables: Tables) -> DataFrame:
    """Head count of each country."""
    staff = tables["stores"].groupBy("country_code").agg(
        F.sum("staff_numbers").alias("total_staff_numbers")
    )
    return staff.orderBy(F.desc_nulls_first("total_staff_numbers"), F.asc_nulls_last("country_code"))


def country_sales_by_store_type(tables: Tables, country: str = "DE", scale: int = SCALE) -> DataFrame:
    """Sales of each store type within one country, smallest first."""
    stores = tables["stores"].where(F.col("country_code") == country)
    stores = stores.select("store_code", "store_type", "country_code")
    totals = _sold_units(tables, stores, "store_code", scale).groupBy("store_type", "country_code").agg(
        _total(scale).alias("total_sales")
    )
    return totals.orderBy(F.asc_nulls_last("total_sales"), F.asc_nulls_last("store_type"))


def _sale_moments(tables: Tables, strict: bool) -> DataFrame:
    """sale_year, `at` in microseconds and `n` sales, at least one row per date key sold on."""
    moment = sale_moment(*(F.col(c) for c in ("year", "month", "day", "timestamp")), strict=strict)
    dates = (
        tables["dates"].select("date_uuid", moment.alias("moment")).where("moment IS NOT NULL")
        .select("date_uuid", F.year("moment").alias("sale_year"), to_micros(F.col("moment")).alias("at"))
    )
    sales = tables["orders"].select("date_uuid", F.lit(1).cast("bigint").alias("n"))
    return sum_then_lookup(sales, dates, "date_uuid", "n")


def sale_gap_by_year(tables: Tables, strict: bool = False) -> DataFrame:
    """Mean time between one sale and the next, per year, in microseconds.

    Gaps between sorted moments add up to last minus first, so the mean needs only
    min, max and count: one hash aggregate, with no order and no window. A year
    with a single sale has no gap and is left out.
    """
    span = _sale_moments(tables, strict).groupBy("sale_year").agg(
        (F.max("at") - F.min("at")).alias("span"), F.sum("n").alias("n")
    )
    mean = mean_micros(F.col("span"), F.col("n") - 1)
    return span.select("sale_year", mean.alias("mean_gap_us")).where("mean_gap_us IS NOT NULL")


def sale_gap_by_year_window(tables: Tables, strict: bool = False) -> DataFrame:
    """`sale_gap_by_year` from the gaps themselves: each sale's LEAD minus its own moment."""
    moments = _sale_moments(tables, strict).groupBy("sale_year", "at").agg(F.sum("n").alias("n"))
    gaps = gap_totals(moments, "sale_year", "at", "n")
    mean = mean_micros(F.col("total"), F.col("gaps"))
    return gaps.select("sale_year", mean.alias("mean_gap_us")).where("mean_gap_us IS NOT NULL")


def next_sale_moments(tables: Tables, strict: bool = False) -> DataFrame:
    """Every moment with a sale, the next one of its year, and the microseconds between."""
    moments = _sale_moments(tables, strict).select("sale_year", "at").distinct()
    gap = (F.col("next_at") - F.col("at")).alias("gap_us")
    return next_moment(moments, "sale_year", "at").select("sale_year", "at", "next_at", gap)


def sale_gap_formatted(tables: Tables, top: int = 5, strict: bool = False) -> DataFrame:
    """The years with the longest mean gap as clock text, ordered as text, and its parts."""
    clock = clock_text(F.col("mean_gap_us")).alias("actual_time_taken")
    gaps = sale_gap_by_year(tables, strict).select("sale_year", clock)
    parts = split_clock(F.col("actual_time_taken")).alias("parts")
    split = gaps.select("*", parts).select("sale_year", "actual_time_taken", "parts.*")
    return split.orderBy(F.desc_nulls_first("actual_time_taken"), "sale_year").limit(top)
