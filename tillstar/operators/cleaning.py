"""Row rules and column repairs for the six raw tables.

Each table has a list of `Rule`s over its *raw* columns. A cleaner keeps the rows
that pass every dropping rule and repairs their columns in one projection, so a
cleaner is scan -> filter -> project with no shuffle, and it runs on a streaming
DataFrame as it stands. `quarantine` reads the same rules the other way round, and
`routed` does both in one projection over all rows.
"""

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions import digits_only, nullable_text, parse_date, strict_double, to_kg, to_smallint, uuid_text
from ..functions.numbers import fits_money
from ..sources.readers import BROKEN


@dataclass(frozen=True)
class Rule:
    """`ok` is true for an acceptable row; null counts as not acceptable."""

    reason: str
    ok: Column
    drops: bool = True


def _price(text: Column) -> Column:
    return strict_double(F.replace(text, F.lit(fixed.CURRENCY_SIGN), F.lit("")))


def _no_nulls(df: DataFrame) -> list[Rule]:
    return [Rule(f"{name} missing", F.col(f"`{name}`").isNotNull()) for name in df.columns if name != BROKEN]


def _readable_dates(*names: str) -> list[Rule]:
    return [Rule(f"{n} unreadable", parse_date(F.col(n)).isNotNull(), drops=False) for n in names]


def _whole_input(df: DataFrame) -> list[Rule]:
    """Rows that stand for input that could not be read, if the reader kept them."""
    return [Rule("input unreadable", F.col(BROKEN).isNull())] if BROKEN in df.columns else []


def _kept_by_typing(reason: str, raw: Column, typed: Column) -> Rule:
    """Whether typing keeps a value; where there is none, nothing is lost."""
    return Rule(reason, raw.isNull() | typed.isNotNull(), drops=False)


def _uuids(df: DataFrame, *names: str) -> list[Rule]:
    present = [n for n in names if n in df.columns]
    return [_kept_by_typing(f"{n} no UUID", F.col(n), uuid_text(F.col(n))) for n in present]


def position_text(*names: str) -> Column:
    """A coordinate written in the first of several columns that has it; null for none."""
    return nullable_text(F.concat(*(F.coalesce(F.col(n), F.lit("")) for n in names)), fixed.MISSING_POSITION)


def _position(reason: str, *names: str) -> Rule:
    text = position_text(*names)
    return _kept_by_typing(reason, text, strict_double(text))


def user_rules(df: DataFrame) -> list[Rule]:
    return [
        *_whole_input(df),
        Rule("country not served", F.col("country").isin(fixed.USER_COUNTRIES)),
        Rule("country_code not served", F.col("country_code").isin(fixed.USER_COUNTRY_CODES)),
        *_no_nulls(df),
        *_readable_dates("date_of_birth", "join_date"),
        *_uuids(df, "user_uuid"),
    ]


def card_rules(df: DataFrame) -> list[Rule]:
    return [
        *_whole_input(df),
        Rule("expiry_date has no slash", F.col("expiry_date").contains("/")),
        *_no_nulls(df),
        *_readable_dates("date_payment_confirmed"),
    ]


def store_rules(df: DataFrame) -> list[Rule]:
    staff = digits_only(F.col("staff_numbers"))
    return [
        *_whole_input(df),
        Rule("country_code not served", F.col("country_code").isin(fixed.STORE_COUNTRY_CODES)),
        *_readable_dates("opening_date"),
        Rule("staff_numbers unreadable", staff.isNotNull(), drops=False),
        _kept_by_typing("staff_numbers too large", staff, to_smallint(staff)),
        _position("longitude unreadable", "longitude"),
        _position("latitude unreadable", "latitude", "lat"),
    ]


def product_rules(df: DataFrame) -> list[Rule]:
    misspelt, _ = fixed.AVAILABILITY_FIX
    price = _price(F.col("product_price"))
    return [
        *_whole_input(df),
        Rule("removed not a known state", F.col("removed").isin(*fixed.AVAILABILITY, misspelt)),
        Rule("product_price unreadable", price.isNotNull(), drops=False),
        Rule("product_price beyond six decimals or 24 digits", price.isNull() | fits_money(price), drops=False),
        *_readable_dates("date_added"),
        *_uuids(df, "uuid"),
    ]


def order_rules(df: DataFrame) -> list[Rule]:
    quantity = F.col("product_quantity")
    return [
        *_whole_input(df),
        *_uuids(df, "date_uuid", "user_uuid"),
        _kept_by_typing("product_quantity no small whole number", quantity, to_smallint(quantity)),
    ]


def weight_rules(df: DataFrame) -> list[Rule]:
    return [Rule("weight unreadable", to_kg(F.col("weight")).isNotNull())]


def date_rules(df: DataFrame) -> list[Rule]:
    return [
        *_whole_input(df),
        Rule("time_period not a known period", F.col("time_period").isin(fixed.TIME_PERIODS)),
        *_uuids(df, "date_uuid"),
    ]


RULES: dict[str, Callable[[DataFrame], list[Rule]]] = {
    "users": user_rules,
    "cards": card_rules,
    "stores": store_rules,
    "products": lambda df: [*weight_rules(df), *product_rules(df)],
    "orders": order_rules,
    "dates": date_rules,
}


#: Where a row goes: to the star, to the star and to quarantine, to quarantine alone.
ROUTES = CLEAN, MENDED, DROPPED = "clean", "mended", "dropped"
#: Columns that `routed` puts beside a table's own.
ROUTE, RAW_ROW, REASONS = "_route", "_raw_row", "_reject_reasons"


def _passes(rules: list[Rule]) -> Column:
    """That every dropping rule holds; plain conjuncts, so scans can take them."""
    return reduce(lambda a, b: a & b, [r.ok for r in rules if r.drops], F.lit(True))


def _keep(df: DataFrame, rules: list[Rule]) -> DataFrame:
    return df.where(_passes(rules)).drop(BROKEN)


#: Between reasons while they are one text; no column's name holds it.
_BETWEEN = "\u0001"


def _reason_text(df: DataFrame, rules: list[Rule]) -> Column:
    """All reasons in one text, empty for none: unlike an array's, its parts need no lambda
    to leave out nulls, so the projection stays compiled."""
    text = F.concat_ws(_BETWEEN, *(F.when(~F.coalesce(r.ok, F.lit(False)), r.reason) for r in rules))
    if BROKEN not in df.columns:
        return text
    # That it could not be read is all there is to say of such a row.
    return F.when(F.col(BROKEN).isNotNull(), "input unreadable").otherwise(text)


def _listed(text: Column) -> Column:
    return F.split(text, _BETWEEN)


def quarantine(df: DataFrame, table: str) -> DataFrame:
    """Raw rows that were dropped or lost a value in cleaning or typing, with every reason."""
    # An explode drops rows as a filter would, but evaluates the rules once: a filter would be
    # moved below, and take a copy of them.
    marked = df.withColumn(REASONS, _reason_text(df, RULES[table](df)))
    found = F.explode(F.when(F.col(REASONS) != "", F.array(_listed(F.col(REASONS)))))
    return marked.select("*", found.alias("reject_reasons")).drop(REASONS)


def routed(df: DataFrame, table: str) -> DataFrame:
    """Every raw row with its cleaned columns, and beside them where it goes (`ROUTE`), why
    (`REASONS`, as one text), and for rows that quarantine shows the row as it was (`RAW_ROW`).

    The cleaned columns of rows that don't pass mean nothing.
    """
    rules = RULES[table](df)
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    marked = df.select("*", _reason_text(df, rules).alias(REASONS), F.coalesce(_passes(rules), F.lit(False)).alias(ROUTE), whole.alias(RAW_ROW))
    sound = F.col(REASONS) == ""
    route = F.when(sound, CLEAN).when(F.col(ROUTE), MENDED).otherwise(DROPPED)
    return REPAIRS[table](marked.withColumns({ROUTE: route, RAW_ROW: F.when(~sound, F.col(RAW_ROW))})).drop(BROKEN)


def accepted(routes: DataFrame) -> DataFrame:
    """The rows of `routed` that the cleaner keeps, as it leaves them."""
    return routes.where(F.col(ROUTE).isin(CLEAN, MENDED)).drop(ROUTE, RAW_ROW, REASONS)


def rejected(routes: DataFrame) -> DataFrame:
    """The rows of `routed` that `quarantine` shows."""
    return routes.where(F.col(ROUTE).isin(MENDED, DROPPED)).select(f"{RAW_ROW}.*", _listed(F.col(REASONS)).alias("reject_reasons"))


def repair_users(df: DataFrame, strict: bool = False) -> DataFrame:
    return df.withColumns({
        "country_code": F.replace("country_code", *map(F.lit, fixed.COUNTRY_CODE_FIX)),
        "date_of_birth": parse_date(F.col("date_of_birth"), strict),
        "join_date": parse_date(F.col("join_date"), strict),
    })


def clean_users(df: DataFrame, strict: bool = False) -> DataFrame:
    """Users of a served country with no missing value; dates parsed, codes repaired."""
    return repair_users(_keep(df, user_rules(df)), strict)


def repair_cards(df: DataFrame, strict: bool = False) -> DataFrame:
    number = F.col("card_number").cast("string")
    return df.withColumns({
        "card_number": F.replace(number, F.lit(fixed.CARD_NOISE), F.lit("")),
        "date_payment_confirmed": parse_date(F.col("date_payment_confirmed"), strict),
    })


def clean_cards(df: DataFrame, strict: bool = False) -> DataFrame:
    """Cards with a slashed expiry and no missing value; stray marks taken out of numbers."""
    return repair_cards(_keep(df, card_rules(df)), strict)


def repair_stores(df: DataFrame, strict: bool = False) -> DataFrame:
    return df.withColumns({
        "opening_date": parse_date(F.col("opening_date"), strict),
        "staff_numbers": digits_only(F.col("staff_numbers").cast("string")),
        "continent": F.replace("continent", F.lit(fixed.CONTINENT_NOISE), F.lit("")),
    })


def clean_stores(df: DataFrame, strict: bool = False) -> DataFrame:
    """Stores of a served country; head count from its digits, continent repaired."""
    return repair_stores(_keep(df, store_rules(df)), strict)


def convert_weights(df: DataFrame, strict: bool = False) -> DataFrame:
    """Weights as kilograms. A row whose weight cannot be read goes (or raises when strict)."""
    raw = F.col("weight").cast("string")
    kg = to_kg(raw)
    if strict:
        # Text of a known unit must hold a number; text of no unit still just drops.
        known_unit = raw.contains("x") | raw.rlike("(g|ml|oz|g \\.)$")
        broken = F.raise_error(F.concat(F.lit("unreadable weight: "), raw)).cast("double")
        kg = F.when(kg.isNull() & known_unit, broken).otherwise(kg)
    return df.withColumn("weight", kg).where(F.col("weight").isNotNull())


def repair_products(df: DataFrame, strict: bool = False) -> DataFrame:
    return df.withColumns({
        "removed": F.replace("removed", *map(F.lit, fixed.AVAILABILITY_FIX)),
        "product_price": _price(F.col("product_price")),
        "date_added": parse_date(F.col("date_added"), strict),
    }).withColumnsRenamed({"EAN": "ean"})


def clean_products(df: DataFrame, strict: bool = False) -> DataFrame:
    """Products in a known state; price as a number, date parsed, `EAN` renamed to `ean`.

    Weights are converted separately, and first (`convert_weights`).
    """
    return repair_products(_keep(df, product_rules(df)), strict)


def repair_orders(df: DataFrame, strict: bool = False) -> DataFrame:
    unwanted = ["1", "first_name", "last_name"]
    absent = [c for c in unwanted if c not in df.columns]
    if strict and absent:
        raise KeyError(f"orders lack the columns {absent}")
    return df.drop(*unwanted).withColumn("card_number", F.col("card_number").cast("string"))


def clean_orders(df: DataFrame, strict: bool = False) -> DataFrame:
    """Orders without the personal and spare columns; card numbers as text."""
    return repair_orders(_keep(df, order_rules(df)), strict)


def clean_dates(df: DataFrame, strict: bool = False) -> DataFrame:
    """Date rows whose period of the day is a known one."""
    return _keep(df, date_rules(df))


CLEANERS: dict[str, Callable[..., DataFrame]] = {
    "users": clean_users,
    "cards": clean_cards,
    "stores": clean_stores,
    "products": lambda df, strict=False: clean_products(convert_weights(df, strict), strict),
    "orders": clean_orders,
    "dates": clean_dates,
}

#: What the cleaners do to rows that pass, weights included.
REPAIRS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "users": repair_users,
    "cards": repair_cards,
    "stores": repair_stores,
    "products": lambda df: repair_products(df.withColumn("weight", to_kg(F.col("weight").cast("string")))),
    "orders": repair_orders,
    "dates": lambda df: df,
}
