"""The typed star schema: one projection per table instead of one rewrite per column."""

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions import strict_double, to_smallint, uuid_text, varchar, weight_class
from .cleaning import position_text


@dataclass(frozen=True)
class TableSpec:
    """Typed columns of one table, by name, and raw columns that do not outlive typing.

    Columns the table has beyond these pass through unchanged, after the typed ones.
    """

    name: str
    columns: dict[str, Callable[[bool], Column]]
    key: str | None = None
    consumed: tuple[str, ...] = ()
    measured: tuple[str, ...] = field(default=())

    def apply(self, df: DataFrame, strict: bool = False) -> DataFrame:
        typed = [make(strict).alias(name) for name, make in self.columns.items()]
        rest = [F.col(f"`{c}`") for c in df.columns if c not in self.columns and c not in self.consumed]
        return df.select(*typed, *rest)


def _date(name):
    return lambda strict: F.col(name).cast("date")


def _double(name):
    return lambda strict: F.col(name).cast("double")


def _small(name):
    return lambda strict: to_smallint(F.col(name), strict)


def _text(name, length=None):
    return lambda strict: varchar(F.col(name), length)


def _uuid(name):
    def typed(strict: bool) -> Column:
        value = uuid_text(F.col(name))
        if not strict:
            return value
        error = F.raise_error(F.concat(F.lit("not a UUID: "), F.col(name))).cast("string")
        return F.when(value.isNull() & F.col(name).isNotNull(), error).otherwise(value)

    return typed


def _position(*names):
    def typed(strict: bool) -> Column:
        text = position_text(*names)
        number = strict_double(text)
        if not strict:
            return number
        error = F.raise_error(F.concat(F.lit("not a coordinate: "), text)).cast("double")
        return F.when(number.isNull() & text.isNotNull(), error).otherwise(number)

    return typed


def _available(strict: bool) -> Column:
    available, removed = fixed.AVAILABILITY
    return F.when(F.col("removed") == available, True).when(F.col("removed") == removed, False)


STAR: dict[str, TableSpec] = {
    "orders": TableSpec(
        "orders_table",
        {
            "date_uuid": _uuid("date_uuid"),
            "user_uuid": _uuid("user_uuid"),
            "card_number": _text("card_number"),
            "store_code": _text("store_code"),
            "product_code": _text("product_code"),
            "product_quantity": _small("product_quantity"),
        },
        measured=("card_number", "store_code", "product_code"),
    ),
    "users": TableSpec(
        "dim_users",
        {
            "first_name": _text("first_name", 255),
            "last_name": _text("last_name", 255),
            "date_of_birth": _date("date_of_birth"),
            "country_code": _text("country_code"),
            "user_uuid": _uuid("user_uuid"),
            "join_date": _date("join_date"),
        },
        key="user_uuid",
        measured=("country_code",),
    ),
    "stores": TableSpec(
        "dim_store_details",
        {
            "longitude": _position("longitude"),
            "locality": _text("locality", 255),
            "store_code": _text("store_code"),
            "staff_numbers": _small("staff_numbers"),
            "opening_date": _date("opening_date"),
            "store_type": _text("store_type", 255),
            "latitude": _position("latitude", "lat"),
            "country_code": _text("country_code"),
            "continent": _text("continent", 255),
        },
        key="store_code",
        consumed=("lat",),
        measured=("store_code", "country_code"),
    ),
    "products": TableSpec(
        "dim_products",
        {
            "product_price": _double("product_price"),
            "weight": _double("weight"),
            "ean": _text("ean"),
            "product_code": _text("product_code"),
            "date_added": _date("date_added"),
            "uuid": _uuid("uuid"),
            "still_available": _available,
            "weight_class": lambda strict: weight_class(F.col("weight").cast("double")),
        },
        key="product_code",
        consumed=("removed",),
        measured=("ean", "product_code", "weight_class"),
    ),
    "dates": TableSpec(
        "dim_date_times",
        {
            "month": _text("month"),
            "year": _text("year"),
            "day": _text("day"),
            "time_period": _text("time_period"),
            "date_uuid": _uuid("date_uuid"),
        },
        key="date_uuid",
        measured=("month", "year", "day", "time_period"),
    ),
    "cards": TableSpec(
        "dim_card_details",
        {
            "card_number": _text("card_number"),
            "expiry_date": _text("expiry_date"),
            "date_payment_confirmed": _date("date_payment_confirmed"),
        },
        key="card_number",
        measured=("card_number", "expiry_date"),
    ),
}


def type_changes(before: DataFrame, after: DataFrame) -> list[tuple[str, str | None, str, bool]]:
    """(column, old type, new type, nullable) for every column of the typed table."""
    old = {f.name: f.dataType.simpleString() for f in before.schema}
    return [(f.name, old.get(f.name), f.dataType.simpleString(), f.nullable) for f in after.schema]
