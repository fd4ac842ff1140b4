"""Column -> Column building blocks; every one is a built-in JVM expression."""

from .dates import parse_date, sale_moment, to_micros
from .durations import clock_text, mean_micros, split_clock
from .numbers import digits_only, strict_double, to_smallint
from .text import nullable_text, uuid_text, varchar
from .weights import to_kg, weight_class

__all__ = [
    "clock_text", "digits_only", "mean_micros", "nullable_text", "parse_date", "sale_moment",
    "split_clock", "strict_double", "to_kg", "to_micros", "to_smallint", "uuid_text", "varchar",
    "weight_class",
]
