"""Number parsing that accepts plain decimal text and nothing else."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# A bare cast would also read Java literals such as '12.5f' or '3D'.
PLAIN_NUMBER = r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"


def strict_double(text: Column) -> Column:
    """Text to double; anything that is not a plain number becomes null."""
    return F.regexp_extract(text, PLAIN_NUMBER, 0).try_cast("double")


def digits_only(text: Column) -> Column:
    """Keep the decimal digits of a text and read them as bigint; none left gives null."""
    return F.regexp_replace(text, "[^0-9]", "").try_cast("bigint")


def to_smallint(number: Column, strict: bool = False) -> Column:
    """Fit a value into SMALLINT: out of range is null, or an error when strict."""
    return number.cast("smallint") if strict else number.try_cast("smallint")


#: What a price that is summed exactly may hold: 24 digits before the point, 6 behind.
MONEY = "decimal(30,6)"


def fits_money(price: Column) -> Column:
    """Whether a price is exactly a number with up to six decimals."""
    return F.coalesce(price.try_cast(MONEY).cast("double") == price, F.lit(False))
