"""Small results as text for people."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.profiling import show_all


def two_decimals(number: Column) -> Column:
    """Fixed two decimals without thousands separators, as money and percent are printed."""
    return F.regexp_replace(F.format_number(number, 2), ",", "")


def report(df: DataFrame) -> DataFrame:
    """Every fractional column as two-decimal text; the rest as it is."""
    shown = {c: two_decimals(F.col(c)) for c, t in df.dtypes if t in ("double", "float")}
    return df.withColumns(shown) if shown else df


def show(df: DataFrame, title: str) -> None:
    """Print a small result under a title, every row of it."""
    print(f"\n{title}")
    show_all(report(df))
