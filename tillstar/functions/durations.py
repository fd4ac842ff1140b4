"""Durations held as whole microseconds."""

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR, MINUTE, SECOND, MILLI = 3_600_000_000, 60_000_000, 1_000_000, 1_000


def whole_div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def mean_micros(total: Column, n: Column) -> Column:
    """Mean of non-negative durations rounded to the microsecond; null when n is 0."""
    n = F.nullif(n, F.lit(0).cast("bigint"))
    return whole_div(total * 2 + n, n * 2)


def clock_text(micros: Column) -> Column:
    """`HH:MM:SS.mmm`; hours run past 24 and milliseconds are cut, not rounded."""
    parts = [
        whole_div(micros, F.lit(HOUR)),
        whole_div(micros % HOUR, F.lit(MINUTE)),
        whole_div(micros % MINUTE, F.lit(SECOND)),
        whole_div(micros % SECOND, F.lit(MILLI)),
    ]
    return F.when(micros.isNotNull(), F.format_string("%02d:%02d:%02d.%03d", *parts))


def split_clock(text: Column) -> Column:
    """`HH:MM:SS.mmm` as a struct of the four texts h, m, s and ms."""
    parts = F.split(text, "[:.]")
    names = ["h", "m", "s", "ms"]
    return F.struct(*(F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)))
