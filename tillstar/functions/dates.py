"""Dates written in many layouts, and the moment of a sale from its parts."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import CLOCK, DATE_FILLERS, DATE_LAYOUTS, SHORT_CLOCK, WEEKDAY_NAMES

MONTH_NAME = "[A-Za-z]{3,9}"
#: The parts of a date in every order, numbers first: a section with a name could end before it.
PARTS = "".join(f"[{p}]" for p in ("yyyy M d", "M d yyyy", "yyyy NAME d", "NAME d yyyy", "d NAME yyyy", "yyyy d NAME", "NAME yyyy d", "d yyyy NAME")).replace("NAME", "[MMMM][MMM]")
EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def _by_shape(listed: list[tuple[str, str]]) -> dict[str, list[str]]:
    """The layouts of each text shape; month names may be whole or cut to three letters."""
    shapes: dict[str, list[str]] = {}
    for shape, layout in listed:
        either = layout.replace("MMMM", "[MMMM][MMM]")
        shapes.setdefault(shape.replace("NAME", MONTH_NAME), []).append(either)
    return shapes


def _read(text: Column, layout: str) -> Column:
    # ISO dates, the commonest, have a faster reader than a formatter.
    return text.try_cast("date") if layout == "yyyy-M-d" else F.try_to_date(F.trim(text), layout)


def _by_layout(text: Column, listed: list[tuple[str, str]]) -> Column:
    branches = [
        (text.rlike(f"^ *{shape} *$"), F.coalesce(*(_read(text, p) for p in layouts)))
        for shape, layouts in _by_shape(listed).items()
    ]
    first, *rest = branches
    return reduce(lambda chain, b: chain.when(*b), rest, F.when(*first))


def date_by_parts(text: Column) -> Column:
    """Read a date from its parts, in whatever order and however separated.

    What isn't part of a date goes first: a clock, a weekday, fillers and separators. Then
    a name is the month, a number of four digits the year. Of two numbers beside a year the
    first is the month, unless only the second can be; behind a year month and day stand in
    this order. Eight digits in one are year, month and day. Anything left over, missing or
    of two digits for a year is no date. Each step refers to the one before it once, and one
    formatter tries all orders, so that the generated code stays small.
    """
    plain = F.regexp_replace(F.lower(text), rf"(?:(?<=\d)t|(?<![\d:])){CLOCK}(?![\d:])", " ")
    plain = F.regexp_replace(plain, rf"^\s*(\d{{4}})(\d\d)(\d\d)(t? ?{SHORT_CLOCK})?\s*$", "$1 $2 $3")
    # A name may stick to the day before it or to any number behind it.
    plain = F.regexp_replace(plain, r"(?<=(?<!\d)\d{1,2})(?=[a-z])|(?<=[a-z])(?=\d)|[\s,;./'-]+", " ")
    plain = F.trim(F.regexp_replace(plain, rf"\b({WEEKDAY_NAMES}|{DATE_FILLERS})\b *", ""))
    plain = F.regexp_replace(plain, r"^(1[3-9]|[23]\d) (\d{1,2}) (\d{4})$", "$2 $1 $3")
    # Nothing would fit all sections by leaving them out, so it becomes something.
    return F.try_to_date(F.regexp_replace(plain, r"\bsept\b|^$", "sep"), PARTS)


def parse_date(text: Column, strict: bool = False) -> Column:
    """Read a date, however written; unreadable text is null, or an error when strict.

    The shape of the text picks one of the common layouts, so that a value runs one formatter
    rather than failing through a list of them: a failed parse costs far more than a pattern
    test. What fits none of them is read by its parts (`date_by_parts`), if it has any digit.
    """
    parsed = F.coalesce(_by_layout(text, DATE_LAYOUTS), F.when(text.rlike(r"\d"), date_by_parts(text)))
    if not strict:
        return parsed
    shown = F.coalesce(text, F.lit("null"))
    return F.coalesce(parsed, F.raise_error(F.concat(F.lit("unreadable date: "), shown)).cast("date"))


def sale_moment(year: Column, month: Column, day: Column, clock: Column, strict: bool = False) -> Column:
    """Zone-less timestamp from text parts; null if any part is null or unreadable."""
    text = F.concat(year, F.lit("-"), month, F.lit("-"), day, F.lit(" "), clock)
    return text.cast("timestamp_ntz") if strict else text.try_cast("timestamp_ntz")


def to_micros(moment: Column) -> Column:
    """Microseconds since 1970 of a zone-less timestamp, without touching any time zone."""
    seconds = (moment - F.expr(EPOCH)).cast("decimal(20,6)")
    return (seconds * 1_000_000).cast("bigint")
