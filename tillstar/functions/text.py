"""Text typing rules: UUIDs, bounded VARCHARs, text that means null."""

from pyspark.sql import Column
from pyspark.sql import functions as F

CANONICAL_UUID = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
BARE_UUID = "^([0-9a-f]{8})([0-9a-f]{4})([0-9a-f]{4})([0-9a-f]{4})([0-9a-f]{12})$"


def uuid_text(value: Column) -> Column:
    """Lower-case hyphenated UUID; braces, missing hyphens and case do not matter.

    Text that is no UUID becomes null. Already canonical values, nearly all of
    them in practice, take the first branch and skip the rewriting.
    """
    low = F.lower(value)
    bare = F.translate(low, "{}-", "")
    return F.when(low.rlike(CANONICAL_UUID), low).when(
        bare.rlike(BARE_UUID), F.regexp_replace(bare, BARE_UUID, "$1-$2-$3-$4-$5")
    )


def varchar(value: Column, length: int | None = None) -> Column:
    """VARCHAR(length): longer text is cut, as an explicit SQL cast does."""
    text = value.cast("string")
    return text if length is None else F.substring(text, 1, length)


def nullable_text(value: Column, *empty_marks: str) -> Column:
    """Turn the empty string and every given mark into null."""
    return F.when(~value.isin("", *empty_marks), value)
