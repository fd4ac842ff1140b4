"""Table profiles: filled values per column and longest text per column."""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def _one_row_to_many(row: DataFrame, name: str, value: str) -> DataFrame:
    return row.unpivot([], [F.col(f"`{c}`") for c in row.columns], name, value)


def profile(df: DataFrame) -> DataFrame:
    """column_name, non_null count and type of every column, in one aggregate over one scan."""
    counts = df.agg(*(F.count(F.col(f"`{c}`")).alias(c) for c in df.columns))
    types = F.create_map(*(F.lit(x) for pair in df.dtypes for x in pair))
    long = _one_row_to_many(counts, "column_name", "non_null")
    return long.withColumn("data_type", F.element_at(types, F.col("column_name")))


def max_lengths(df: DataFrame, columns: list[str]) -> DataFrame:
    """column_name and longest text length, for all columns in one aggregate."""
    longest = df.agg(*(F.max(F.length(F.col(f"`{c}`"))).cast("bigint").alias(c) for c in columns))
    return _one_row_to_many(longest, "column_name", "max_length")


class Measured:
    """Counts of filled values and longest texts, taken while a table is written.

    Pass `watch(df)` to the writer; afterwards `profile()` and `max_lengths()` say what
    the functions of those names would, without reading the table.
    """

    def __init__(self, columns: tuple[str, ...] = ()):
        self._seen, self._measured, self._of = Observation(), columns, None

    def watch(self, df: DataFrame) -> DataFrame:
        self._of = df
        counts = [F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)]
        lengths = [F.max(F.length(F.col(f"`{c}`"))).alias(f"l{i}") for i, c in enumerate(self._measured)]
        return df.observe(self._seen, F.count(F.lit(1)).alias("rows"), *counts, *lengths)

    @property
    def rows(self) -> int:
        return self._seen.get["rows"]

    def profile(self) -> DataFrame:
        seen = self._seen.get
        rows = [(c, seen[f"n{i}"], kind) for i, (c, kind) in enumerate(self._of.dtypes)]
        return self._of.sparkSession.createDataFrame(rows, "column_name string, non_null long, data_type string")

    def max_lengths(self) -> DataFrame:
        seen = self._seen.get
        rows = [(c, seen[f"l{i}"]) for i, c in enumerate(self._measured)]
        return self._of.sparkSession.createDataFrame(rows, "column_name string, max_length long")


def show_all(df: DataFrame) -> None:
    """Print a small result, every row of it."""
    rows = df.collect()
    df.sparkSession.createDataFrame(rows, df.schema).show(max(1, len(rows)), truncate=False)
