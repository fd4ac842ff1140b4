"""From raw tables to the written, typed and checked star schema."""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import CLEANERS, ROUTE, ROUTES, accepted, quarantine, rejected, routed
from ..operators.integrity import fk_orphans, pk_violations, require_keys
from ..operators.profiling import Measured, profile
from ..operators.typing import STAR, type_changes
from ..session import scratch_path
from ..sources.tables import SourceRegistry, read_table, write_table


OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


def star_tables(raw: dict[str, DataFrame], strict: bool = False) -> dict[str, DataFrame]:
    """Cleaned and typed tables: one lazy, shuffle-free projection per raw table."""
    return {t: STAR[t].apply(CLEANERS[t](df, strict=strict), strict) for t, df in raw.items()}


def star_types(raw: dict[str, DataFrame], strict: bool = False) -> DataFrame:
    """table_name, column_name, old_type, new_type and nullable of every column of the star.

    old_type is the cleaned table's, null for a column that typing makes.
    """
    rows, spark = [], None
    for t, df in raw.items():
        spark, clean = df.sparkSession, CLEANERS[t](df, strict=strict)
        rows += [(STAR[t].name, *change) for change in type_changes(clean, STAR[t].apply(clean, strict))]
    return spark.createDataFrame(rows, "table_name string, column_name string, old_type string, new_type string, nullable boolean")


def _stacked(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


@dataclass
class Warehouse:
    """The written star and what its build found wrong; no fact or no dimension, no foreign key report."""

    tables: dict[str, DataFrame]
    rejects: dict[str, DataFrame]
    pk_report: DataFrame
    fk_report: DataFrame | None
    types: DataFrame
    registry: SourceRegistry
    measured: dict[str, Measured]

    def create_views(self) -> None:
        """Make the tables known to `spark.sql` under their names."""
        for t, df in self.tables.items():
            df.createOrReplaceTempView(STAR[t].name)

    def store_reports(self) -> "Warehouse":
        """Write the rejected rows (`rejects_<table>`) and every violated key beside the star,
        and read them from there from now on."""
        spark = self.pk_report.sparkSession

        def kept(df: DataFrame, name: str) -> DataFrame:
            write_table(df, self.registry, "star", name)
            return read_table(spark, self.registry, "star", name)

        for t, df in self.rejects.items():
            stored = kept(_storable(df), f"rejects_{t}")
            self.rejects[t] = stored.withColumn("reject_reasons", F.split("reject_reasons", "; "))
        self.pk_report = kept(self.pk_report, "pk_violations")
        if self.fk_report is not None:
            self.fk_report = kept(self.fk_report, "fk_orphans")
        return self

    def reject_counts(self) -> DataFrame:
        """table_name, reason and rows_rejected."""
        return reject_counts(self.rejects)

    def key_counts(self) -> DataFrame:
        """Per primary key: how many of its values are missing or repeated, and their rows."""
        return self.pk_report.groupBy("table_name", "key_column").agg(
            F.count("*").alias("key_values"), F.sum("row_count").alias("row_count")
        )

    def profile(self) -> DataFrame:
        """Filled values and type of every column of every table, as counted while writing."""
        return _stacked([m.profile().withColumn("table_name", F.lit(STAR[t].name)) for t, m in self.measured.items()])

    def max_lengths(self) -> DataFrame:
        """The longest text of every column that typing measures, as found while writing."""
        return _stacked([m.max_lengths().withColumn("table_name", F.lit(STAR[t].name)) for t, m in self.measured.items()])


def reject_counts(rejects: dict[str, DataFrame]) -> DataFrame:
    reasons = [df.select(F.lit(t).alias("table_name"), F.explode("reject_reasons").alias("reason")) for t, df in rejects.items()]
    return _stacked(reasons).groupBy("table_name", "reason").agg(F.count("*").alias("rows_rejected"))


def profile_star(tables: dict[str, DataFrame]) -> DataFrame:
    return _stacked([profile(df).withColumn("table_name", F.lit(STAR[t].name)) for t, df in tables.items()])


def build_warehouse(
    spark: SparkSession, raw: dict[str, DataFrame], out: str | dict[str, str], strict: bool = False
) -> Warehouse:
    """Clean, type and write the fact and dimensions given to `out`, replacing earlier ones, then check keys.

    `out` is a folder for Parquet tables or the options of a database. Each raw table is read
    once: its rows are judged, cleaned and typed in one projection and written to the shared
    folder, apart by where they go; the star and the rejects are both read from there. So no
    row is lost or doubled where a source changes meanwhile. Later queries read the written
    tables; what is wrong is worked out when asked for, or written by `store_reports`.
    `strict` raises on unreadable values and on violated keys instead; only its rejects read
    the raw table again.
    """
    registry = SourceRegistry({"star": {"format": "parquet", "path": out} if isinstance(out, str) else out})
    measured = {t: Measured(STAR[t].measured) for t in raw}
    if strict:
        star, rejects = star_tables(raw, strict), {t: quarantine(df, t) for t, df in raw.items()}
    else:
        routes = {t: _apart(spark, df, t) for t, df in raw.items()}
        star, rejects = ({t: part(df) for t, df in routes.items()} for part in (accepted, rejected))
    for t, df in star.items():
        write_table(measured[t].watch(df), registry, "star", STAR[t].name)
    tables = {t: read_table(spark, registry, "star", STAR[t].name) for t in raw}
    if strict:
        require_keys(tables)
    linked = "orders" in tables and len(tables) > 1
    fk_report = fk_orphans(tables) if linked else None
    return Warehouse(tables, rejects, pk_violations(tables), fk_report, star_types(raw, strict), registry, measured)


def _apart(spark: SparkSession, raw: DataFrame, table: str) -> DataFrame:
    """`routed` rows, typed, as a table with a partition for each route.

    A task keeps a file open for each route, so it has no need to sort its rows by route first.
    """
    df = STAR[table].apply(routed(raw, table))
    path = scratch_path(spark, f"routed-{table}")
    before = spark.conf.get(OPEN_FILES)
    spark.conf.set(OPEN_FILES, len(ROUTES))
    try:
        df.write.partitionBy(ROUTE).option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(OPEN_FILES, before)
    return spark.read.schema(df.schema).parquet(path)


def _storable(rejects: DataFrame) -> DataFrame:
    """Reasons as one text, which any database can hold."""
    return rejects.withColumn("reject_reasons", F.array_join("reject_reasons", "; "))
