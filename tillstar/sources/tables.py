"""Tables: named sources, whole-table reads, replacing writes and listings."""

from collections import Counter
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..operators.profiling import profile, show_all
from ..operators.sequence import with_index

#: Rows that one task reads of a database table that is split.
ROWS_PER_TASK = 1_000_000


@dataclass
class SourceRegistry:
    """Databases by name, each a dict of reader options (`format` plus the format's own).

    A JDBC source gives url, driver, user and password; a folder of tables gives
    `{"format": "parquet", "path": ...}`; the catalog gives `{"format": "catalog"}`.
    """

    sources: dict[str, dict[str, str]] = field(default_factory=dict)

    def options(self, name: str) -> dict[str, str]:
        if name not in self.sources:
            raise KeyError(f"no source named {name!r}; known are {sorted(self.sources)}")
        return dict(self.sources[name])


def jdbc_options(source: dict[str, str], name: str, split: dict[str, str] | None) -> dict[str, str]:
    """Options of one JDBC table read.

    `split` (partitionColumn, lowerBound, upperBound, numPartitions) lets tasks read
    ranges of the table in parallel; without it one task reads it all (`read_table`
    makes one up where the table has an `index`).
    """
    needed = {"partitionColumn", "lowerBound", "upperBound", "numPartitions"}
    if split and set(split) != needed:
        raise ValueError(f"a parallel read needs exactly {sorted(needed)}")
    return {"fetchsize": "10000", **source, "dbtable": name, **(split or {})}


def bounds_query(name: str, column: str = "index") -> str:
    """A query, as a table, for the least and greatest value of a column and the row count."""
    return f'(SELECT min("{column}") AS low, max("{column}") AS high, count(*) AS n FROM {name}) bounds'


def split_of(low: int | None, high: int | None, n: int, column: str = "index", per_task: int = ROWS_PER_TASK):
    """The split that gives each task about `per_task` rows; None where one task is enough."""
    if low is None or n <= per_task:
        return None
    tasks = -(-n // per_task)
    return {"partitionColumn": column, "lowerBound": str(low), "upperBound": str(high + 1), "numPartitions": str(tasks)}


def quantiles_query(name: str, column: str, parts: int) -> str:
    """A query, as a table, for the greatest value of each of `parts` equal shares of a column's
    values in order, and how many values each share has."""
    tiles = f'SELECT "{column}" AS value, ntile({parts}) OVER (ORDER BY "{column}") AS tile FROM {name} WHERE "{column}" IS NOT NULL'
    return f"(SELECT tile, max(value) AS bound, count(*) AS n FROM ({tiles}) tiles GROUP BY tile) bounds"


def _literal(value: object) -> str:
    return str(value) if isinstance(value, (int, float, Decimal)) else "'" + str(value).replace("'", "''") + "'"


def predicates_of(column: str, bounds: list) -> list[str]:
    """Conditions that part a table by the ordered `bounds` of its shares: every row meets one
    of them. A value that fills a share or more has one of its own, as no range over the
    column can cut it; rows without a value go with the first."""
    quoted, found, low, seen = f'"{column}"', [], None, Counter(bounds)

    def after() -> str:
        return f"{quoted} > {_literal(low)} AND " if low is not None else ""

    for bound in seen:  # in the database's own order
        if seen[bound] > 1:
            found += [f"{after()}{quoted} < {_literal(bound)}", f"{quoted} = {_literal(bound)}"]
        else:
            found.append(f"{after()}{quoted} <= {_literal(bound)}")
        low = bound
    if low is None:
        return ["1 = 1"]
    found[0] = f"({found[0]}) OR {quoted} IS NULL"
    return [*found, f"{quoted} > {_literal(low)}"]  # what came in since the bounds were taken


def _by_quantiles(spark: SparkSession, source: dict[str, str], name: str, column: str, parts: int) -> DataFrame:
    shares = spark.read.format("jdbc").options(**jdbc_options(source, quantiles_query(name, column, parts), None)).load()
    bounds = [r["bound"] for r in sorted(shares.collect(), key=lambda r: r["tile"])]  # a row per task of the read
    rest = {k: v for k, v in source.items() if k != "url"}
    return spark.read.jdbc(source["url"], name, predicates=predicates_of(column, bounds), properties={"fetchsize": "10000", **rest})


def _read_jdbc(spark: SparkSession, source: dict[str, str], name: str, split: dict[str, str] | None) -> DataFrame:
    """Without a split: by ranges of the table's `index`, whose bounds one small query gives."""
    if split and set(split) == {"quantilesOf", "numPartitions"}:
        return _by_quantiles(spark, source, name, split["quantilesOf"], int(split["numPartitions"]))
    whole = spark.read.format("jdbc").options(**jdbc_options(source, name, split)).load()
    whole_numbers = ("smallint", "int", "bigint")
    if split or dict(whole.dtypes).get("index") not in whole_numbers:
        return whole
    bounds = spark.read.format("jdbc").options(**jdbc_options(source, bounds_query(name), None)).load().first()
    found = split_of(bounds["low"], bounds["high"], bounds["n"])
    return spark.read.format("jdbc").options(**jdbc_options(source, name, found)).load() if found else whole


def read_table(
    spark: SparkSession, registry: SourceRegistry, source: str, name: str,
    split: dict[str, str] | None = None,
) -> DataFrame:
    """A whole table of a named source, without its `index` column.

    `split` says how tasks share a JDBC table: the four options of Spark's reader, for a whole-number
    key that is spread evenly, or `quantilesOf` any column that has an order and `numPartitions`:
    then the database tells the bounds of equal shares of its rows, however its values are spread.
    """
    options = registry.options(source)
    fmt = options.pop("format")
    if fmt == "catalog":
        df = spark.table(name)
    elif fmt == "jdbc":
        df = _read_jdbc(spark, options, name, split)
    else:
        df = spark.read.format(fmt).load(f"{options['path'].rstrip('/')}/{name}")
    return df.drop("index")


def list_tables(
    spark: SparkSession, database: str | None = None, registry: SourceRegistry | None = None, source: str | None = None
) -> list[str]:
    """Names of the tables of a named source, or of those the session's catalog knows.

    A folder's tables are the folders in it; a JDBC source lists its information schema.
    """
    options = registry.options(source) if registry and source else {"format": "catalog"}
    fmt = options.pop("format")
    if fmt == "catalog":
        return sorted(t.name for t in spark.catalog.listTables(database))
    if fmt == "jdbc":
        query = "(SELECT table_name FROM information_schema.tables) listed"
        return sorted(r[0] for r in spark.read.format("jdbc").options(**jdbc_options(options, query, None)).load().collect())
    root = options["path"].rstrip("/")
    try:
        files = spark.read.option("recursiveFileLookup", True).text(root).inputFiles()
    except AnalysisException:  # nothing there yet
        return []
    inside = [f.split(f"{root.rpartition(':')[2].rstrip('/')}/", 1)[-1] for f in files]
    return sorted({f.split("/", 1)[0] for f in inside if "/" in f})


def write_table(
    df: DataFrame, registry: SourceRegistry, target: str, name: str, show_profile: bool = False,
    index_by: tuple[str, ...] = (),
) -> None:
    """Write a table to a named database and replace what was there.

    `index_by` puts a dense 0-based `index` column in that order in front.
    """
    options = registry.options(target)
    fmt = options.pop("format")
    if index_by:
        df = with_index(df, *index_by)
    if show_profile:
        show_all(profile(df))
    writer = df.write.mode("overwrite")
    if fmt == "catalog":
        writer.saveAsTable(name)
    elif fmt == "jdbc":
        writer.format("jdbc").options(**jdbc_options(options, name, None)).save()
    else:
        if fmt == "parquet":
            writer = writer.option("compression", "zstd")  # keys are mostly hex digits, which take half the bytes
        writer.format(fmt).save(f"{options['path'].rstrip('/')}/{name}")
