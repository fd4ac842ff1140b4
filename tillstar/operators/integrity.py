"""Primary and foreign key checks, as reports of what breaks them."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import broadcastable
from .typing import STAR

# The fact's foreign keys: column and the dimension whose key it must match.
FOREIGN_KEYS = {
    "user_uuid": "users",
    "store_code": "stores",
    "product_code": "products",
    "date_uuid": "dates",
    "card_number": "cards",
}


def key_violations(df: DataFrame, key: str) -> DataFrame:
    """Key values that are null or occur more than once, with their row count."""
    counts = df.groupBy(F.col(key).cast("string").alias("key_value")).agg(F.count("*").alias("row_count"))
    return counts.where(F.col("key_value").isNull() | (F.col("row_count") > 1))


def pk_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Primary key violations of every dimension present in `tables`."""
    reports = [
        key_violations(tables[t], spec.key).select(
            F.lit(spec.name).alias("table_name"), F.lit(spec.key).alias("key_column"),
            "key_value", "row_count",
        )
        for t, spec in STAR.items() if spec.key and t in tables
    ]
    if not reports:
        spark = next(iter(tables.values())).sparkSession
        return spark.createDataFrame([], "table_name string, key_column string, key_value string, row_count long")
    return reduce(DataFrame.unionByName, reports)


#: The text of a UUID: 16 bytes in 36 characters.
UUID_TEXT = "^[0-9a-f]{8}-([0-9a-f]{4}-){3}[0-9a-f]{12}$"


def packed(text: Column, place: int) -> Column:
    """A key in few bytes, as it moves: the number of its column (63 at most) and whether it is a
    UUID in one, then a UUID in its 16 and any other text as it is."""
    is_uuid = (F.length(text) == 36) & text.rlike(UUID_TEXT)
    uuid = F.concat(F.lit(bytes([2 * place + 1])), F.unhex(F.replace(text, F.lit("-"), F.lit(""))))
    return F.when(is_uuid, uuid).otherwise(F.concat(F.lit(bytes([2 * place])), text.cast("binary")))


def unpacked(key: Column, names: list[str]) -> list[Column]:
    """key_column, of `names`, and key_value that `packed` was given."""
    mark = F.conv(F.hex(F.substring(key, 1, 1)), 16, 10).cast("int")
    rest = F.substring(key, 2, 2**31 - 1)
    uuid = F.regexp_replace(F.lower(F.hex(rest)), "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-")
    column = F.element_at(F.array(*map(F.lit, names)), F.floor(mark / 2).cast("int") + 1)
    return [column.alias("key_column"), F.when(mark % 2 == 1, uuid).otherwise(rest.cast("string")).alias("key_value")]


def orphans(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Fact keys with no dimension row: key_column, key_value and how many fact rows hold it.

    `dims` maps a key column of the fact to the dimension it refers to. The fact is read
    once. Keys of a dimension that can be broadcast are looked up there and taken out
    where they are found; what is left of all keys is counted per task before it
    shuffles, packed, and meets the keys of large dimensions in that same shuffle: a key
    is an orphan if only the fact has it. A null key refers to nothing and is no orphan.
    """
    text = {k: F.col(k).cast("string").alias(k) for k in dims}
    small = {k: dim for k, dim in dims.items() if broadcastable(dim.select(k))}
    left = fact.select(*text.values())
    for k, dim in small.items():
        known = dim.select(text[k]).where(F.col(k).isNotNull()).distinct().withColumnRenamed(k, "known")
        left = left.join(known, F.col(k) == F.col("known"), "left").withColumn(
            k, F.when(F.col("known").isNull(), F.col(k))
        ).drop("known")
    names = list(dims)
    keys = left.select(*(packed(F.col(k), i).alias(k) for i, k in enumerate(names))).unpivot([], names, "key_column", "key")
    # A fact row counts under `held`; a dimension's, whose key meets it here, does not.
    sides = [keys.select("key", F.lit(1).alias("held")), *(
        dims[k].select(packed(text[k], i).alias("key"), F.lit(None).cast("int").alias("held"))
        for i, k in enumerate(names) if k not in small
    )]
    counts = reduce(DataFrame.unionByName, sides).where("key IS NOT NULL").groupBy("key").agg(
        F.count("*").alias("rows"), F.count("held").alias("row_count")
    )
    return counts.where("row_count = rows").select(*unpacked(F.col("key"), names), "row_count")


def fk_orphans(tables: dict[str, DataFrame]) -> DataFrame:
    """Per foreign key of the fact: how many key values, and rows, find no dimension row."""
    fact = tables["orders"]
    checked = {k: t for k, t in FOREIGN_KEYS.items() if t in tables}
    found = orphans(fact, {k: tables[t] for k, t in checked.items()}).groupBy("key_column").agg(
        F.count("*").alias("orphan_keys"), F.sum("row_count").alias("orphan_rows")
    )
    constraints = fact.sparkSession.createDataFrame(
        [(k, STAR[t].name) for k, t in checked.items()], "key_column string, table_name string"
    )
    return constraints.join(found, "key_column", "left").na.fill(0, ["orphan_keys", "orphan_rows"])


def require_keys(tables: dict[str, DataFrame]) -> None:
    """Raise if any key is violated, with counts and the first few violations."""
    found = pk_violations(tables)
    bad, some = found.count(), [r.asDict() for r in found.limit(5).collect()]
    lost = []
    if "orders" in tables and len(tables) > 1:
        lost = [r.asDict() for r in fk_orphans(tables).where("orphan_rows > 0").collect()]
    if bad or lost:
        raise ValueError(f"star schema keys violated: {bad} primary key values, such as {some}; foreign keys {lost}")
