"""What the text operators share: a per-text column, written tables, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, StructField, StructType

from tillstar.session import scratch_path

#: ASCII white space; everything else belongs to a word, as bytes.split() has it.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def free_name(taken: Iterable[str], wanted: str) -> str:
    """`wanted`, with underscores behind it while a column of that name is there (any case)."""
    names = {n.lower() for n in taken}
    while wanted.lower() in names:
        wanted += "_"
    return wanted


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


#: For tables of large binary values that are compressed already: a row group ends with the row
#: that takes it over 1 MB, and no more than a row group is held to write or read the table.
LARGE_ROWS = {"compression": "uncompressed", "parquet.block.size": 1 << 20, "parquet.page.size.row.check.min": 1}


def written(df: DataFrame, label: str, options: Mapping[str, str | int] | None = None) -> DataFrame:
    """`df` as a table in the shared folder, read again: lineage ends there, so a lost
    executor costs no more than the files' next readers."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_text_column(
    df: DataFrame, text: str, out: str, kind: DataType, make: Callable[[], Callable[[list[str]], list]]
) -> tuple[DataFrame, str]:
    """`df` with one more column, made from its text column by Arrow batches.

    `make` runs once per task and gives a function from a batch's texts (null: empty) to
    as many values of type `kind`. All columns of `df` stay; the new one is called `out`,
    or `out` with underscores where the name is taken. Returns the frame and that name.
    """
    name = free_name(df.columns, out)
    at = df.columns.index(text)
    arrow = to_arrow_type(kind)

    def run(batches):
        values = make()
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            column = pa.array(values(texts), type=arrow)
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, name])

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField(name, kind)])), name


def spread(*columns: str | Column, buckets: int) -> Column:
    """A bucket of 0 .. buckets-1 that depends on the values alone."""
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of the graph whose edges are the rows of `edges`.

    Returns (node, component); component is one node of the component, the same for all.
    Nodes are those with an edge; ends of null are dropped, loops and repeated edges do
    no harm. Each round, every node joins the neighbour (or itself) whose hash is least,
    and only edges between what is then apart go on, so a dense group is gone after a
    round or two and a chain shrinks by a factor, however its nodes are numbered. Rounds
    are written tables; nothing is collected.
    """
    left = written(_apart(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))), "edges")
    found = None
    for turn in range(200):
        if left.isEmpty():
            break
        ends = left.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e"))
        rank = lambda node: F.xxhash64(node, F.lit(turn))  # noqa: B023, E731
        nearest = ends.select("e.u", "e.v").groupBy("u").agg(F.min_by("v", rank("v")).alias("best"))
        moved = written(
            nearest.select(F.col("u").alias("node"), F.when(rank("best") < rank("u"), F.col("best")).otherwise(F.col("u")).alias("to")), "moved"
        )
        at = lambda end: moved.select(F.col("node").alias(end), F.col("to").alias(f"{end}_to"))  # noqa: B023, E731
        left = written(_apart(left.join(at("u"), "u").join(at("v"), "v").select(F.col("u_to").alias("u"), F.col("v_to").alias("v"))), "edges")
        if found is None:
            found = moved
        else:
            later = moved.select(F.col("node").alias("to"), F.col("to").alias("later"))
            found = written(found.join(later, "to", "left").select("node", F.coalesce("later", "to").alias("to")), "found")
    else:
        raise RuntimeError("components haven't come together in 200 rounds")
    if found is None:
        return left.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.select("node", F.col("to").alias("component"))


def _apart(edges: DataFrame) -> DataFrame:
    """Distinct edges (u, v), u < v, between different nodes."""
    return edges.where("u != v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
