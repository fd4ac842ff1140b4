"""Store records: one JSON object per store, and the document that counts them."""

import json
from collections.abc import Iterator
from urllib.request import Request, urlopen

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import scratch_path
from .readers import read_json_lines, read_json_objects


def scalar(document: Column, name: str) -> Column:
    """One top-level value of a JSON text, as text."""
    return F.get_json_object(document, f"$.{name}")


def store_count(spark: SparkSession, path: str) -> int:
    """`number_stores` of the count document."""
    value = spark.read.text(path, wholetext=True).select(
        scalar(F.col("value"), "number_stores").cast("bigint").alias("n")
    ).first()
    if value is None or value.n is None:
        raise ValueError(f"{path} holds no number_stores")
    return value.n


def read_stores(
    spark: SparkSession, path: str, schema: StructType, count: int | None = None,
    one_per_line: bool = True, broken: str | None = None, columns: list[str] | None = None,
) -> DataFrame:
    """Store objects landed as JSON, one per line or one per file.

    `count` keeps the ids 0 to count - 1. `broken` and `columns` are those of the reader.
    """
    with_index = StructType([StructField("index", StringType()), *schema.fields])
    read = read_json_lines if one_per_line else read_json_objects
    stores = read(spark, path, with_index, broken, columns)
    if count is not None:
        number = F.col("index").try_cast("bigint")
        wanted = (number >= 0) & (number < count)
        stores = stores.where(wanted | F.col(broken).isNotNull() if broken else wanted)
    return stores.drop("index")


def fetch_store_count(endpoint: str, headers: dict[str, str] | None = None, timeout: float = 30) -> int:
    """`number_stores` as an endpoint gives it: one request."""
    with urlopen(Request(endpoint, headers=headers or {}), timeout=timeout) as answer:
        return int(json.load(answer)["number_stores"])


def fetch_stores(
    spark: SparkSession, endpoint: str, schema: StructType, count: int,
    headers: dict[str, str] | None = None, tasks: int | None = None, timeout: float = 30,
    broken: str | None = None,
) -> DataFrame:
    """Store objects 0 to count - 1 from `endpoint`, where `{store_number}` is the id.

    Tasks each fetch a range of ids; a refused answer fails the task, which Spark runs
    again. The documents are landed in the shared folder, one per line, and read from
    there, so that no use fetches anew.
    """

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            documents = []
            for store_number in batch["id"]:
                url = endpoint.replace("{store_number}", str(store_number))
                with urlopen(Request(url, headers=headers or {}), timeout=timeout) as answer:
                    documents.append(" ".join(answer.read().decode().splitlines()))
            yield pd.DataFrame({"value": documents})

    path = scratch_path(spark, "fetched")
    spark.range(0, count, 1, tasks).mapInPandas(fetch, "value string").write.text(path)
    return read_json_lines(spark, path, schema, broken).drop("index")
