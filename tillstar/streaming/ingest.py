"""The batch cleaners over a stream of landed files.

Cleaning and typing are stateless, so the same expressions serve both; there is
no watermark and no state, and every file is read once.
"""

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.cleaning import CLEANERS
from ..operators.typing import STAR


def clean_stream(
    spark: SparkSession, table: str, source: str, schema: StructType, out: str,
    checkpoint: str, fmt: str = "json",
) -> StreamingQuery:
    """Start a run that cleans, types and appends all files not yet taken, then stops.

    `checkpoint` must be shared storage; it makes a restarted run go on where the
    last one stopped, with no file lost or taken twice.
    """
    raw = spark.readStream.schema(schema).format(fmt).load(source)
    typed = STAR[table].apply(CLEANERS[table](raw))
    return (
        typed.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )
