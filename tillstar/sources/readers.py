"""File readers. Every column a source has is kept, as text and by name.

Columns a table needs must be there (pages may lack some). Input that can't be read, a
line or document that is no JSON or a CSV row with more fields than the header, ends the
read, unless the caller names a column to keep it in (`broken`): then it becomes a row of
nulls with its text there, for `quarantine` to report and the cleaners to leave out.
"""

from collections.abc import Callable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructField, StructType

from . import ranges

#: Bytes from which a file that is one record, or whose records hold line breaks, is read by
#: ranges: one task would take long over it, and one record can't hold 2 GB.
LARGE_FILE = 256 << 20


def text_schema(*columns: str) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


# The columns of the raw tables that the engine works on.
RAW_SCHEMAS = {
    "users": text_schema(
        "first_name", "last_name", "date_of_birth", "country", "country_code", "join_date", "user_uuid"
    ),
    "cards": text_schema("card_number", "expiry_date", "date_payment_confirmed"),
    "stores": text_schema(
        "longitude", "lat", "locality", "store_code", "staff_numbers", "opening_date",
        "store_type", "latitude", "country_code", "continent",
    ),
    "products": text_schema(
        "product_price", "weight", "EAN", "date_added", "uuid", "removed", "product_code"
    ),
    "orders": text_schema(
        "first_name", "last_name", "1", "date_uuid", "user_uuid", "card_number", "store_code",
        "product_code", "product_quantity",
    ),
    "dates": text_schema("timestamp", "month", "year", "day", "time_period", "date_uuid"),
}

# Texts that mean "missing" in a CSV file (the pandas defaults).
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


#: Where the job keeps the text of input that can't be read.
BROKEN = "broken_input"


def _names(needed: StructType, found: list[str], path: str) -> list[str]:
    """The needed columns, then whatever else is there."""
    missing = [c for c in needed.fieldNames() if c not in found]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}")
    return [*needed.fieldNames(), *(c for c in found if c not in needed.fieldNames())]


def _checked(df: DataFrame, mark: str, broken: str | None) -> DataFrame:
    """`df`, whose column `mark` is set where input is broken, with `mark` called `broken`;
    without that name such a row is an error."""
    if broken:
        return df.withColumnRenamed(mark, broken)
    # Another column beside the mark, as sources won't read the mark alone.
    beside = F.coalesce(F.col(f"`{df.columns[0]}`").cast("string"), F.lit(""))
    error = F.raise_error(F.concat(F.lit("broken input: "), F.substring(mark, 1, 1000), F.lit(" "), beside)).cast("boolean")
    return df.where(F.when(F.col(mark).isNull(), True).otherwise(error)).drop(mark)


def read_csv(
    spark: SparkSession, path: str, schema: StructType,
    null_tokens: tuple[str, ...] = NULL_TOKENS, multi_line: bool = False, broken: str | None = None,
) -> DataFrame:
    """CSV with a header; each of `null_tokens` reads as null.

    Columns go by the header's names (`_c0` for an empty one), in any order, all files the same. A row with fewer
    fields ends in nulls. `multi_line` allows line breaks inside quotes: a file is then read by
    one task, or from `LARGE_FILE` bytes on by ranges, its records put together by quote parity
    (headers of such files aren't compared).
    """
    # Rows are checked whole, whichever columns are asked for.
    options = {"header": True, "escape": '"', "multiLine": multi_line, "columnPruning": False}
    header = spark.read.options(**options).csv(path).columns  # looks at one line
    # Every file's header is compared, unless Spark had to make up a name for an empty one.
    options["enforceSchema"] = any(c == f"_c{i}" for i, c in enumerate(header))
    names = _names(schema, header, path)
    mark = _free("unread", header)
    full = text_schema(*header, mark)
    df = spark.read.options(**options, columnNameOfCorruptRecord=mark).schema(full).csv(path)
    cut = None
    if multi_line:
        lines = ranges.pieces(spark, path, ranges.CSV_LINES, LARGE_FILE)
        if not lines.isEmpty():
            found, cut = ranges.csv_records(lines)
            parsed = F.from_csv("value", ", ".join(f"`{c}` string" for c in full.fieldNames()), {"escape": '"', "columnNameOfCorruptRecord": mark})
            df = df.where(F.col("_metadata.file_size") < LARGE_FILE).unionByName(found.select(parsed.alias("row")).select("row.*"))
    # Rows that are too short are marked as well; only surplus fields are an error.
    commas = F.regexp_count(F.regexp_replace(mark, r'"([^"]|"")*"', ""), F.lit(","))
    surplus = F.when(commas >= len(header), F.col(mark))
    tokens = list(null_tokens)
    texts = [F.when(~F.col(f"`{c}`").isin(tokens) & surplus.isNull(), F.col(f"`{c}`")).alias(c) for c in names]
    rows = df.select(*texts, surplus.alias(mark))
    if cut is not None:  # a large file that ends in quotes is shown by its path
        rows = rows.unionByName(_unread(cut, mark), allowMissingColumns=True)
    return _checked(rows, mark, broken)


def _unread(paths: DataFrame, mark: str) -> DataFrame:
    return paths.select(F.col("path").alias(mark))


def _json(
    spark: SparkSession, path: str, schema: StructType, multi_line: bool, broken: str | None, columns: list[str] | None,
) -> DataFrame:
    mark = "unread"
    if columns is None:
        found = spark.read.options(multiLine=multi_line, primitivesAsString=True, columnNameOfCorruptRecord=mark).json(path)
        columns = [c for c in found.columns if c != mark]
    names = list(dict.fromkeys([*schema.fieldNames(), *columns]))
    read = spark.read.options(multiLine=multi_line, columnNameOfCorruptRecord=mark)
    return _checked(read.schema(text_schema(*names, mark)).json(path), mark, broken)


def read_json_lines(
    spark: SparkSession, path: str, schema: StructType, broken: str | None = None, columns: list[str] | None = None,
) -> DataFrame:
    """One JSON object per line; splits freely. What columns there are besides those of
    `schema` is found in a pass over the lines, unless `columns` lists them."""
    return _json(spark, path, schema, False, broken, columns)


def read_json_objects(
    spark: SparkSession, path: str, schema: StructType, broken: str | None = None, columns: list[str] | None = None,
) -> DataFrame:
    """Files that each hold one JSON object, or an array of them, over several lines."""
    return _json(spark, path, schema, True, broken, columns)


def read_json_columns(
    spark: SparkSession, path: str, schema: StructType, one_per_line: bool = False,
    aligned: bool = False, broken: str | None = None, columns: list[str] | None = None, large_file: int | None = None,
) -> DataFrame:
    """Column-oriented documents, `{column: {row: value}}`, to rows.

    A document is one record to Spark, so a big table should land as many
    documents: files, or lines of one (`one_per_line`). Where all columns of a
    document list the same row labels in the same order, as writers of this layout
    do, its columns are zipped in place; any other document is matched up by row
    label, inside its record too, so nothing shuffles. `aligned` says that there is
    none of the latter, and raises if it is wrong. `columns` lists the columns beyond
    those of `schema`; without it they are found in a pass over the documents.

    Files of `large_file` bytes (`LARGE_FILE`) or more that hold one document are read by ranges, by
    many tasks (`ranges`); such a document that can't be read is shown by its path.
    """
    raw = spark.read.text(path, wholetext=not one_per_line)
    limit = LARGE_FILE if large_file is None else large_file
    if not one_per_line:
        large = ranges.pieces(spark, path, ranges.JSON_COLUMNS, limit)
        if not large.isEmpty():
            rows, unread = ranges.json_columns(large, schema.fieldNames(), columns)
            mark = _free("unread", rows.columns)
            rows = rows.withColumn(mark, F.lit(None).cast("string")).unionByName(_unread(unread, mark), allowMissingColumns=True)
            rows = _checked(rows, mark, broken)
            small = raw.where(F.col("_metadata.file_size") < limit)
            rest = _documents(small, schema, aligned, broken, columns)
            texts = [c for c in dict.fromkeys([*rows.columns, *rest.columns]) if c != broken] + [broken] * bool(broken)
            return rows.unionByName(rest, allowMissingColumns=True).select(*(F.col(f"`{c}`") for c in texts))
    return _documents(raw, schema, aligned, broken, columns)


def _free(name: str, taken: list[str]) -> str:
    while name in taken:
        name += "_"
    return name


def _documents(raw: DataFrame, schema: StructType, aligned: bool, broken: str | None, columns: list[str] | None) -> DataFrame:
    """The rows of documents that are one record each."""
    raw = raw.where(F.trim("value") != "")
    document = F.from_json("value", MapType(StringType(), MapType(StringType(), StringType())))
    docs = raw.select(F.col("value"), document.alias("doc"))
    if columns is None:
        found = docs.select(F.explode(F.map_keys("doc"))).distinct()
        columns = sorted(r[0] for r in found.collect())  # a row per column name
    names = list(dict.fromkeys([*schema.fieldNames(), *columns]))
    empty = F.create_map().cast("map<string,string>")
    parts = [F.coalesce(F.try_element_at("doc", F.lit(n)), empty) for n in names]
    # Of each column by its place, as names may hold any character.
    cells = docs.select("value", "doc", *(p.alias(f"c{i}") for i, p in enumerate(parts)))
    maps = [F.col(f"c{i}") for i in range(len(names))]
    present = F.filter(F.array(*(F.map_keys(m) for m in maps)), lambda k: F.size(k) > 0)
    same = F.size(F.array_distinct(present)) <= 1
    labels = F.array_distinct(F.flatten(present))

    def lined_up(m: Column, i: int) -> Column:
        """The column's values in order of the labels; null where it lacks one."""
        entry = lambda k, v: F.struct(k.alias("key"), v.alias("value"))
        lacking = F.transform(F.array_except("labels", F.map_keys(m)), lambda k: entry(k, F.lit(None).cast("string")))
        own = F.transform(F.map_entries(m), lambda e: entry(e["key"], e["value"]))
        return F.transform(F.array_sort(F.concat(own, lacking)), lambda e: e["value"]).alias(f"c{i}")

    zipped = F.arrays_zip(*(F.map_values(m).alias(f"c{i}") for i, m in enumerate(maps)))
    # A column that a document lacks altogether zips as nulls.
    matched = F.arrays_zip(*(lined_up(m, i) for i, m in enumerate(maps)))
    if aligned:
        matched = F.raise_error(F.lit("the columns of a document list different rows")).cast(_zip_type(len(names)))
    rows = F.when(F.col("doc").isNotNull(), F.when(F.col("same"), zipped).otherwise(matched))
    nothing = F.array(F.struct(*(F.lit(None).cast("string").alias(f"c{i}") for i in range(len(names)))))
    mark = _free("unread", names)
    read = cells.withColumns({"labels": labels, "same": same}).select(
        F.when(F.col("doc").isNull(), F.col("value")).alias("mark"),
        F.coalesce(rows, nothing).alias("rows"),
    )
    flat = read.select("mark", F.inline("rows")).toDF(mark, *names).select(*(F.col(f"`{n}`") for n in [*names, mark]))
    return _checked(flat, mark, broken)


def _zip_type(n: int) -> str:
    return "array<struct<" + ",".join(f"c{i}:string" for i in range(n)) + ">>"


def read_parquet(spark: SparkSession, path: str, schema: StructType, broken: str | None = None) -> DataFrame:
    """Parquet; needed columns as text, others as they are."""
    df = spark.read.parquet(path)
    kinds = {f.name: f.dataType for f in schema}
    read = df.select(*(
        F.col(f"`{c}`").cast(kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`") for c in _names(schema, df.columns, path)
    ))
    return read.withColumn(broken, F.lit(None).cast("string")) if broken else read


READERS: dict[str, Callable[..., DataFrame]] = {
    "csv": read_csv, "json": read_json_columns, "jsonl": read_json_lines, "parquet": read_parquet,
}


def load(
    spark: SparkSession, path: str, schema: StructType, fmt: str | None = None, broken: str | None = None
) -> DataFrame:
    """Read a file or folder by its extension, or by `fmt`; an unknown one raises ValueError."""
    fmt = fmt or path.rstrip("/").rsplit("/", 1)[-1].rpartition(".")[2].lower()
    if fmt not in READERS:
        raise ValueError(f"no reader for {path!r}: extension must be one of {sorted(READERS)}")
    return READERS[fmt](spark, path, schema, broken=broken)


def stack_pages(pages: list[DataFrame]) -> DataFrame:
    """Page tables on top of each other by column name; columns a page lacks become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pages)


def read_pages(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", broken: str | None = None
) -> DataFrame:
    """All page files under `path` by column name, as text; absent columns become null.

    One scan with the files' merged schema. Parquet pages that give one column different
    types are read one scan per schema.
    """
    if fmt == "json":
        return _json(spark, path, schema, False, broken, None)
    if fmt != "parquet":
        raise ValueError("pages are read as parquet or json; stack other formats with stack_pages")
    try:
        pages = [spark.read.options(recursiveFileLookup=True, mergeSchema=True).parquet(path)]
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE" not in str(error):
            raise
        alike: dict[str, list[str]] = {}
        for file in spark.read.option("recursiveFileLookup", True).parquet(path).inputFiles():
            alike.setdefault(spark.read.parquet(file).schema.json(), []).append(file)
        pages = [spark.read.parquet(*files) for files in alike.values()]
    texts = [df.select(*(F.col(f"`{c}`").cast("string").alias(c) for c in df.columns)) for df in pages]
    stacked = stack_pages(texts)
    lacking = {c: F.lit(None).cast("string") for c in schema.fieldNames() if c not in stacked.columns}
    if broken:
        lacking[broken] = F.lit(None).cast("string")
    whole = stacked.withColumns(lacking) if lacking else stacked
    return whole.select(*(F.col(f"`{c}`") for c in _names(schema, whole.columns, path)))
