"""Large files whose records have no line ends to split at, read by many tasks.

Spark's text reader takes any separator, so a file can be read as the pieces between
commas (a column-oriented JSON document) or line ends (CSV with line breaks in quotes), in
byte ranges like any other text. A separator may stand in a string or a nested value, and a
range may begin in one. So, in this order:

1. Every range tells whether it ends in a string and how many levels it opens or closes,
   both for beginning outside a string and for beginning inside.
2. Going through a file's ranges in order (a row each) gives the state in which each begins.
3. Every range then cuts its pieces into records. One that goes on beyond its range is kept
   as fragments, and JSON entries before the first column name of a range wait for that name;
   both are settled from a few rows per range.
4. Entries of a JSON document meet by row label in one shuffle and become rows.

A cut or malformed document gives no rows, and is reported by its path.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

#: A string, or one that is open at the end.
STRING = re.compile(r'"(?:[^"\\]++|\\.)*+(?:"|\\?\Z)', re.S)
#: Put behind a text, its last character is outside strings only if the text ends inside one.
PROBE = ',"\0'
NAME = r'"(?:[^"\\]|\\.)*"'
_ENTRY = rf"\s*(?P<label>{NAME})\s*:\s*(?P<value>\S.*?)"
_COLUMN = rf"\s*(?P<column>{NAME})\s*:\s*\{{(?:{_ENTRY})?"
#: What stands between two commas that are in no value, by the level it begins at; its
#: closing braces are cut off before.
SEGMENTS = [re.compile(rf"{body}\s*", re.S) for body in (rf"\s*\{{(?:{_COLUMN})?", _COLUMN, _ENTRY)]
#: The commonest segment: an entry alone, of a plain value.
ENTRY = re.compile(rf'\s*({NAME})\s*:\s*({NAME}|[^\s"{{}}\[\],]+)\s*', re.S)

#: Bytes of a row group of what is kept between steps: a task holds one as it writes, and one as it reads.
ROW_GROUP = 16 << 20
#: Entries of a JSON document that one task sorts by row.
TASK_ENTRIES = 1 << 19

#: (column that begins, label, value) of a record.
Record = tuple[str | None, str | None, str | None]


@dataclass(frozen=True)
class Layout:
    """How records are told apart: what separates pieces, whether a string is open behind a
    piece and how many levels it opens, the level below which a separator ends a record, and
    what a record between two levels holds (ValueError: nothing that may stand there).
    `entry` matches pieces that are a record by themselves at the deepest level."""

    separator: str
    passed: Callable[[str, bool], tuple[bool, int]]
    deepest: int
    read: Callable[[str, int, int], Record]
    entry: re.Pattern | None = None


def json_passed(piece: str, inside: bool) -> tuple[bool, int]:
    outside = STRING.sub("", f'"{piece}{PROBE}' if inside else piece + PROBE)
    return outside.endswith("\0"), outside.count("{") + outside.count("[") - outside.count("}") - outside.count("]")


def json_string(text: str) -> str:
    return json.loads(text, strict=False) if "\\" in text else text[1:-1]


def json_text(value: str) -> str | None:
    """A JSON value as the other readers show it: text as it reads, null as None, nested values
    without white space."""
    if value[0] == '"' and "\\" not in value and value.find('"', 1) == len(value) - 1:
        return value[1:-1]
    read = json.loads(value, strict=False)
    if isinstance(read, str) or read is None:
        return read
    return json.dumps(read, separators=(",", ":"), ensure_ascii=False) if isinstance(read, (dict, list)) else value


def json_record(text: str, before: int, after: int) -> Record:
    if before == after == 2 and (plain := ENTRY.fullmatch(text)):
        return None, json_string(plain[1]), json_text(plain[2])
    if not 0 <= after <= 2 or not 0 <= before <= 2:
        raise ValueError("more levels than a column-oriented document has")
    body = text.rstrip()
    if before == after == 0 and not body:
        return None, None, None  # an empty file, or white space behind a document
    shape = SEGMENTS[before]
    for level in range(2, -1, -1):  # a value may end in braces of its own, so these are counted
        if level >= after and (found := shape.fullmatch(body)):
            names = found.groupdict()
            column, label = (json.loads(names[n], strict=False) if names.get(n) else None for n in ("column", "label"))
            reached = 2 if label is not None or column is not None else before + (before == 0)
            if reached - (2 - level) == after:
                return column, label, json_text(names["value"]) if label is not None else None
        if not body.endswith("}"):
            break
        body = body[:-1].rstrip()
    raise ValueError("no part of a column-oriented document")


def csv_passed(piece: str, inside: bool) -> tuple[bool, int]:
    return inside != (piece.count('"') % 2 == 1), 0  # a quote in quotes is two


JSON_COLUMNS = Layout(",", json_passed, 2, json_record, ENTRY)
CSV_LINES = Layout("\n", csv_passed, 0, lambda text, before, after: (None, "", text.removesuffix("\r")))

SUMMARY = "path string, start long, inside0 boolean, levels0 long, inside1 boolean, levels1 long, pieces long"
STATES = "path string, start long, inside boolean, level long, pieces long, sound boolean"
FOUND = "kind string, path string, column string, label string, value string, start long, level long"
SETTLED = "kind string, path string, column string, label string, value string, start long"


def _schema(columns: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in map(str.split, columns.split(", "))])


def _by_range(batches, *others: str) -> Iterator[tuple[tuple[str, int], list[str], tuple]]:
    """Arrow batches of ordered pieces as ((path, start), values, the first row's `others`), a
    range maybe in portions."""
    for batch in batches:
        if not batch.num_rows:
            continue
        paths, starts = batch.column("path").dictionary_encode(), batch.column("start").to_numpy()
        places = paths.indices.to_numpy()
        ends = [*(np.flatnonzero((np.diff(starts) != 0) | (np.diff(places) != 0)) + 1), batch.num_rows]
        values, low = batch.column("value").to_pylist(), 0
        for high in ends:
            first = tuple(batch.column(c)[int(low)].as_py() for c in others)
            yield (paths.dictionary[int(places[low])].as_py(), int(starts[low])), values[low:high], first
            low = high


def _summaries(layout: Layout):
    """How each range ends, begun outside (0) and inside (1) a string, and how many pieces it has."""
    schema = _schema(SUMMARY)

    def run(batches):
        key, states, pieces = None, None, 0

        def done():
            (i0, n0), (i1, n1) = states
            row = {"path": key[0], "start": key[1], "inside0": i0, "levels0": n0, "inside1": i1, "levels1": n1, "pieces": pieces}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for at, values, _ in _by_range(batches):
            if at != key:
                if key:
                    yield done()
                key, states, pieces = at, [(False, 0), (True, 0)], 0
            pieces += len(values)
            text = layout.separator.join(values)  # a separator changes no state
            states = [(inside, levels + n) for was, levels in states for inside, n in [layout.passed(text, was)]]
        if key:
            yield done()

    return run


def _states(ranges: pd.DataFrame) -> pd.DataFrame:
    """How each range of a file begins, and whether the file's end closes all that was opened."""
    inside, level, out = False, 0, []
    for r in ranges.sort_values("start").to_dict("records"):
        out.append((r["path"], r["start"], inside, level, r["pieces"]))
        inside, level = bool(r[f"inside{int(inside)}"]), level + r[f"levels{int(inside)}"]
    return pd.DataFrame([(*row, not inside and level == 0) for row in out], columns=["path", "start", "inside", "level", "pieces", "sound"])


def _records(layout: Layout):
    """Rows of FOUND from ordered pieces that know how their range begins.

    `entry`: a record (column None: the one the range begins in; label '1' for the first of a
    CSV file, which is its header). `range`: the last column that begins in a range. `tail`, `head`, `middle`: a record's text up to
    the end of its range, from the beginning of one, or all of a range that lies in one. `bad`: what
    can't be read.
    """
    schema, entry = _schema(FOUND), layout.entry

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [()] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    def run(batches):
        key, parts, head, begins, column, inside, level, first = None, [], False, 0, None, False, 0, False

        def end() -> list[tuple]:
            path, start = key
            kind, label = "middle" if head else "tail", "1" if first else None
            left = [(kind, path, None, label, layout.separator.join(parts), start, begins)] if parts else []
            return [("range", path, column, None, None, start, None), *left]

        for found, values, (was_inside, was_level) in _by_range(batches, "inside", "level"):
            out = []
            if found != key:
                out += end() if key else []
                key, parts, column = found, [], None
                inside, level = was_inside, was_level
                begins, head, first = level, inside or level > layout.deepest, found[1] == 0
            path, start = key
            for piece in values:
                if entry and level == layout.deepest and not parts and not inside and (plain := entry.fullmatch(piece)):
                    try:
                        out.append(("entry", path, column, json_string(plain[1]), json_text(plain[2]), start, None))
                        first = False
                    except ValueError:
                        out.append(("bad", path, None, None, None, None, None))
                    continue
                inside, levels = layout.passed(piece, inside)
                level += levels
                parts.append(piece)
                if inside or level > layout.deepest:
                    continue
                text = layout.separator.join(parts)
                if head:
                    out.append(("head", path, None, None, text, start, level))
                else:
                    try:
                        opened, label, value = layout.read(text, begins, level)
                        if opened is not None:
                            column = opened
                            out.append(("column", path, column, None, None, start, None))
                        if label is not None:
                            out.append(("entry", path, column, "1" if first and layout is CSV_LINES else label, value, start, None))
                            first = False
                    except ValueError:
                        out.append(("bad", path, None, None, None, None, None))
                parts, head, begins = [], False, level
            yield batch_of(out)
        if key:
            yield batch_of(end())

    return run


def _settled(layout: Layout):
    """Of a file's ranges and fragments: its records that lie in more than one range, and the
    column in which each range begins (`begun`)."""
    order = {"head": 0, "middle": 0, "range": 1, "tail": 2}

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out, column, pending = [], None, None
        rows = rows.assign(order=rows["kind"].map(order)).sort_values(["start", "order"])
        for r in rows.to_dict("records"):
            path, start = r["path"], r["start"]
            if r["kind"] == "range":
                out.append(("begun", path, column, None, None, start))
                column = column if r["column"] is None else r["column"]
            elif r["kind"] == "tail":
                pending = r
            elif pending is None:
                out.append(("bad", path, None, None, None, start))
            else:
                pending["value"] += layout.separator + r["value"]
                if r["kind"] == "head":
                    try:
                        opened, label, value = layout.read(pending["value"], int(pending["level"]), int(r["level"]))
                        if opened is not None:
                            column = opened
                            out.append(("column", path, column, None, None, start))
                        if label is not None:
                            out.append(("entry", path, column, "1" if pending["label"] == "1" and layout is CSV_LINES else label, value, pending["start"]))
                    except ValueError:
                        out.append(("bad", path, None, None, None, start))
                    pending = None
        if pending is not None:
            # The file's last record: no separator stands behind it.
            out.append(("bad", pending["path"], None, None, None, pending["start"]))
        return pd.DataFrame(out, columns=["kind", "path", "column", "label", "value", "start"])

    return run


def pieces(spark: SparkSession, path: str, layout: Layout, least_bytes: int = 0) -> DataFrame:
    """What stands between separators in the files of `least_bytes` or more, in order, with
    file and range."""
    read = spark.read.text(path, lineSep=layout.separator).where(F.col("_metadata.file_size") >= least_bytes)
    return read.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value")


def records(text: DataFrame, layout: Layout) -> tuple[DataFrame, DataFrame, int]:
    """(records, broken, pieces): kind, path (a number that stands for it), column, label and value of the
    records (kind `entry`) and columns (kind `column`) of sound files, the paths of the others, and how many pieces the sound ones have."""
    spark = text.sparkSession

    def kept(df: DataFrame, name: str) -> DataFrame:
        at = scratch_path(spark, name)
        df.write.option("parquet.block.size", ROW_GROUP).parquet(at)
        return spark.read.schema(df.schema).parquet(at)

    ends = text.mapInArrow(_summaries(layout), SUMMARY).groupBy("path").applyInPandas(_states, STATES)
    numbered = F.min("row").over(Window.partitionBy("path")).cast("string")
    states = kept(ends.withColumn("row", F.monotonically_increasing_id()).withColumn("file", numbered).drop("row"), "ranges")
    # From here on `path` is a file's number: paths are longer than most records. Broadcast: a row for
    # each range of many megabytes. Of a file that is cut, a string left open would run through all
    # that follows, so nothing is cut out of it.
    sound = states.where("sound").drop("sound")
    pieces = sound.agg(F.sum("pieces")).first()[0] or 0
    placed = text.join(F.broadcast(sound.drop("pieces")), ["path", "start"]).drop("path").withColumnRenamed("file", "path")
    found = kept(placed.mapInArrow(_records(layout), FOUND), "found")
    edges = found.where("kind in ('range', 'head', 'middle', 'tail')")
    settled = kept(edges.groupBy("path").applyInPandas(_settled(layout), SETTLED), "settled")
    every = found.where("kind in ('entry', 'column', 'bad')").drop("level").unionByName(settled.where("kind in ('entry', 'column', 'bad')"))
    begun = settled.where("kind = 'begun'").select("path", "start", F.col("column").alias("begun"))
    bad = every.where("kind = 'bad'").select("path").distinct()
    unread = F.broadcast(bad.withColumnRenamed("path", "file"))
    broken = states.where("not sound").select("path").union(states.join(unread, "file", "left_semi").select("path")).distinct()
    entries = every.where("kind != 'bad'").join(F.broadcast(begun), ["path", "start"], "left").select(
        "kind", "path", F.coalesce("column", "begun").alias("column"), "label", "value"
    )
    # Broadcast: a row per file. A shuffle by file would bring all of a large one to a single task.
    return entries.join(F.broadcast(bad), "path", "left_anti"), broken, pieces


def json_columns(text: DataFrame, needed: list[str], columns: list[str] | None) -> tuple[DataFrame, DataFrame]:
    """(rows, broken): the rows of the documents whose pieces are `text`, with the columns
    `needed` and, if `columns` doesn't list them, whatever else there is; paths of broken ones."""
    entries, broken, pieces = records(text, JSON_COLUMNS)
    if columns is None:
        columns = sorted(r[0] for r in entries.select("column").distinct().collect())  # a row per column name
    names = list(dict.fromkeys([*needed, *columns]))
    cells = [F.max(F.when(F.col("column") == n, F.col("value"))).alias(f"c{i}") for i, n in enumerate(names)]
    # By number, as partitions sized by compressed bytes don't fit in memory when they are sorted.
    tasks = max(text.sparkSession.sparkContext.defaultParallelism, pieces // TASK_ENTRIES)
    dealt = entries.where("kind = 'entry'").repartition(tasks, "path", "label")
    return dealt.groupBy("path", "label").agg(*cells).drop("path", "label").toDF(*names), broken


def csv_records(text: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, broken): the records of the files whose lines are `text`, each a `value` without its
    line end, headers and empty lines left out."""
    found, broken, _ = records(text, CSV_LINES)
    return found.where("kind = 'entry' AND label != '1' AND value != ''").select("value"), broken
