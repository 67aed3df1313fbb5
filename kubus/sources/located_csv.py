"""Delimited text read by header name, with each record's file and line.

The files' lines are landed once, with the file, the start of the split they
were read from and a row number that ascends within the split.  Everything
else is computed from the landed table, so later steps cannot disagree about
splits:

* line numbers: lines of the file's splits before, plus the row's place;
* records: a line that ends inside a quoted field goes on in the next one,
  also across splits.  Only files with such a line are scanned in order: each
  split for both states it may begin in, then the splits of a file in turn;
* columns: every file's own header gives the positions of the wanted names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ship, written

FILE, LINE = "source_file", "source_line"
# A longer record stems from a quote that is never closed; the limit is that of
# a field in Python's csv module.
MAX_RECORD_CHARS = 131_072
_QUOTED_REST = re.compile(r'[^"]*+(?:""[^"]*+)*+"')


def ends_inside(line: str, inside: bool, sep: str) -> bool:
    """Does a line that begins inside or outside a quoted field end inside one?"""
    at = 0
    while True:
        if not inside and line.startswith('"', at):
            inside, at = True, at + 1
        if inside:
            rest = _QUOTED_REST.match(line, at)
            if not rest:
                return True
            inside, at = False, rest.end()
        at = line.find(sep, at) + 1
        if not at:
            return False


def _complete(sep: str) -> str:
    """Java pattern of a line whose quoted fields are all closed."""
    other = rf"[^{re.escape(sep)}]"
    field = rf'(?:"[^"]*+(?:""[^"]*+)*+"{other}*+|(?!"){other}*+)'
    return rf"(?s)^{field}(?:{re.escape(sep)}{field})*+$"


def land(spark: SparkSession, path: str, encoding: str, sep: str) -> DataFrame:
    """(file, block, row, line, opens): the lines of all files below ``path``."""
    line = F.decode(F.col("value").cast("binary"), encoding)
    opens = F.when(F.contains("line", F.lit('"')), ~F.rlike("line", F.lit(_complete(sep))))
    return written(
        spark.read.option("recursiveFileLookup", True).text(path)
        .select(F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("row"), line.alias("line"))
        .withColumn("opens", F.coalesce(opens, F.lit(False))), "csv-lines")


def _numbered(lines: DataFrame) -> DataFrame:
    """``lines`` plus ``number`` (of the line in its file, from 1) and
    ``broken`` (does the file have a line that ends inside quotes)."""
    splits = lines.groupBy("file", "block").agg(
        F.min("row").alias("first"), F.count("*").alias("n"), F.max("opens").alias("opens"))
    file = Window.partitionBy("file")
    before = file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = written(splits.select(
        "file", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
        F.max("opens").over(file).alias("broken")), "csv-splits")
    return lines.join(splits, ["file", "block"]).withColumn(
        "number", F.col("before") + F.col("row") - F.col("first") + 1).drop("first", "before")


def _split_states(batches: Iterator[pa.RecordBatch], sep: str) -> Iterator[pa.RecordBatch]:
    """Sorted lines to one row a split: for a begin outside and inside quotes,
    the state at its end and the last line that begins a record."""
    key, states, lasts = None, [False, True], [None, None]
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("end0", pa.bool_()),
                        ("last0", pa.int64()), ("end1", pa.bool_()), ("last1", pa.int64())])

    def row() -> list[dict]:
        return [] if key is None else [{"file": key[0], "block": key[1], "end0": states[0],
                                        "last0": lasts[0], "end1": states[1], "last1": lasts[1]}]

    for batch in batches:
        done = []
        for file, block, number, line in zip(*(c.to_pylist() for c in batch.columns)):
            if (file, block) != key:
                done += row()
                key, states, lasts = (file, block), [False, True], [None, None]
            for k in (0, 1):
                if not states[k] and line:
                    lasts[k] = number
                states[k] = ends_inside(line, states[k], sep)
        yield pa.RecordBatch.from_pylist(done, schema)
    yield pa.RecordBatch.from_pylist(row(), schema)


def _in_turn(splits: pd.DataFrame) -> pd.DataFrame:
    """The state and the open record that each split of a file begins with."""
    inside, begun, rows = False, None, []
    for s in splits.sort_values("block").itertuples():
        rows.append((s.file, s.block, inside, begun))
        last = s.last1 if inside else s.last0
        inside = s.end1 if inside else s.end0
        begun = begun if pd.isna(last) else int(last)
    return pd.DataFrame(rows, columns=["file", "block", "inside", "begun"]).astype({"begun": "Int64"})


def _assigned(batches: Iterator[pa.RecordBatch], sep: str) -> Iterator[pa.RecordBatch]:
    """(file, number, line, record, alone): the line that a line's record begins
    with, and whether it is all of the record; empty lines between records go."""
    key, inside, record = None, False, None
    schema = pa.schema([("file", pa.string()), ("number", pa.int64()), ("line", pa.string()),
                        ("record", pa.int64()), ("alone", pa.bool_())])
    for batch in batches:
        rows = []
        for file, block, number, line, start, begun in zip(*(c.to_pylist() for c in batch.columns)):
            if (file, block) != key:
                key, inside, record = (file, block), start, begun
            if not inside:
                record = number
            after = ends_inside(line, inside, sep)
            if inside or line:
                rows.append({"file": file, "number": number, "line": line, "record": record,
                             "alone": not inside and not after})
            inside = after
        yield pa.RecordBatch.from_pylist(rows, schema)


def _joined_records(lines: DataFrame, sep: str) -> DataFrame:
    """(file, number, record) of files in which records span lines."""
    def in_order(rows: DataFrame) -> DataFrame:
        return rows.repartition("file", "block").sortWithinPartitions("file", "block", "number")

    splits = in_order(lines.select("file", "block", "number", "line")).mapInArrow(
        partial(_split_states, sep=sep),
        "file string, block long, end0 boolean, last0 long, end1 boolean, last1 long")
    starts = written(splits.groupBy("file").applyInPandas(
        _in_turn, "file string, block long, inside boolean, begun long"), "csv-states")
    parts = written(in_order(lines.join(starts, ["file", "block"]).select(
        "file", "block", "number", "line", "inside", "begun")).mapInArrow(
        partial(_assigned, sep=sep),
        "file string, number long, line string, record long, alone boolean"), "csv-parts")
    sizes = parts.where("not alone").groupBy("file", "record").agg(
        F.sum(F.length("line") + 1).alias("chars"))
    sized = parts.join(written(sizes, "csv-sizes"), ["file", "record"], "left")
    fits = F.coalesce(F.col("chars"), F.lit(0)) <= MAX_RECORD_CHARS
    whole = sized.where(~F.col("alone") & fits).groupBy("file", "record").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("number", "line"))), lambda x: x["line"]), "\n").alias("text"))
    single = sized.where((F.col("alone") | ~fits) & (F.col("line") != "")).select("file", "number", F.col("line").alias("text"))
    return single.unionByName(whole.select("file", F.col("record").alias("number"), "text"))


def _fields(text: Column, width: int, sep: str) -> Column:
    row = F.from_csv(text, ", ".join(f"c{i} string" for i in range(width)),
                     {"sep": sep, "quote": '"', "escape": '"', "nullValue": "\u0000", "mode": "PERMISSIVE"})
    return F.array(*[row[f"c{i}"] for i in range(width)])


def read_located_csv(spark: SparkSession, path: str, columns: tuple[str, ...],
                     encoding: str = "ISO-8859-1", sep: str = ";") -> DataFrame:
    """(``columns`` as text, source_file, source_line) of all files below ``path``.

    Columns are found by name in each file's own first line, in any order and
    beside others; of a repeated name the last counts.  A column the header
    lacks is null on every row of that file, as are the fields that a short
    line lacks; further fields are left out; a quoted empty field is the empty
    string, an unquoted one null.  A quoted field may hold separators, doubled
    quotes and line breaks (read back as ``\\n``); a record of over
    ``MAX_RECORD_CHARS`` that spans lines stems from an unclosed quote and is
    read line by line.  Empty lines are skipped but counted; ``source_line`` is
    the line of the file a record begins on (the header is line 1).  A file
    without a header line has no rows, one that begins with an empty line no
    columns.  The encoding must keep ASCII.
    """
    ship(spark)
    lines = _numbered(land(spark, path, encoding, sep))
    records = lines.where("not broken and line <> ''").select(
        "file", "block", "number", F.col("line").alias("text"))
    broken = lines.where("broken")
    if not broken.isEmpty():
        records = records.unionByName(written(_joined_records(broken, sep), "csv-records")
                                      .withColumn("block", F.lit(0).cast("long")))
    # The first line lies in the split at 0, which the landed table can skip to.
    firsts = written(records.where("block = 0 and number = 1").select("file", "text"), "csv-headers")
    width = firsts.agg(F.max(F.size(F.split("text", re.escape(sep)))).alias("n")).first()["n"] or 1
    names = F.reverse(_fields(F.col("text"), width, sep))

    def position(name: str) -> Column:
        back = F.array_position(names, name)
        return F.when(back > 0, F.lit(width) - back).cast("int")

    headers = written(firsts.select("file", *[position(c).alias(f"at_{i}") for i, c in enumerate(columns)]),
                      "csv-columns")
    found = records.where("number > 1").join(headers, "file", "left") \
        .withColumn("fields", _fields(F.col("text"), width, sep))
    return found.select(*[F.get("fields", F.col(f"at_{i}")).alias(c) for i, c in enumerate(columns)],
                        F.col("file").alias(FILE), F.col("number").alias(LINE))
