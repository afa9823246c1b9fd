"""Records of CSV files that are read in splits, line breaks inside quotes included.

Files are read as lines, so a large one is spread over many tasks. Whether a line begins a
record depends on how many quotes stand before it: an odd number leaves it inside quotes.
A first pass notes per split whether its quotes are odd and how many records begin in it
for both ways it may be entered; sums over the splits of a file, one row each, say how it
is entered and how many records came before. A second pass then numbers every line's
record. Only the lines of records that span several are brought together.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..ordering import ORD
from ..session import cut_lineage

_SUMMARY = "file STRING, split BIGINT, odd BOOLEAN, starts_outside BIGINT, starts_inside BIGINT, any_odd BOOLEAN, first STRING"
_LINES = "file STRING, number BIGINT, split BIGINT, row BIGINT, value STRING, whole BOOLEAN"


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], int, int]]:
    """``(file, split)`` and row range of each stretch of rows that belong together."""
    names, splits = batch.column("file").to_pylist(), batch.column("split").to_pylist()
    low = 0
    for high in range(1, len(names) + 1):
        if high == len(names) or (names[high], splits[high]) != (names[low], splits[low]):
            yield (names[low], splits[low]), low, high
            low = high


def _odd_quotes(values: pa.Array) -> np.ndarray:
    """Whether each line has an odd number of quotes."""
    return pc.count_substring(values, '"').to_numpy(zero_copy_only=False) % 2 == 1


def _inside(odd: np.ndarray, entered: bool) -> np.ndarray:
    """Whether each line begins inside quotes, and in the last place what follows does."""
    return np.concatenate([[entered], np.logical_xor.accumulate(odd) ^ entered])


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, int], list] = {}
    for batch in batches:
        odd = _odd_quotes(batch.column("value"))
        for key, low, high in _runs(batch):
            state = held.setdefault(key, [False, 0, 0, False, None if odd[low] else batch.column("value")[low].as_py()])
            inside = _inside(odd[low:high], state[0])
            within = int(inside[:-1].sum())
            # Entered inside quotes, exactly the other lines begin a record.
            state[:4] = [bool(inside[-1]), state[1] + high - low - within, state[2] + within, state[3] or bool(odd[low:high].any())]
    rows = [(*key, *state) for key, state in held.items()]
    columns = list(zip(*rows)) or [()] * 7
    types = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
    names = ["file", "split", "odd", "starts_outside", "starts_inside", "any_odd", "first"]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, int], tuple[bool, int, int]] = {}
    for batch in batches:
        odd, n = _odd_quotes(batch.column("value")), batch.num_rows
        numbers, rows, whole = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
        for key, low, high in _runs(batch):
            if key not in held:
                held[key] = (batch.column("entered")[low].as_py(), batch.column("before")[low].as_py(), 0)
            entered, before, row = held[key]
            inside = _inside(odd[low:high], entered)
            starts = ~inside[:-1]
            numbers[low:high] = before + np.cumsum(starts) - 1
            rows[low:high] = row + np.arange(high - low)
            whole[low:high] = starts & ~odd[low:high]
            held[key] = (bool(inside[-1]), before + int(starts.sum()), row + high - low)
        columns = [batch.column("file"), pa.array(numbers), batch.column("split"), pa.array(rows), batch.column("value"), pa.array(whole)]
        yield pa.RecordBatch.from_arrays(columns, ["file", "number", "split", "row", "value", "whole"])


def _lines(spark: SparkSession, path) -> DataFrame:
    paths = path if isinstance(path, str) else list(dict.fromkeys(path))
    return spark.read.text(paths, lineSep="\n").select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split")
    )


def _split_summaries(lines: DataFrame) -> DataFrame:
    """One row per split of the input, kept, since it is asked for several times.

    ``any_odd`` says that a line has an odd number of quotes, ``first`` is the first line if
    it has not, so that of the first split is the file's first record.
    """
    return cut_lineage(lines.mapInArrow(_summaries, _SUMMARY))


def csv_records(spark: SparkSession, path) -> DataFrame:
    """``(file, number, record)``: the text of every record, numbered from 0 in its file.

    Lines end with a line feed, with or without a carriage return before it. A quote that
    is never closed makes the rest of its file one record, as it does for any reader. A
    path that is given twice is read once.
    """
    lines = _lines(spark, path)
    return _records(lines, _split_summaries(lines))


def _records(lines: DataFrame, splits: DataFrame) -> DataFrame:
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    entered = splits.withColumn("entered", F.coalesce(F.sum(F.col("odd").cast("int")).over(before), F.lit(0)) % 2 == 1)
    starts = F.when(F.col("entered"), F.col("starts_inside")).otherwise(F.col("starts_outside"))
    entered = entered.withColumn("before", F.coalesce(F.sum(starts).over(before), F.lit(0)))
    # One row per split of the input: a broadcast keeps the lines where they are, in order.
    placed = lines.join(F.broadcast(entered.select("file", "split", "entered", "before")), ["file", "split"])
    numbered = placed.select("value", "file", "split", "entered", "before").mapInArrow(_numbered, _LINES)
    rows = numbered.filter("whole").select("file", "number", F.col("value").alias("record"))
    if not splits.filter("any_odd").isEmpty():  # else every line is a record and none has to be joined
        parts = F.array_sort(F.collect_list(F.struct("split", "row", "value")))
        joined = numbered.filter(~F.col("whole")).groupBy("file", "number").agg(F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("record"))
        rows = rows.unionByName(joined)
    return rows.withColumn("record", F.regexp_replace("record", "\r$", ""))


def _names(header: str) -> list[str]:
    """Column names of a header; repeated ones get their place behind them."""
    names = next(csv.reader([header.removeprefix("﻿")]), [])
    return [f"{name}{place}" if names.count(name) > 1 else name for place, name in enumerate(names)]


def _ddl(names: list[str]) -> str:
    return ", ".join("`" + name.replace("`", "``") + "` STRING" for name in names)


def read_csv_table(spark: SparkSession, path) -> DataFrame:
    """CSV files with headers as text columns and their read position.

    Files with equal headers are parsed together; those with others are united by name.
    The headers, one short text per kind of file, come to the driver.
    """
    lines = _lines(spark, path)
    splits = _split_summaries(lines)
    records = _records(lines, splits)
    begins = splits.filter("split = 0")
    if begins.filter("first IS NULL").isEmpty():
        heads = begins.select("file", F.regexp_replace("first", "\r$", "").alias("header"))
    else:  # a header of several lines
        heads = records.filter("number = 0").select("file", F.col("record").alias("header"))
    kinds = sorted(r["header"] for r in heads.select("header").distinct().collect())
    body = records.filter("number > 0 AND record <> ''")
    table = None
    for kind in kinds:
        names = _names(kind)
        mine = body if len(kinds) == 1 else body.join(heads.filter(F.col("header") == kind).select("file"), "file", "left_semi")
        parsed = mine.select(
            F.from_csv("record", _ddl(names), {"escape": '"', "multiLine": "true"}).alias("r"),
            F.struct("file", F.lit(0).cast("bigint").alias("split"), F.col("number").alias("row")).alias(ORD),
        )
        rows = parsed.select(*[F.col("r")[name].alias(name) for name in names], ORD)
        table = rows if table is None else table.unionByName(rows, allowMissingColumns=True)
    if table is None:
        return spark.createDataFrame([], f"{ORD} STRUCT<file: STRING, split: BIGINT, row: BIGINT>")
    return table
