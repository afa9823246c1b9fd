"""Chromosome sizes from FASTA text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..violations import violation_rows

PIECE_COLUMNS = "file STRING, split BIGINT, piece BIGINT, name STRING, length BIGINT"
PIECES = pa.schema(
    [("file", pa.string()), ("split", pa.int64()), ("piece", pa.int64()), ("name", pa.string()), ("length", pa.int64())]
)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Length of each stretch of lines between two headers, within one file split.

    Stretches that start inside a sequence have no name yet. The only state kept between
    batches is the stretch that is still open.
    """
    open_piece: dict | None = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        lines = pc.utf8_trim_whitespace(batch.column("value"))
        header = np.asarray(pc.starts_with(lines, ">"), dtype=bool)
        lengths = np.where(header, 0, np.asarray(pc.utf8_length(lines), dtype=np.int64))
        file = np.asarray(batch.column("file").dictionary_encode().indices)
        split = np.asarray(batch.column("split"))
        begins = header.copy()
        begins[0] = True
        begins[1:] |= (file[1:] != file[:-1]) | (split[1:] != split[:-1])
        starts = np.flatnonzero(begins)
        closed = []
        for start, total in zip(starts.tolist(), np.add.reduceat(lengths, starts).tolist()):
            place = {"file": batch.column("file")[start].as_py(), "split": int(split[start])}
            same = open_piece is not None and place.items() <= open_piece.items()
            if same and not header[start]:
                open_piece["length"] += total
                continue
            if open_piece is not None:
                closed.append(open_piece)
            words = lines[start].as_py()[1:].split(maxsplit=1) if header[start] else None
            open_piece = place | {
                "piece": open_piece["piece"] + 1 if same else 0,
                "name": None if words is None else "".join(words[:1]),
                "length": total,
            }
        yield pa.RecordBatch.from_pylist(closed, schema=PIECES)
    if open_piece is not None:
        yield pa.RecordBatch.from_pylist([open_piece], schema=PIECES)


def sequence_pieces(spark: SparkSession, path) -> DataFrame:
    """Named and unnamed stretches of every split of the FASTA files.

    Only these few rows are shuffled afterwards; sequence text never leaves the task
    that read it, and a chromosome of any length is cut at split borders.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        "value",
    )
    return lines.mapInArrow(_pieces, PIECE_COLUMNS)


def _named(pieces: DataFrame) -> DataFrame:
    """Give stretches that start inside a sequence the name of the last header before.

    The window runs over one row per split, not over sequences.
    """
    per_split = pieces.groupBy("file", "split").agg(
        F.max(F.when(F.col("name").isNotNull(), F.struct("split", "piece", "name"))).alias("_last"),
    )
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_split.select(
        "file", "split", F.last("_last", ignorenulls=True).over(before).alias("_open")
    )
    return pieces.join(carried, ["file", "split"]).select(
        "file",
        F.when(F.col("name").isNotNull(), F.struct("split", "piece", "name")).otherwise(F.col("_open")).alias("seq"),
        "length",
    )


def chromosome_sizes(spark: SparkSession, path) -> DataFrame:
    """``file, name, size`` and the position of each sequence in its file."""
    return (
        _named(sequence_pieces(spark, path))
        .filter(F.col("seq").isNotNull())
        .groupBy("file", "seq")
        .agg(F.sum("length").alias("size"))
        .select("file", F.struct("seq.split", "seq.piece").alias("position"), F.col("seq.name").alias("name"), "size")
    )


def _listed(spark: SparkSession, path) -> list[str]:
    """Every file of the paths by its status, files of no bytes included."""
    found = []
    for pattern in [path] if isinstance(path, str) else path:
        location = spark._jvm.org.apache.hadoop.fs.Path(str(pattern))
        system = location.getFileSystem(spark._jsc.hadoopConfiguration())
        for status in system.globStatus(location) or []:
            within = system.listFiles(status.getPath(), True)
            while within.hasNext():
                file = within.next().getPath()
                if not file.getName().startswith(("_", ".")):
                    found.append(file.toString())
    return found


def fasta_violations(spark: SparkSession, path) -> DataFrame:
    """Files with sequence before the first header, or without any sequence."""
    named = _named(sequence_pieces(spark, path))
    orphan = named.filter(F.col("seq").isNull() & (F.col("length") > 0)).select("file").distinct()
    files = spark.createDataFrame([(f,) for f in _listed(spark, path)], "file STRING")
    with_header = named.filter(F.col("seq").isNotNull()).select(F.regexp_replace("file", "^file:/+", "/").alias("file"))
    empty = files.select(F.regexp_replace("file", "^file:/+", "/").alias("file")).join(with_header, "file", "left_anti")
    return violation_rows(orphan, "fasta", F.col("file"), F.lit("sequence before header")).unionByName(
        violation_rows(empty, "fasta", F.col("file"), F.lit("no sequences"))
    )


def write_sizes(sizes: DataFrame, path: str) -> None:
    """Two-column size tables, one folder per genome file, in file order."""
    (
        sizes.repartitionByRange("file", "position")
        .sortWithinPartitions("file", "position")
        .select(F.sha2("file", 256).alias("genome"), F.concat_ws("\t", "name", "size").alias("line"))
        .write.mode("overwrite")
        .partitionBy("genome")
        .text(path)
    )
