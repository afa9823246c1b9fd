"""File inventories with sizes and checksums."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK = 8 * 1024 * 1024


def _plain_path(column):
    return F.regexp_replace(column, "^file:/+", "/")


def file_inventory(spark: SparkSession, path, *, glob: str | None = None) -> DataFrame:
    """``path, size, modified`` of every file below ``path``; contents are not read.

    Empty files are not listed, so like missing ones they fail every later check.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(
        _plain_path("path").alias("path"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    )


def read_manifests(spark: SparkSession, path, *, documents: bool = True) -> DataFrame:
    """Manifests of cached read sets: ``unit_id, layout, read1, read2, single, checksums, file``.

    One JSON document per file, or one per line without ``documents``. A text that is no
    such document has no layout and no files, so its set counts as broken.
    """
    columns = "unit_id STRING, layout STRING, read1 ARRAY<STRING>, read2 ARRAY<STRING>, single ARRAY<STRING>, checksums MAP<STRING, STRING>"
    rows = spark.read.schema(columns).option("multiLine", documents).json(path)
    return rows.select("*", _plain_path(F.col("_metadata.file_path")).alias("file"))


def with_sha256(inventory: DataFrame) -> DataFrame:
    """Add the SHA-256 of each file, read in blocks by the task that owns the row.

    The file is streamed through the file system named in its path, so its size does
    not matter. Missing files get null.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            digests = []
            for path in batch.column("path").to_pylist():
                try:
                    system, name = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
                    digest = hashlib.sha256()
                    with system.open_input_stream(name) as stream:
                        while block := stream.read(BLOCK):
                            digest.update(block)
                    digests.append(digest.hexdigest())
                except FileNotFoundError:
                    digests.append(None)
            yield batch.append_column("sha256", pa.array(digests, pa.string()))

    columns = ", ".join(f"`{n}` {t}" for n, t in inventory.dtypes)
    return inventory.mapInArrow(hashed, f"{columns}, sha256 STRING")


def hashed_inventory(spark: SparkSession, path, *, glob: str | None = None) -> DataFrame:
    """Inventory with checksums."""
    return with_sha256(file_inventory(spark, path, glob=glob))


def stat_paths(paths: DataFrame) -> DataFrame:
    """``path, size, modified`` of the files named in column ``path``; missing ones drop."""
    schema = pa.schema([("path", pa.string()), ("size", pa.int64()), ("modified", pa.timestamp("us", tz="UTC"))])

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            found = []
            for path in batch.column("path").to_pylist():
                system, name = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
                info = system.get_file_info(name)
                if info.type == fs.FileType.File:
                    found.append({"path": path, "size": info.size, "modified": info.mtime})
            yield pa.RecordBatch.from_pylist(found, schema=schema)

    return paths.select("path").distinct().mapInArrow(looked_up, "path STRING, size BIGINT, modified TIMESTAMP")
