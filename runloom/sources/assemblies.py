"""Assembly reports from JSON documents or JSON lines, at any nesting depth."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..ordering import ORD
from .tables import read_position

REPORT_COLUMNS = "requested_taxid BIGINT, file STRING, split BIGINT, row BIGINT, item BIGINT, report STRING"


def report_objects(document) -> Iterator[dict]:
    """Report objects inside a JSON value, outermost first, in document order."""
    pending = [document]
    while pending:
        value = pending.pop()
        if isinstance(value, dict):
            if value.get("accession") and (value.get("organism") or value.get("assembly_info")):
                yield value
                continue
            value = list(value.values())
        if isinstance(value, list):
            pending.extend(reversed(value))


def read_reports(spark: SparkSession, path, *, taxid_pattern: str = r"taxon[_-]([0-9]+)", lines: bool = True) -> DataFrame:
    """Report rows with the taxonomy id the file was requested for.

    ``lines`` reads JSON lines, which Spark splits; otherwise each file is one document.
    The requested id is taken from the file name.
    """
    text = spark.read.text(path, wholetext=not lines).select(
        F.regexp_extract("_metadata.file_name", taxid_pattern, 1).try_cast("bigint").alias("requested_taxid"),
        read_position().alias("at"),
        "value",
    )
    flat = text.filter(F.trim("value") != "").select("requested_taxid", "at.*", "value")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                for item, report in enumerate(report_objects(json.loads(row.pop("value")))):
                    out.append(row | {"item": item, "report": json.dumps(report, ensure_ascii=False)})
            schema = pa.schema(
                [("requested_taxid", pa.int64()), ("file", pa.string()), ("split", pa.int64()),
                 ("row", pa.int64()), ("item", pa.int64()), ("report", pa.string())]
            )
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    found = flat.mapInArrow(extract, REPORT_COLUMNS)
    return found.select("requested_taxid", "report", F.struct("file", "split", "row", "item").alias(ORD))
