"""Catalog tables: CSV with null markers and type inference, run-info payloads, sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identity import short_digest
from ..functions.values import blank_to_null
from ..ordering import ORD
from ..violations import require_none, violation_rows
from .csv_records import read_csv_table

# Texts that mean null in a catalog file, and the alias columns of a
# run-info payload.
NULL_MARKERS = ("", "NA", "N/A", "null", "None")
RUNINFO_ALIASES = {"Sample": "SRA Sample", "SRAStudy": "SRA Study"}
CANDIDATE_TYPES = ("bigint", "double", "date", "timestamp")


def read_position() -> Column:
    """Where a row stands in its files: file, split start, row within the split."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"),
    )


def read_text_csv(spark: SparkSession, path) -> DataFrame:
    """CSV files as text columns with their read position; large files are read in splits."""
    return read_csv_table(spark, path)


def nulls_from_markers(df: DataFrame) -> DataFrame:
    """Replace every null marker by null in all text columns."""
    return df.select(
        *[
            F.col(c) if c == ORD else F.when(~F.col(f"`{c}`").isin(*NULL_MARKERS), F.col(f"`{c}`")).alias(c)
            for c in df.columns
        ]
    )


def _fits(value: Column, kind: str) -> Column:
    parsed = value.try_cast(kind)
    if kind == "bigint":
        return value.rlike(r"^[+-]?[0-9]+$") & parsed.isNotNull()
    if kind == "date":
        return value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & parsed.isNotNull()
    if kind == "timestamp":
        return value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}") & parsed.isNotNull()
    return parsed.isNotNull()


def infer_types(df: DataFrame) -> dict[str, str]:
    """Narrowest type that fits every non-null text of each column.

    One aggregate over the whole table counts the texts that do not fit each candidate
    type; a column without any value stays text.
    """
    columns = [c for c in df.columns if c != ORD]
    counts = []
    for i, c in enumerate(columns):
        value = F.col(f"`{c}`")
        counts.append(F.count(value).alias(f"n{i}"))
        counts += [F.count_if(value.isNotNull() & ~_fits(value, k)).alias(f"{k}{i}") for k in CANDIDATE_TYPES]
    seen = df.agg(*counts).first()
    return {
        c: next((k for k in CANDIDATE_TYPES if seen[f"n{i}"] and not seen[f"{k}{i}"]), "string")
        for i, c in enumerate(columns)
    }


def read_catalog_csv(spark: SparkSession, path) -> DataFrame:
    """A run table from CSV: null markers removed, types inferred from all rows."""
    text = nulls_from_markers(read_text_csv(spark, path))
    kinds = infer_types(text)
    return text.select(*[F.col(f"`{c}`").cast(kinds[c]).alias(c) for c in kinds], ORD)


def normalize_runinfo(df: DataFrame) -> DataFrame:
    """Run-info rows with canonical sample and study columns; rows without a run drop."""
    if "Run" not in df.columns:
        raise ValueError(f"unexpected run-info header: {df.columns}")
    rows = df.filter(F.coalesce(F.col("Run"), F.lit("")) != "")
    for original, canonical in RUNINFO_ALIASES.items():
        if original in df.columns:
            own = blank_to_null(F.col(f"`{canonical}`")) if canonical in df.columns else F.lit(None)
            rows = rows.withColumn(canonical, F.coalesce(own, F.col(original)))
    return rows


def runinfo_violations(df: DataFrame) -> DataFrame:
    """Runs whose original and canonical columns disagree."""
    found = df.select(F.lit("").alias("operator"), F.lit("").alias("key"), F.lit("").alias("detail")).limit(0)
    for original, canonical in RUNINFO_ALIASES.items():
        if original in df.columns and canonical in df.columns:
            a, b = blank_to_null(F.col(f"`{original}`")), blank_to_null(F.col(f"`{canonical}`"))
            wrong = df.filter((F.coalesce(F.col("Run"), F.lit("")) != "") & (a != b))
            detail = F.lit(f"columns {original!r} and {canonical!r} disagree")
            found = found.unionByName(violation_rows(wrong, "runinfo", F.col("Run"), detail))
    return found


def read_runinfo(spark: SparkSession, path, *, strict: bool = True) -> DataFrame:
    """All landed run-info pages of a query as one text table, before deduplication.

    Pages repeat the header; files whose headers differ are united by name.
    """
    raw = read_text_csv(spark, path)
    if strict:
        require_none(runinfo_violations(raw))
    return normalize_runinfo(raw.filter(F.col("Run") != "Run") if "Run" in raw.columns else raw)


def load_runinfo_pages(spark: SparkSession, paths: list[str], *, strict: bool = True):
    """Union of run-info pages as a deduplicated catalog; no rows is an error."""
    from ..operators.catalog import RunCatalog

    table = read_runinfo(spark, paths, strict=strict)
    if table.isEmpty():
        raise ValueError("the run-info pages contain no runs")
    return RunCatalog(table, audit=("created from records",)).deduplicate_runs(strict=strict)


def query_cache_path(directory: str, query: str) -> str:
    """Folder that caches the catalog of a query, named by a digest of its text."""
    import hashlib

    return f"{directory.rstrip('/')}/sra.{hashlib.sha256(query.encode()).hexdigest()[:16]}"


def write_catalog_csv(df: DataFrame, path: str) -> None:
    """Write a catalog as CSV files with headers; the order column stays internal."""
    df.drop(ORD).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_unit_mapping(mapping: DataFrame, path: str) -> None:
    """Write unit mapping rows as CSV."""
    mapping.select("id", "bam", "metadata", "genome", "assay", "source").write.mode("overwrite").option("header", True).csv(path)


def query_digest(query: Column) -> Column:
    """The digest that names the cache folder of a query."""
    return short_digest(query, 16)
