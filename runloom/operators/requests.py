"""Request plans: identifiers cut into bounded chunks, and page offsets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_numeric_id, is_safe_accession, safe_identifier, strip
from ..ordering import ORD, distinct_in_order, global_ordinal
from ..violations import violation_rows

# Default sizes of requests and the ceiling of one id search.
RESOLVE_CHUNK, PACKAGE_CHUNK, RUN_CHUNK, PAGE_SIZE = 50, 100, 200, 5_000
SEARCH_LIMIT = 100_000


def request_ids(identifiers: DataFrame) -> DataFrame:
    """Distinct non-blank identifiers ``id`` in order, split into numbers and accessions."""
    cleaned = identifiers.select(strip(F.col("id").cast("string")).alias("id"), ORD).filter("id <> ''")
    return distinct_in_order(cleaned, ["id"]).withColumn("is_uid", is_numeric_id(F.col("id")))


def unsafe_ids(ids: DataFrame) -> DataFrame:
    """Accessions that must not be put into a query, as violation rows."""
    wrong = ids.filter(~F.col("is_uid") & ~is_safe_accession(F.col("id")))
    return violation_rows(wrong, "request_ids", F.col("id"), F.lit("unsafe identifier"))


def unusable_names(df: DataFrame, column: str) -> DataFrame:
    """Identifiers from which no file name can be made, as violation rows."""
    wrong = df.filter(safe_identifier(F.col(column)).isNull())
    return violation_rows(wrong, "safe_identifier", F.col(column), F.lit("unsafe or empty identifier"))


def chunked(ids: DataFrame, size: int, *, separator: str = ",", template: str = "%s") -> DataFrame:
    """Chunks of ``size`` consecutive ids as text ``(chunk, n, request)``.

    Each chunk holds at most ``size`` ids; numbering uses ``global_ordinal``, so the
    table is never sorted in one task.
    """
    if size < 1:
        raise ValueError("chunk size must be positive")
    placed = global_ordinal(ids.select("id", ORD), [ORD])
    return (
        placed.groupBy(F.floor(F.col("ordinal") / F.lit(size)).alias("chunk"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.array_sort(F.collect_list(F.struct("ordinal", F.format_string(template, F.col("id")).alias("text")))).alias("_ids"),
        )
        .select("chunk", "n", F.array_join(F.col("_ids")["text"], separator).alias("request"))
    )


def resolve_requests(ids: DataFrame, *, field: str = "Accession", size: int = RESOLVE_CHUNK) -> DataFrame:
    """Search texts that resolve accessions, ``"a"[field] OR "b"[field] …``."""
    if not all(part.isalpha() and part.isascii() for part in field.split(" ") if part) or not field[:1].isalpha():
        raise ValueError(f"unsafe field: {field!r}")
    return chunked(ids.filter(~F.col("is_uid")), size, separator=" OR ", template=f'"%s"[{field}]')


def page_offsets(results: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Offsets of the pages of each query from ``(query, count)``."""
    return results.filter("count > 0").select(
        "query",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("count") - 1, F.lit(page_size).cast("bigint"))).alias("offset"),
        F.lit(page_size).alias("page_size"),
    )


def over_limit(results: DataFrame, limit: int = SEARCH_LIMIT) -> DataFrame:
    """Queries that match more records than one id search returns, as violation rows."""
    return violation_rows(
        results.filter(F.col("count") > limit),
        "search_ids",
        F.col("query"),
        F.concat(F.col("count").cast("string"), F.lit(f" records, above the limit of {limit}")),
    )
