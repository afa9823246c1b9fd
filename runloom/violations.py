"""Data violations as rows, and the bounded check that turns them into errors.

Every operator that refuses bad data has a companion that returns the offending keys
as a DataFrame ``(operator, key, detail)``. Only ``require_none`` runs an action, and
it fetches at most ten rows for the message.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPORT_ROWS = 10


class DataViolation(ValueError):
    """Raised by strict operators when the violation table is not empty."""


def violation_rows(df: DataFrame, operator: str, key: Column, detail: Column) -> DataFrame:
    """Shape ``df`` as violation rows."""
    return df.select(
        F.lit(operator).alias("operator"),
        key.cast("string").alias("key"),
        detail.cast("string").alias("detail"),
    )


def require_none(violations: DataFrame, error: type[Exception] = DataViolation) -> None:
    """Raise ``error`` naming the first ten violations by key, if there are any."""
    rows = violations.orderBy("key", "detail").limit(REPORT_ROWS).collect()
    if rows:
        listed = "; ".join(f"{row['key']}: {row['detail']}" for row in rows)
        raise error(f"{rows[0]['operator']}: {listed}")
