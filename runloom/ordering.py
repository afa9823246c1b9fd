"""Input order, first/last-wins selection, and bounded packing of groups.

A DataFrame has no row order, so "first" always means the smallest value of an order
column that was attached when the rows were read. Selections are written as
``min_by``/``max_by`` aggregates: they combine on the map side, so a key that holds a
large share of the rows reaches the reducer as one row per task, where a ranking
window would sort the whole group in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .session import cut_lineage

ORD = "_ord"
PACK_LIMIT = 100_000
# Buckets of keys whose sizes are counted first, and combine before the shuffle.
KEY_BUCKETS = 1 << 16


def with_order(df: DataFrame, *columns: str) -> DataFrame:
    """Attach ``_ord``: the given columns as a total order, or the read order.

    The read order is stable for a fixed list of file splits; tables with a natural
    key should name it.
    """
    if columns:
        return df.withColumn(ORD, F.struct(*columns))
    return df.withColumn(ORD, F.monotonically_increasing_id())


def _pick(df: DataFrame, keys: Sequence[str], chooser, order: Column, extra=(), apart: Sequence[str] = ()) -> DataFrame:
    """One row per key; the columns ``apart`` are among the ``extra`` aggregates, not in the row."""
    values = [c for c in df.columns if c not in keys and c not in apart]
    picked = df.groupBy(*keys).agg(
        chooser(F.struct(*[F.col(c) for c in values]), order).alias("_row"), *extra
    )
    kept = [F.col("_row")[c].alias(c) for c in values]
    added = [c for c in picked.columns if c not in (*keys, *apart, "_row")]
    return picked.select(*keys, *kept, *apart, *added).select(*df.columns, *added)


def _pick_by(df: DataFrame, keys: list[str], chooser, bound, order: str | Column) -> DataFrame:
    """``_pick`` with an order column as an aggregate of its own, which goes where nobody reads it."""
    if not isinstance(order, str):
        return _pick(df, keys, chooser, order)
    if order in keys or set(df.columns) <= {*keys, order}:
        return _pick(df, keys, chooser, F.col(order))
    return _pick(df, keys, chooser, F.col(order), [bound(order).alias(order)], [order])


def keep_first(df: DataFrame, keys: Sequence[str], order: str | Column = ORD) -> DataFrame:
    """One whole row per key: the first in order. Null keys form a group of their own."""
    return _pick_by(df, list(keys), F.min_by, F.min, order)


def keep_last(df: DataFrame, keys: Sequence[str], order: str | Column = ORD) -> DataFrame:
    """One whole row per key: the last in order."""
    return _pick_by(df, list(keys), F.max_by, F.max, order)


def union_first_wins(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Union where a key already present in ``target`` keeps the target row."""
    both = target.withColumn("_src", F.lit(0)).unionByName(
        source.withColumn("_src", F.lit(1)), allowMissingColumns=True
    )
    return keep_first(both, [key], F.struct("_src", ORD)).drop("_src")


def upsert_last_wins(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Union where ``source`` replaces rows of ``target`` but keeps their position.

    A replaced row keeps the ``_ord`` it had in ``target``. New rows keep their own, so
    the orders of ``source`` should follow those of ``target``; loads that arrive in
    batches put the batch number first in the order.
    """
    both = target.withColumn("_src", F.lit(0)).unionByName(
        source.withColumn("_src", F.lit(1)), allowMissingColumns=True
    )
    place = F.struct("_src", ORD)
    merged = _pick(both, [key], F.max_by, place, extra=[F.min(place).alias("_place")])
    return merged.withColumn(ORD, F.col("_place")[ORD]).drop("_place", "_src")


def distinct_in_order(df: DataFrame, columns: Sequence[str], order: str = ORD) -> DataFrame:
    """Distinct values with the order of their first appearance."""
    return df.groupBy(*columns).agg(F.min(order).alias(ORD))


def group_sizes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key, combined on the map side."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))


def heavy_keys(df: DataFrame, key: str, limit: int) -> DataFrame | None:
    """Keys that more than ``limit`` rows share, or None.

    Rows are counted by buckets of keys first, which takes a few rows per task; only the keys
    in buckets above the limit are then counted by themselves.
    """
    bucket = F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(KEY_BUCKETS))
    bucketed = df.filter(F.col(f"`{key}`").isNotNull()).select(key, bucket.alias("_bucket"))
    full = cut_lineage(group_sizes(bucketed, ["_bucket"]).filter(F.col("_n") > limit).select("_bucket"))
    if full.isEmpty():
        return None
    heavy = cut_lineage(group_sizes(bucketed.join(F.broadcast(full), "_bucket", "left_semi"), [key]).filter(F.col("_n") > limit).select(key))
    return None if heavy.isEmpty() else heavy


def _by_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join on keys that may be null; ``right`` is one row per key."""
    renamed = {k: f"_key{i}" for i, k in enumerate(keys)}
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(renamed[k])) for k in keys])
    return left.join(right.withColumnsRenamed(renamed), same).drop(*renamed.values())


def pack_ordered(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    order: str = ORD,
    limit: int = PACK_LIMIT,
) -> DataFrame:
    """Collect ``value`` per key into arrays of at most ``limit`` elements, in order.

    Elements are numbered per key by order and value, and ``chunk`` is the number divided
    by ``limit``: the chunks of a key follow each other, and groups of equal size and order
    are cut at the same places. Where all groups fit into one chunk, their sizes are not
    joined; those that do not fit are numbered by a range partitioning, so no task holds a
    whole hot group.
    """
    keys = list(keys)
    sizes = group_sizes(df, keys).select(
        *keys, F.ceil(F.col("_n") / F.lit(limit)).cast("int").alias("n_chunks")
    )
    if not sizes.filter("n_chunks > 1").limit(1).count():
        placed = df.select(*keys, order, value, F.lit(1).alias("n_chunks"), F.lit(0).alias("chunk"))
    else:
        sized = _by_keys(df.select(*keys, order, value), sizes, keys)
        placed = sized.withColumn("chunk", F.lit(0))
        numbered = global_ordinal(sized.filter("n_chunks > 1"), [*keys, order, value], "_ordinal")
        firsts = numbered.groupBy(*keys).agg(F.min("_ordinal").alias("_first"))
        chunk = F.floor((F.col("_ordinal") - F.col("_first")) / F.lit(limit)).cast("int")
        large = _by_keys(numbered, firsts, keys).withColumn("chunk", chunk).select(*placed.columns)
        placed = placed.filter("n_chunks = 1").unionByName(large)
    packed = placed.groupBy(*keys, "chunk", "n_chunks").agg(
        F.array_sort(F.collect_list(F.struct(F.col(order).alias("ord"), F.col(value).alias("value")))).alias("items")
    )
    return packed.withColumn("values", F.col("items")["value"])


def global_ordinal(df: DataFrame, order: Sequence[str], name: str = "ordinal") -> DataFrame:
    """Number all rows 0, 1, 2 … in order without sorting them in one task.

    Rows are range-partitioned and sorted, the layout is frozen by a checkpoint, and
    each partition starts at the number of rows before it. Only the per-partition
    counts, one row per shuffle partition, go through a single task.
    """
    laid_out = cut_lineage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn(
            "_row", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        )
    )
    counts = laid_out.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return (
        laid_out.join(F.broadcast(starts), "_pid")
        .withColumn(name, F.col("_row") + F.col("_start"))
        .drop("_pid", "_row", "_start")
    )


def set_digest_limbs(value: Column) -> list[Column]:
    """Four 60-bit pieces of a value's SHA-256, for ``set_digest_aggs``; best made once per row."""
    digest = F.sha2(value, 256)
    return [
        F.conv(F.substring(digest, 1 + 15 * i, 15), 16, 10).cast("bigint") for i in range(4)
    ]


def set_digest_aggs(limbs: list[Column], prefix: str) -> list[Column]:
    """Aggregates whose results identify a set of distinct values in any order.

    The pieces of each value's digest are XOR-ed: the aggregation buffer is four integers,
    so it combines on the map side however large the set is.
    """
    return [F.bit_xor(limb).alias(f"{prefix}{i}") for i, limb in enumerate(limbs)]


def set_digest_text(prefix: str, count: Column) -> Column:
    """Text of a set digest computed by ``set_digest_aggs``."""
    parts = [F.lpad(F.lower(F.hex(F.col(f"{prefix}{i}"))), 15, "0") for i in range(4)]
    return F.concat(F.lit("set:"), count.cast("string"), F.lit(":"), *parts)


def empty_like(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """An empty DataFrame in the session of ``df``."""
    return df.sparkSession.createDataFrame([], schema)
