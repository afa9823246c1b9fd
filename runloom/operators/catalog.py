"""The run catalog: one row per sequencing run, with an audit of what was done to it."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType
from pyspark.sql.window import Window

from ..ordering import ORD, distinct_in_order, keep_first, with_order
from ..session import cut_lineage
from ..violations import REPORT_ROWS, require_none, violation_rows
from .units import Units, group_units

RUN = "Run"
FEW_REPEATS = 1_000_000
# First rows among whose keys conflicts are sought before the whole table is merged.
FIRST_ROWS = (1_000, 30_000)

# Grouping levels and the entity columns of a run table.
GROUP_COLUMNS = {
    "run": ("Run",),
    "experiment": ("Experiment",),
    "sra_sample": ("SRA Sample", "Sample"),
    "biosample": ("BioSample",),
}
ENTITY_COLUMNS = {
    "experiments": ("Experiment",),
    "sra_samples": ("SRA Sample", "Sample"),
    "biosamples": ("BioSample",),
    "studies": ("SRA Study", "SRAStudy", "BioProject"),
}


class CatalogConflict(ValueError):
    """Duplicate runs or grouped runs contradict each other."""


def row_predicate(function: Callable[[dict[str, Any]], bool], columns: Iterable[str]) -> Column:
    """Boolean column that calls ``function`` with each row as a dict, in Arrow batches."""

    @F.arrow_udf(BooleanType())
    def accept(rows: pa.Array) -> pa.Array:
        return pa.array([bool(function(row)) for row in rows.to_pylist()], pa.bool_())

    return accept(F.struct(*[F.col(f"`{c}`") for c in columns]))


def merge_duplicates(df: DataFrame, key: str = RUN) -> DataFrame:
    """One row per key with the columns that contradict each other in ``_conflicts``.

    A column conflicts when its non-null values differ, which is ``min <> max``; when
    they do not, ``min`` is also the value to keep. So one aggregate both checks and
    merges, and its buffers combine on the map side.
    """
    values = [c for c in df.columns if c not in (key, ORD)]
    bounds = [F.min(f"`{c}`").alias(f"lo {c}") for c in values]
    bounds += [F.max(f"`{c}`").alias(f"hi {c}") for c in values]
    grouped = df.groupBy(f"`{key}`").agg(*bounds, F.min(ORD).alias(ORD))
    names = [
        F.when(F.col(f"`lo {c}`") != F.col(f"`hi {c}`"), F.lit(c)) for c in values
    ]
    conflicts = F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")
    merged = [F.col(f"`lo {c}`").alias(c) for c in values]
    by_name = dict(zip(values, merged))
    kept = [by_name.get(c, F.col(f"`{c}`")) for c in df.columns]
    return grouped.select(*kept, conflicts.alias("_conflicts"))


def merge_few_duplicates(df: DataFrame, key: str = RUN) -> DataFrame:
    """``merge_duplicates`` for tables in which most keys occur once.

    A first pass counts the keys by a 64-bit hash. Rows whose hash occurs once are their own
    merge and stay where they are; the others alone are shuffled. Hashes that several rows
    share are broadcast only after they are counted, up to ``FEW_REPEATS``; beyond, all rows
    are merged. Where there are none, the table is its own merge and read no second time.
    """
    hashed = df.withColumn("_hash", F.xxhash64(f"`{key}`"))
    repeated = cut_lineage(hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_hash"))
    found = repeated.count()
    if not found:
        return df.withColumn("_conflicts", F.array().cast("array<string>"))
    if found > FEW_REPEATS:
        return merge_duplicates(df, key)
    several = F.broadcast(repeated)
    alone = hashed.join(several, "_hash", "left_anti").drop("_hash").withColumn("_conflicts", F.array().cast("array<string>"))
    copies = hashed.join(several, "_hash", "left_semi").drop("_hash")
    return alone.unionByName(merge_duplicates(copies, key))


def merge_or_keep_apart(df: DataFrame, own: Column, key: str = RUN) -> DataFrame:
    """A catalog of one row per key that discards nothing, also where copies contradict each other.

    Copies of a key that agree are merged as ``merge_duplicates`` does. Where they do not, each
    different copy stays and takes the name ``own``, which covers the whole row and is no other
    key's name. The copies of a key are brought together once and sorted once; they are judged
    in a window, which spills.
    """
    values = [c for c in df.columns if c not in (key, ORD)]
    # Rows are sorted by a hash of their key first, which is a number.
    copies = Window.partitionBy("_hash", f"`{key}`")
    placed = df.withColumn("_hash", F.xxhash64(f"`{key}`")).repartition("_hash").withColumn("_own", own)
    in_order = copies.orderBy("_own", ORD)
    numbered = placed.withColumns({"_place": F.row_number().over(in_order), "_before": F.lag("_own").over(in_order)})
    merged = numbered.withColumns({"_first": F.min(ORD).over(copies)} | {f"lo {c}": F.min(f"`{c}`").over(copies) for c in values})
    differs = [F.coalesce(F.col(f"`{c}`") != F.col(f"`lo {c}`"), F.lit(False)) for c in values]
    judged = merged.withColumn("_apart", F.max(reduce(lambda a, b: a | b, differs, F.lit(False))).over(copies))
    kept = judged.filter(F.when(F.col("_apart"), ~F.col("_own").eqNullSafe(F.col("_before"))).otherwise(F.col("_place") == 1))
    one = {key: F.col(f"`{key}`"), ORD: F.col("_first")} | {c: F.col(f"`lo {c}`") for c in values}
    apart = {key: F.col("_own")}
    return kept.select(*[F.when(F.col("_apart"), apart.get(c, F.col(f"`{c}`"))).otherwise(one[c]).alias(c) for c in df.columns])


def contradictions(df: DataFrame, key: str = RUN) -> DataFrame:
    """``(key, _conflicts)`` of the keys whose copies differ.

    Numbers are compared by their own bounds, other non-null values by the bounds of two
    independent 64-bit hashes, so the aggregate works on numbers in place and neither sorts nor
    carries a text. Values that differ and agree in both hashes are not to be expected before
    some 2^64 values of one key.
    """
    values = [c for c in df.columns if c not in (key, ORD)]
    numbers = {f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)}

    def bounds(c: str) -> list[Column]:
        column = F.col(f"`{c}`")
        if c in numbers:
            return [F.min(column).alias(f"lo1 {c}"), F.max(column).alias(f"hi1 {c}")]
        first = F.when(column.isNotNull(), F.xxhash64(column))
        second = F.when(column.isNotNull(), F.xxhash64(F.lit("second"), column))
        return [pick(h).alias(f"{name} {c}") for h, n in ((first, 1), (second, 2)) for pick, name in ((F.min, f"lo{n}"), (F.max, f"hi{n}"))]

    grouped = df.groupBy(F.col(f"`{key}`").alias(key)).agg(F.count(F.lit(1)).alias("_n"), *[b for c in values for b in bounds(c)])

    def unequal(c: str) -> Column:
        differs = [F.col(f"`lo{n} {c}`") != F.col(f"`hi{n} {c}`") for n in ((1,) if c in numbers else (1, 2))]
        return reduce(lambda a, b: a | b, differs)

    differ = [F.when(unequal(c), F.lit(c)) for c in values]
    names = F.array_compact(F.array(*differ)) if differ else F.array().cast("array<string>")
    return grouped.select(F.col(f"`{key}`").alias(key), names.alias("_conflicts")).filter(F.size("_conflicts") > 0)


def conflict_rows(merged: DataFrame, key: str = RUN) -> DataFrame:
    """Violations of ``merge_duplicates`` or ``contradictions``: the key and its contradicting columns."""
    return violation_rows(
        merged.filter(F.size("_conflicts") > 0),
        "deduplicate_runs",
        F.col(f"`{key}`"),
        F.array_join("_conflicts", ","),
    )


def first_conflicts(merged: DataFrame, key: str = RUN, limit: int = REPORT_ROWS) -> DataFrame:
    """The first conflicting keys in input order, for an error report."""
    return (
        merged.filter(F.size("_conflicts") > 0)
        .orderBy(ORD)
        .limit(limit)
        .select(F.col(f"`{key}`").alias(key), F.array_join("_conflicts", ",").alias("columns"))
    )


def first_contradictions(df: DataFrame, key: str = RUN, limit: int = REPORT_ROWS) -> DataFrame:
    """``first_conflicts(merge_duplicates(df))`` without a shuffle of the table where conflicts come early.

    A key whose first copy lies among the first rows is judged by all its copies, which are
    found by a broadcast of these keys. As soon as ``limit`` of them conflict, they are the
    first ones: every other key begins later. Else more rows are taken, and in the end all.
    """
    for rows in FIRST_ROWS:
        head = cut_lineage(df.select(F.col(f"`{key}`").alias(key), ORD).orderBy(ORD).limit(rows))
        keys = head.select(key).distinct()
        copies = df.join(F.broadcast(keys), df[f"`{key}`"].eqNullSafe(keys[f"`{key}`"]), "left_semi")
        merged = cut_lineage(merge_duplicates(copies, key).filter(F.size("_conflicts") > 0))
        if merged.count() >= limit or head.count() < rows:
            return first_conflicts(merged, key, limit)
    return first_conflicts(merge_duplicates(df, key), key, limit)


def without_conflicts(merged: DataFrame) -> DataFrame:
    """Merged rows of the keys that had no contradiction."""
    return merged.filter(F.size("_conflicts") == 0).drop("_conflicts")


def entity_view(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """First row per distinct value combination of the given entity columns."""
    return keep_first(df, list(columns))


def distinct_keys(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-empty values of a column, with the order of first appearance."""
    filled = df.filter(F.coalesce(F.col(f"`{column}`").cast("string"), F.lit("")) != "")
    return distinct_in_order(filled.select(F.col(f"`{column}`").alias(column), ORD), [column])


@dataclass(frozen=True)
class Step:
    """One recorded operation: its label and, if it changes row counts, its function."""

    label: str
    apply: Callable[[DataFrame], DataFrame] | None = None


class RunCatalog:
    """Immutable wrapper around a run table; every method returns a new catalog."""

    def __init__(
        self,
        frame: DataFrame,
        *,
        audit: Iterable[str] = (),
        _origin: DataFrame | None = None,
        _steps: tuple[Step, ...] | None = None,
    ) -> None:
        if RUN not in frame.columns:
            raise ValueError(f"a run catalog needs a {RUN!r} column")
        self._frame = frame if ORD in frame.columns else with_order(frame)
        self._origin = self._frame if _origin is None else _origin
        self._steps = tuple(Step(text) for text in audit) if _steps is None else _steps

    @classmethod
    def from_csv(cls, spark: SparkSession, path: str) -> RunCatalog:
        """Load a run table from CSV with type inference and null markers."""
        from ..sources.tables import read_catalog_csv

        return cls(read_catalog_csv(spark, path), audit=(f"loaded CSV {path}",))

    @classmethod
    def from_records(
        cls, spark: SparkSession, records: Iterable[Mapping[str, Any]], schema=None
    ) -> RunCatalog:
        """Build a catalog from row mappings; meant for small hand-made tables."""
        rows = [dict(record) for record in records]
        if schema is None:
            names = list(dict.fromkeys(name for row in rows for name in row))
            known = [n for n in names if any(row.get(n) is not None for row in rows)]
            frame = spark.createDataFrame([tuple(row.get(n) for n in known) for row in rows], known)
            empty = F.lit(None).cast("string")
            frame = with_order(frame).select(
                *[F.col(f"`{n}`") if n in known else empty.alias(n) for n in names], ORD
            )
        else:
            frame = spark.createDataFrame(rows, schema)
        return cls(frame, audit=("created from records",))

    @property
    def frame(self) -> DataFrame:
        """The run table, including the hidden order column."""
        return self._frame

    def to_df(self) -> DataFrame:
        """The run table without the order column."""
        return self._frame.drop(ORD)

    @property
    def columns(self) -> list[str]:
        """Visible columns."""
        return [c for c in self._frame.columns if c != ORD]

    @property
    def audit(self) -> tuple[str, ...]:
        """Labels of the recorded operations; see ``audit_with_counts`` for row counts."""
        return tuple(step.label for step in self._steps)

    def _next(self, frame: DataFrame, label: str, apply=None) -> RunCatalog:
        return RunCatalog(
            frame, _origin=self._origin, _steps=(*self._steps, Step(label, apply))
        )

    def audit_with_counts(self) -> tuple[str, ...]:
        """The audit with ``before -> after`` row counts, measured in one pass.

        Counting nodes stand in the way of filter pushdown, so they are put only into
        this separate plan and never into ``frame``.
        """
        frame, probes = self._origin, []
        total = F.count(F.lit(1)).alias("n")
        for step in self._steps:
            if step.apply is None:
                probes.append(None)
                continue
            before, after = Observation(), Observation()
            frame = step.apply(frame.observe(before, total)).observe(after, total)
            probes.append((before, after))
        if any(probes):
            frame.write.format("noop").mode("overwrite").save()
        return tuple(
            step.label
            if probe is None
            else f"{step.label}: {probe[0].get['n']} -> {probe[1].get['n']} rows"
            for step, probe in zip(self._steps, probes)
        )

    def audit_table(self) -> DataFrame:
        """The audit as rows ``(step, event)``."""
        rows = list(enumerate(self.audit_with_counts()))
        return self._frame.sparkSession.createDataFrame(rows, "step INT, event STRING")

    def filter(self, predicate, *, description: str | None = None) -> RunCatalog:
        """Keep rows matching a column expression, an SQL text or a row function."""
        if isinstance(predicate, (Column, str)):
            label, condition = description or str(predicate), predicate
        elif callable(predicate):
            label = description or getattr(predicate, "__name__", "callable")
            condition = row_predicate(predicate, self.columns)
        else:
            raise TypeError("predicate must be a column expression, SQL text or a callable")

        def apply(df: DataFrame) -> DataFrame:
            return df.filter(condition)

        return self._next(apply(self._frame), f"filter {label}", apply)

    where = filter

    def transform(
        self, function: Callable[[DataFrame], DataFrame], *, description: str | None = None
    ) -> RunCatalog:
        """Apply a table function that must return a DataFrame which keeps ``Run``."""
        if not callable(function):
            raise TypeError("function must be callable")

        def apply(df: DataFrame) -> DataFrame:
            result = function(df)
            if not isinstance(result, DataFrame):
                raise TypeError(f"transform must return a DataFrame, got {type(result).__name__}")
            return result if ORD in result.columns else with_order(result)

        label = description or getattr(function, "__qualname__", type(function).__qualname__)
        return self._next(apply(self._frame), f"transform {label}", apply)

    def select(self, *columns: str) -> RunCatalog:
        """Keep the named columns; ``Run`` always stays."""
        kept = columns if RUN in columns else (RUN, *columns)
        frame = self._frame.select(*[F.col(f"`{c}`") for c in kept], ORD)
        return self._next(frame, f"selected columns {columns!r}", lambda df: df.select(*frame.columns))

    def with_columns(self, **expressions: Column) -> RunCatalog:
        """Add or replace columns."""

        def apply(df: DataFrame) -> DataFrame:
            return df.withColumns(expressions)

        return RunCatalog(
            apply(self._frame),
            _origin=self._origin,
            _steps=(*self._steps, Step("added/updated columns", apply)),
        )

    def replace_frame(self, frame: DataFrame, *, event: str) -> RunCatalog:
        """Swap the table and record an event."""
        if ORD not in frame.columns:
            frame = with_order(frame)
        return self._next(frame, event, lambda _df: frame)

    def conflicts(self) -> DataFrame:
        """Duplicate runs with contradictory values, as violation rows."""
        return conflict_rows(contradictions(self._frame))

    def deduplicate_runs(self, *, strict: bool = True) -> RunCatalog:
        """Merge duplicate runs, filling nulls from the other copies.

        Runs whose copies contradict each other raise when ``strict`` and are left out
        otherwise; ``conflicts`` lists them.
        """
        if strict:
            require_none(self.conflicts(), CatalogConflict)

        def apply(df: DataFrame) -> DataFrame:
            return without_conflicts(merge_duplicates(df))

        return self._next(apply(self._frame), "deduplicated exact runs", apply)

    def normalized_entities(self) -> dict[str, DataFrame]:
        """Runs, and one view per entity with the first row per accession."""
        views = {"runs": self._frame}
        for name, candidates in ENTITY_COLUMNS.items():
            present = [c for c in candidates if c in self._frame.columns]
            if present:
                views[name] = entity_view(self._frame, present)
        return views

    def processing_units(self, *, by: str = "experiment", strict: bool = True) -> Units:
        """Group runs into units; units that span several species raise when strict."""
        candidates = GROUP_COLUMNS[by]
        present = next((c for c in candidates if c in self._frame.columns), None)
        if present is None:
            raise ValueError(f"cannot group by {by!r}: column {candidates[-1]!r} is missing")
        units = group_units(self._frame, present)
        if strict:
            require_none(units.violations, CatalogConflict)
        return units
