"""Incremental metadata loads: missing records of new files are parsed and appended as deltas."""

from __future__ import annotations

import hashlib
from dataclasses import fields
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.bundle import Bundle, complete_experiments, completeness_index, fetch_plan, raw_identity
from ..ordering import ORD
from ..sources.archive_xml import (
    BIOSAMPLE_COLUMNS,
    PACKAGE_COLUMNS,
    biosample_table,
    packages_bundle,
    parse_records,
    record_text,
)
from ..sources.commit_log import CommitLog, Segment, read_rows
from ..sources.schemas import struct_type

PLACE = "STRUCT<batch: BIGINT, at: STRING>"
INDEX = "experiment_accession STRING, sra_sample STRING, biosample STRING, complete BOOLEAN, raw_available BOOLEAN"
COLLECTIONS = tuple(f.name for f in fields(Bundle))


def landed_records(spark: SparkSession, directory: str, tag: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of ``tag`` records, with file and split, of the files that land in a folder."""
    reader = spark.readStream.option("lineSep", f"<{tag}")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    chunks = reader.text(directory)
    return chunks.select(
        record_text(F.col("value"), tag).alias("xml"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
    ).filter(F.col("xml").isNotNull())


def placed(records: DataFrame) -> DataFrame:
    """Records of one micro-batch with their position."""
    return records.select("xml", F.struct("file", "split", F.monotonically_increasing_id().alias("row")).alias(ORD))


def _accession(tag: str) -> str:
    return rf"""<{tag}\s(?:[^<>]*?\s)?accession\s*=\s*["']([^"']*)["']"""


def named_experiment(xml: Column) -> Column:
    """Experiment accession of a package's text before it is parsed; empty if it names none."""
    return F.regexp_extract(xml, _accession("EXPERIMENT"), 1)


def named_runs(xml: Column) -> Column:
    """Run accessions of a package's text before it is parsed."""
    return F.regexp_extract_all(xml, F.lit(_accession("RUN")), F.lit(1))


def sortable(value: Column, kind: T.DataType) -> Column:
    """An order value as text that sorts the same way: numbers (from 0 on) padded, texts ended by a low mark."""
    if isinstance(kind, T.StructType):
        return F.concat(*[sortable(value[f.name], f.dataType) for f in kind.fields])
    text = F.coalesce(value.cast("string"), F.lit(""))
    return F.lpad(text, 20, "0") if isinstance(kind, T.IntegralType) else F.concat(text, F.lit("\x01"))


def _schema(name: str) -> T.StructType:
    """Stored columns: those of the collection, the place of the key and when the row was last seen."""
    base = T.StructType.fromDDL(INDEX) if name == "index" else struct_type(name)
    return T.StructType(base.fields + T.StructType.fromDDL(f"{ORD} {PLACE}, _seen {PLACE}").fields)


def _latest(name: str, rows: DataFrame) -> DataFrame:
    """One row per key: the one seen last, at the place where the key came first.

    Raw trees are distinct by content and keep their first row.
    """
    data = [c for c in rows.columns if c not in (ORD, "_seen", "_key")]
    if name == "raw_sra_packages":
        rows, key, choose, by = rows.withColumn("_key", raw_identity(F.col("raw"))), "_key", F.min_by, ORD
    else:
        key, choose, by = ("experiment_accession" if name == "index" else "accession"), F.max_by, "_seen"
    values = F.struct(*[c for c in data if c != key], "_seen")
    picked = rows.groupBy(key).agg(choose(values, by).alias("_row"), F.min(ORD).alias(ORD))
    return picked.select(*[c if c == key else F.col(f"_row.{c}").alias(c) for c in data], ORD, F.col("_row._seen").alias("_seen"))


class MetadataLoad:
    """Cumulative metadata tables under ``directory``, one delta per batch.

    A batch writes its own rows and nothing else, then takes the next number of the commit
    log. Readers take the latest row per accession by commit number, so streams may load at
    the same time and none loses what another adds. A source is a stream with its
    checkpoint; a batch of a source that is committed is not applied again. Deltas are
    merged level by level, see ``CommitLog``.

    The completeness index is kept the same way: after a batch the experiments that its
    rows touch are judged anew and written as a delta. Index rows are ordered by the state
    they were judged on, so a slower writer never hides a newer verdict.
    """

    def __init__(self, spark: SparkSession, directory: str) -> None:
        self.spark = spark
        self.directory = directory.rstrip("/")
        self.log = CommitLog(spark, self.directory)

    def _rows(self, segments: list[Segment], name: str) -> DataFrame:
        """Rows of one collection in some segments; fresh deltas get their commit's number."""
        parts = []
        for segment in segments:
            if name not in segment.entry["collections"]:
                continue
            rows = read_rows(self.spark, segment.path, name, _schema(name))
            if segment.level == 0 and name != "index":
                seen = F.struct(F.lit(segment.first).cast("bigint").alias("batch"), F.col(f"{ORD}.at").alias("at"))
                rows = rows.withColumns({ORD: seen, "_seen": seen})
            parts.append(rows)
        empty = self.spark.createDataFrame([], _schema(name))
        return reduce(DataFrame.unionByName, parts) if parts else empty

    def _current(self, segments: list[Segment], name: str) -> DataFrame:
        """One row per key of a collection; a single table that has no key twice is that already."""
        rows = self._rows(segments, name)
        parts = [s.entry for s in segments if name in s.entry["collections"]]
        return rows if len(parts) == 1 and name in parts[0].get("unique", ()) else _latest(name, rows)

    def _bundle(self, segments: list[Segment]) -> Bundle:
        return Bundle(**{name: self._current(segments, name).drop("_seen") for name in COLLECTIONS})

    def current(self) -> Bundle:
        """The latest record of every accession."""
        return self._bundle(self.log.segments())

    def index(self) -> DataFrame:
        """The completeness index."""
        return self._current(self.log.segments(), "index").drop(ORD, "_seen")

    def committed(self, source: str, batch: int) -> bool:
        """Whether a batch of a source is loaded; the batches of a source come in order."""
        return any(s.entry["sources"].get(source, -1) >= batch for s in self.log.segments())

    def _write(self, path: str, tables: dict[str, DataFrame]) -> list[str]:
        """Write the tables that have rows; returns their names."""
        for name, rows in tables.items():
            rows.select(*_schema(name).names).write.mode("overwrite").parquet(f"{path}/{name}")
        return [name for name in tables if not self.spark.read.schema(_schema(name)).parquet(f"{path}/{name}").isEmpty()]

    def _merge(self, parts: list[Segment], path: str) -> dict:
        names = sorted({n for s in parts for n in s.entry["collections"]})
        written = self._write(path, {n: _latest(n, self._rows(parts, n)) for n in names})
        sources: dict[str, int] = {}
        for part in parts:
            for source, batch in part.entry["sources"].items():
                sources[source] = max(batch, sources.get(source, -1))
        return {"collections": written, "unique": names, "sources": sources, "judged": max(s.entry["judged"] for s in parts)}

    def apply(self, incoming: Bundle, batch: int, source: str = "batch", *, unique: tuple[str, ...] = ()) -> None:
        """Append a bundle as a delta and refresh the completeness index.

        The collections named ``unique`` have one row per accession.
        """
        if not self.committed(source, batch):
            path = self.log.fresh_path()
            tables = {}
            for name in COLLECTIONS:
                rows = getattr(incoming, name)
                if rows is not None:
                    at = sortable(F.col(ORD), rows.schema[ORD].dataType)
                    unknown = F.struct(F.lit(None).cast("bigint").alias("batch"), at.alias("at"))
                    known = [F.col(c) if c in rows.columns else F.lit(None).cast(t).alias(c) for c, t in ((f.name, f.dataType) for f in struct_type(name))]
                    tables[name] = rows.select(*known, unknown.alias(ORD), unknown.alias("_seen"))
            written = self._write(path, tables)
            entry = {"path": path, "collections": written, "unique": sorted(unique), "sources": {source: batch}, "judged": -1}
            number = self.log.append(entry, lambda other: other["sources"].get(source, -1) < batch)
            if number is not None:
                self.log.merge_due(number, self._merge)
        self.refresh_index()

    def refresh_index(self) -> None:
        """Judge the experiments anew that commits since the last judgement touch.

        What is written follows the new commits, not the size of the store.
        """
        segments = self.log.segments()
        judged = max((s.entry["judged"] for s in segments), default=-1)
        last = segments[-1].last if segments else -1
        # A merged segment may begin before the judgement; its rows are judged once more.
        fresh = [s for s in segments if s.last > judged and set(s.entry["collections"]) - {"index"}]
        if not fresh:
            return
        new, now = self._bundle(fresh), self._bundle(segments)
        named = lambda df, column: df.select(F.col(column).alias("accession"))
        linked = now.sra_samples.join(named(new.biosamples, "accession").withColumnRenamed("accession", "biosample"), "biosample", "left_semi")
        samples = named(new.sra_samples, "accession").union(named(linked, "accession")).withColumnRenamed("accession", "sra_sample_accession")
        touched = (
            named(new.packages, "experiment_accession")
            .union(named(new.experiments, "accession"))
            .union(named(now.packages.join(samples, "sra_sample_accession", "left_semi"), "experiment_accession"))
            .withColumnRenamed("accession", "experiment_accession")
        )
        packages, experiments = now.packages, now.experiments
        if any("packages" in s.entry["collections"] for s in segments if s not in fresh):
            packages = packages.join(touched, "experiment_accession", "left_semi")
            experiments = experiments.join(touched.withColumnRenamed("experiment_accession", "accession"), "accession", "left_semi")
        seen = F.struct(F.lit(last).cast("bigint").alias("batch"), F.lit("").alias("at"))
        rows = completeness_index(packages, experiments, now.sra_samples, now.biosamples).withColumns({ORD: seen, "_seen": seen})
        path = self.log.fresh_path()
        entry = {"path": path, "collections": self._write(path, {"index": rows}), "unique": ["index"], "sources": {}, "judged": last}
        self.log.merge_due(self.log.append(entry), self._merge)

    def to_fetch(self, accessions: DataFrame, *, include_raw: bool = False, refresh: bool = False) -> DataFrame:
        """The experiments of ``accessions`` that are not complete here.

        An experiment is done if its records are all loaded and the index says so too.
        """
        return fetch_plan(accessions, accessions if refresh else self._complete(accessions, include_raw), refresh=refresh)

    def _complete(self, accessions: DataFrame, include_raw: bool) -> DataFrame:
        """The experiments of ``accessions`` whose records are all loaded and that the index calls complete."""
        now = self.current()
        packages = now.packages.join(accessions, "experiment_accession", "left_semi")
        done = complete_experiments(packages, now.experiments, now.sra_samples, now.biosamples, include_raw=include_raw)
        listed = self.index().filter("complete AND raw_available" if include_raw else "complete")
        return done.join(listed, "experiment_accession", "left_semi")

    def wanted_packages(self, records: DataFrame, *, scope: DataFrame | None = None, include_raw: bool = False, refresh: bool = False) -> DataFrame:
        """The package records that still have to be parsed, chosen by their text.

        ``scope`` names experiments (``experiment_accession``) or runs (``Run``): other
        packages do not enter. Packages that name no experiment are left to the parser.
        """
        rows = records.withColumn("experiment_accession", named_experiment(F.col("xml")))
        if scope is not None and "experiment_accession" in scope.columns:
            rows = rows.join(scope.select("experiment_accession"), "experiment_accession", "left_semi")
        elif scope is not None:
            runs = scope.filter(F.col("Run").isNotNull()).select(F.col("Run").cast("string").alias("_run"))
            owners = rows.select("experiment_accession", F.explode(named_runs(F.col("xml"))).alias("_run")).join(runs, "_run", "left_semi")
            rows = rows.join(owners.select("experiment_accession"), "experiment_accession", "left_semi")
        stored = {name for s in self.log.segments() for name in s.entry["collections"]}
        if not refresh and {"packages", "experiments", "sra_samples"} <= stored:
            done = self._complete(rows.select("experiment_accession"), include_raw)
            rows = rows.join(done, "experiment_accession", "left_anti")
        return rows.drop("experiment_accession")

    def _parsed(self, records: DataFrame, columns: str, batch: int, source: str) -> DataFrame:
        """Parse a micro-batch once into a table that all collections are cut from.

        The table is columnar, so each collection reads only its own part of it.
        """
        name = hashlib.sha256(source.encode()).hexdigest()[:16]
        path = f"{self.directory}/parsed/{name}-{batch:08d}"
        parse_records(placed(records), columns).write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def apply_packages(
        self, records: DataFrame, batch: int, source: str = "packages", *, scope: DataFrame | None = None, include_raw: bool = False, refresh: bool = False
    ) -> None:
        """Append the missing packages of a micro-batch."""
        if self.committed(source, batch):
            return self.refresh_index()
        wanted = self.wanted_packages(records, scope=scope, include_raw=include_raw, refresh=refresh)
        parsed = self._parsed(wanted, PACKAGE_COLUMNS, batch, source)
        bundle = packages_bundle(parsed, include_raw=include_raw)
        self.apply(bundle, batch, source, unique=tuple(name for name in COLLECTIONS if name not in ("biosamples", "raw_sra_packages")))

    def apply_biosamples(self, records: DataFrame, batch: int, source: str = "biosamples", *, include_raw: bool = False) -> None:
        """Append a micro-batch of BioSample records."""
        if self.committed(source, batch):
            return self.refresh_index()
        parsed = self._parsed(records, BIOSAMPLE_COLUMNS, batch, source)
        self.apply(Bundle(biosamples=biosample_table(parsed, include_raw=include_raw)), batch, source, unique=("biosamples",))

    def _load(self, landing: str, tag: str, checkpoint: str, apply, files: int | None):
        records = landed_records(self.spark, landing, tag, files)
        return (
            records.writeStream.foreachBatch(apply)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )

    def load_packages(
        self,
        landing: str,
        checkpoint: str,
        *,
        scope: DataFrame | None = None,
        include_raw: bool = False,
        refresh: bool = False,
        files_per_batch: int | None = None,
    ):
        """Start a query that loads the missing packages of all files present and then stops."""
        return self._load(
            landing,
            "EXPERIMENT_PACKAGE",
            checkpoint,
            lambda df, n: self.apply_packages(df, n, f"packages:{checkpoint}", scope=scope, include_raw=include_raw, refresh=refresh),
            files_per_batch,
        )

    def load_biosamples(self, landing: str, checkpoint: str, *, include_raw: bool = False, files_per_batch: int | None = None):
        """Start a query that loads all BioSample files present and then stops."""
        return self._load(
            landing,
            "BioSample",
            checkpoint,
            lambda df, n: self.apply_biosamples(df, n, f"biosamples:{checkpoint}", include_raw=include_raw),
            files_per_batch,
        )
