"""A workspace of tables: executions, items, state events, outputs and the manifest.

It ties the operators together: a catalog becomes an execution of fingerprinted items,
only work that is new, changed or broken is processed, and every step is appended to
the event table from which states, manifest and reports are derived.

Events and manifests are numbered by commit logs, so builds at the same time never share a
number. States are folded from the newest snapshot and the events after it; units without
new events are taken from the snapshot as they are.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.identity import execution_name
from .functions.text import safe_identifier
from .operators import manifest as mf
from .operators import state as st
from .operators.catalog import RunCatalog
from .operators.process import Processor, processor_identity, run_units
from .operators.requests import unusable_names
from .operators.units import accession_sets, unit_fingerprints
from .ordering import ORD
from .session import cut_lineage
from .sources.commit_log import CommitLog
from .sources.files import stat_paths, with_sha256
from .violations import require_none

SCHEMA_VERSION = 3
EXECUTIONS = "execution_id STRING, created_at STRING, query STRING, group_by STRING, processor_identity STRING, audit ARRAY<STRING>"
ITEMS = (
    "execution_id STRING, item_id STRING, unit_id STRING, fingerprint STRING, taxid BIGINT, scientific_name STRING,"
    " total_bases BIGINT, total_size_gb DOUBLE, run_accessions ARRAY<STRING>, experiment_accessions ARRAY<STRING>,"
    " sra_sample_accessions ARRAY<STRING>, biosample_accessions ARRAY<STRING>, genome_pin STRING"
)
OUTPUTS = "execution_id STRING, unit_id STRING, role STRING, path STRING, size BIGINT, modified TIMESTAMP, sha256 STRING"
OUTCOMES = "unit_id STRING, status STRING, error STRING, outputs MAP<STRING, STRING>, metrics STRING, fasta STRING"
MANIFEST = (
    "unit_id STRING, fingerprint STRING, execution_id STRING, processor_identity STRING, status STRING,"
    f" phase STRING, attempts INT, artifacts MAP<STRING, STRUCT<path: STRING, size: BIGINT, modified: TIMESTAMP, sha256: STRING>>, error STRING, schema_version INT, {ORD} STRING"
)
#: New events from which on a snapshot of the states is written, if it has fewer units.
SNAPSHOT_EVENTS = 1_000
RESULT = "outputs MAP<STRING, STRING>, metrics STRING, fasta STRING"


class Workspace:
    """Tables below one folder of the cluster's shared storage."""

    def __init__(self, spark: SparkSession, directory: str, *, group_by: str = "experiment") -> None:
        self.spark = spark
        self.directory = directory.rstrip("/")
        self.group_by = group_by
        self.event_log = CommitLog(spark, f"{self.directory}/events")
        self.manifest_log = CommitLog(spark, f"{self.directory}/manifest")

    def _path(self, table: str) -> str:
        return f"{self.directory}/{table}"

    def _exists(self, table: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self._path(table))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def table(self, name: str, schema: str) -> DataFrame:
        """A workspace table, empty when nothing was written yet."""
        if not self._exists(name):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self._path(name))

    def _append(self, name: str, df: DataFrame) -> None:
        df.write.mode("append").parquet(self._path(name))

    def load_runs(self, path: str) -> RunCatalog:
        """Load a run table from CSV and merge its duplicates."""
        return RunCatalog.from_csv(self.spark, path).deduplicate_runs()

    def append_events(self, events: DataFrame) -> int:
        """Append events; their sequence number is that of the commit, which is returned.

        A unit has at most one event in a commit.
        """
        path = self.event_log.fresh_path()
        st.with_event_defaults(events.withColumn("seq", F.lit(None).cast("bigint"))).write.parquet(path)
        rows = self.spark.read.schema(st.EVENT_COLUMNS).parquet(path).count()
        return self.event_log.append({"path": path, "rows": rows})

    def _events_of(self, entries: dict[int, dict]) -> DataFrame:
        parts = [
            self.spark.read.schema(st.EVENT_COLUMNS).parquet(e["path"]).withColumn("seq", F.lit(n).cast("bigint"))
            for n, e in entries.items()
            if e["rows"]
        ]
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], st.EVENT_COLUMNS)

    def events(self) -> DataFrame:
        """All events, in order of ``seq``."""
        return self._events_of({n: self.event_log.entry(n) for n in range(self.event_log.size())})

    def _snapshot(self) -> tuple[int, dict | None]:
        """Commits that the newest snapshot covers, and what it says."""
        names = self.event_log.files.names("snapshots")
        return (int(names[-1][:12]), self.event_log.files.read(f"snapshots/{names[-1]}")) if names else (0, None)

    def _states(self) -> tuple[DataFrame, int, dict[int, dict], dict | None]:
        covered, snapshot = self._snapshot()
        end = self.event_log.size()
        fresh = {n: self.event_log.entry(n) for n in range(covered, end)}
        schema = f"unit_id STRING, {st.STATE_COLUMNS}"
        before = self.spark.createDataFrame([], schema) if snapshot is None else self.spark.read.schema(schema).parquet(snapshot["path"])
        if not any(e["rows"] for e in fresh.values()):
            return before, end, fresh, snapshot
        events = self._events_of(fresh)
        moved = events.select("unit_id").distinct()
        start = None if snapshot is None else before.join(moved, "unit_id", "left_semi")
        folded = st.final_states(st.fold_events(events, snapshot=start))
        return before.join(moved, "unit_id", "left_anti").unionByName(folded), end, fresh, snapshot

    def states(self) -> DataFrame:
        """Current state per unit: the newest snapshot, moved on by the events after it."""
        return self._states()[0]

    def take_snapshot(self, least_events: int = SNAPSHOT_EVENTS) -> bool:
        """Write a snapshot of the states if enough events came since the last.

        That is when the new events are as many as the units of the last snapshot, so
        writing snapshots costs no more than writing the events did.
        """
        states, end, fresh, snapshot = self._states()
        if sum(e["rows"] for e in fresh.values()) < max(least_events, snapshot["units"] if snapshot else 0):
            return False
        path = self.event_log.fresh_path()
        states.write.parquet(path)
        units = self.spark.read.parquet(path).count()
        return self.event_log.files.create(f"snapshots/{end:012d}.json", {"path": path, "units": units})

    def items(self, execution_id: str) -> DataFrame:
        """Items of one execution."""
        return self.table("items", ITEMS).filter(F.col("execution_id") == execution_id)

    def create_execution(
        self,
        catalog: RunCatalog,
        processor: Processor | str,
        *,
        processor_id: str | None = None,
        pins: DataFrame | None = None,
        descriptions: DataFrame | None = None,
        sources: DataFrame | None = None,
        query: str | None = None,
        created_at: datetime | None = None,
    ) -> str:
        """Fingerprint the units of a catalog and store them as an execution.

        ``sources`` is ``(unit_id, source)``: what the unit's input is taken from, such as
        a provider's name and settings or the URLs of its files. It is part of the unit's
        identity, so input from elsewhere is new work. The catalog's audit trail is stored
        with the execution.
        """
        identity = processor_identity(processor, processor_id)
        grouped = catalog.deduplicate_runs().processing_units(by=self.group_by)
        table = grouped.table
        if sources is not None:
            table = table.join(sources.select("unit_id", F.col("source").cast("string").alias("_source")), "unit_id", "left")
        units = unit_fingerprints(
            table,
            accession_sets(grouped.members),
            group_by=self.group_by,
            processor_identity=identity,
            fastq_identity=None if sources is None else F.col("_source"),
            pins=pins,
            descriptions=descriptions,
        )
        require_none(unusable_names(units, "unit_id"))
        items = cut_lineage(units.withColumn("item_id", safe_identifier(F.col("unit_id"))))
        stamp = (created_at or datetime.now(timezone.utc)).isoformat()
        digest = mf.items_digest(items, [ORD, "unit_id"]).select(
            execution_name(F.lit(stamp), F.col("digest")).alias("name")
        )
        name = digest.first()["name"]
        columns = [part.split(":")[0].split()[0] for part in ITEMS.split(", ")]
        self._append("items", items.withColumn("execution_id", F.lit(name)).select(*columns))
        row = [(name, stamp, query, self.group_by, identity, list(catalog.audit_with_counts()))]
        self._append("executions", self.spark.createDataFrame(row, EXECUTIONS))
        return name

    def outputs(self) -> DataFrame:
        """Recorded output files of the latest execution that produced each unit."""
        recorded = self.table("outputs", OUTPUTS)
        last = recorded.groupBy("unit_id").agg(F.max("execution_id").alias("execution_id"))
        return recorded.join(last, ["unit_id", "execution_id"], "left_semi")

    def _valid_outputs(self) -> DataFrame:
        """Units whose recorded outputs are intact; only changed files are hashed."""
        current = self.outputs()
        done = self.states().filter("status = 'succeeded'")
        genomes = done.select("unit_id", F.from_json("result", RESULT)["fasta"].alias("fasta"))
        named = current.select("path").unionByName(genomes.select(F.col("fasta").alias("path"))).filter("path IS NOT NULL")
        found = cut_lineage(stat_paths(named))
        same = current.select("path", "size", "modified").distinct()
        changed = with_sha256(found.join(same, ["path", "size", "modified"], "left_anti"))
        kept = found.join(same, ["path", "size", "modified"], "left_semi").withColumn("sha256", F.lit(None).cast("string"))
        return st.outputs_valid(current, genomes, kept.unionByName(changed))

    def plan(self, execution_id: str, *, retry_failed: bool = False, reclaim_running: bool = False) -> DataFrame:
        """What to do with the items of an execution."""
        return st.plan_resume(
            self.items(execution_id).select("unit_id", "item_id", "fingerprint"),
            self.states(),
            self._valid_outputs(),
            F.current_timestamp(),
            retry_failed=retry_failed,
            reclaim_running=reclaim_running,
        )

    def _events(self, units: DataFrame, kind, payload, **flags) -> DataFrame:
        named = {name: F.lit(flags.get(name, False)) for name in ("force", "retry_failed", "reclaim")}
        claim = F.concat_ws("/", "execution_id", "unit_id")
        return units.withColumns({"ts": F.current_timestamp(), "kind": kind, "claim_id": claim, "payload": payload, **named})

    def build(
        self,
        catalog: RunCatalog,
        processor: Processor | str,
        inputs: DataFrame,
        *,
        retry_failed: bool = False,
        reclaim_running: bool = False,
        **options,
    ) -> tuple[str, DataFrame]:
        """Process the units that need it; returns the execution and its outcomes.

        ``inputs`` has ``unit_id`` with the structs ``fastq``, ``genome`` (with
        ``fasta``) and ``context`` (with ``output_dir``).
        """
        execution_id = self.create_execution(catalog, processor, **options)
        plan = cut_lineage(
            self.plan(execution_id, retry_failed=retry_failed, reclaim_running=reclaim_running)
        )
        claimed = plan.filter("action = 'claim'").withColumn("execution_id", F.lit(execution_id))
        none = F.lit(None).cast("string")
        self.append_events(
            self._events(
                claimed,
                F.lit("claim"),
                none,
                force=F.col("archive_previous"),
                retry_failed=retry_failed,
                reclaim=reclaim_running,
            ),
        )
        # Another build may have claimed a unit since the plan; the fold decides whose it is.
        mine = self.states().select("unit_id", "claim_id").filter(
            F.col("claim_id") == F.concat_ws("/", F.lit(execution_id), "unit_id")
        )
        claimed = cut_lineage(claimed.join(mine, "unit_id", "left_semi"))
        work = inputs.join(claimed.select("unit_id"), "unit_id", "left_semi")
        facts = inputs.select("unit_id", F.col("genome.fasta").alias("fasta"))
        done = run_units(work, processor).join(facts, "unit_id").select("unit_id", "status", "error", "outputs", "metrics", "fasta")
        self._append(f"outcomes/{execution_id}", done)
        outcomes = self.table(f"outcomes/{execution_id}", OUTCOMES)
        result = F.to_json(F.struct("outputs", "metrics", "fasta"))
        succeeded = F.col("status") == "succeeded"
        self.append_events(
            self._events(
                outcomes.join(claimed.select("unit_id", "execution_id", "fingerprint"), "unit_id"),
                F.when(succeeded, F.lit("succeed")).otherwise(F.lit("fail")),
                F.when(succeeded, result).otherwise(F.col("error")),
            ),
        )
        listed = outcomes.filter(succeeded).select("unit_id", F.explode("outputs").alias("role", "path"))
        files = with_sha256(stat_paths(listed))
        recorded = listed.join(files, "path").withColumn("execution_id", F.lit(execution_id))
        self._append("outputs", recorded.select("execution_id", "unit_id", "role", "path", "size", "modified", "sha256"))
        self.sync_manifest(execution_id)
        self.take_snapshot()
        skipped = plan.join(claimed, "unit_id", "left_anti").select("unit_id", F.lit("skipped").alias("status"), F.lit(None).cast("string").alias("error"))
        return execution_id, outcomes.select("unit_id", "status", "error").unionByName(skipped)

    def manifest(self) -> DataFrame:
        """The newest manifest."""
        return self._manifest_before(self.manifest_log.size())

    def _manifest_before(self, number: int) -> DataFrame:
        if number == 0:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(self.manifest_log.entry(number - 1)["path"])

    def sync_manifest(self, execution_id: str) -> None:
        """Write the manifest with the items of an execution replacing their earlier rows."""
        fact = F.struct("path", "size", "modified", "sha256")
        # A unit has as many roles as its processor declares, a handful.
        files = self.outputs().groupBy("unit_id").agg(
            F.map_from_entries(F.collect_list(F.struct(F.col("role"), fact.alias("fact")))).alias("output_files")
        )
        states = self.states().join(files, "unit_id", "left")
        identity = self.table("executions", EXECUTIONS).filter(F.col("execution_id") == execution_id).first()
        rows = mf.manifest_rows(
            self.items(execution_id).select("unit_id", "fingerprint"),
            states,
            execution_id=execution_id,
            processor_identity=identity["processor_identity"],
        )
        current = rows.withColumns({"schema_version": F.lit(SCHEMA_VERSION), ORD: F.concat_ws("/", "execution_id", "unit_id")})
        columns = [f.name for f in self.spark.createDataFrame([], MANIFEST).schema]
        current = cut_lineage(current.select(*columns))
        while True:
            # Another build may commit its manifest first; then ours goes on top of it.
            number, path = self.manifest_log.size(), self.manifest_log.fresh_path()
            mf.sync_manifest(self._manifest_before(number), current).write.parquet(path)
            if self.manifest_log.append_at(number, {"path": path}):
                return

    def status(self, execution_id: str | None = None) -> dict[str, DataFrame]:
        """Status tables of one execution or of the whole workspace."""
        items, executions = self.table("items", ITEMS), self.table("executions", EXECUTIONS)
        return mf.status_report(items, self.states(), executions, execution_id)

    def requeue(self, unit_ids: Iterable[str], reason: str) -> None:
        """Put abandoned units back to pending and invalidate their claims."""
        units = self.spark.createDataFrame([(u, "") for u in unit_ids], "unit_id STRING, execution_id STRING")
        self.append_events(self._events(units, F.lit("requeue"), F.lit(reason)))
