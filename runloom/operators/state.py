"""Unit state: the event fold with claim fencing, latest state, counts and resume plans."""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from itertools import groupby
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from ..functions.text import bounded_error
from ..ordering import keep_last

# The statuses of a unit, those of a unit being worked on, the phases
# that decide a status, and the age after which a claim counts as abandoned.
STATUSES = ("pending", "downloading", "ready", "submitted", "running", "succeeded", "failed")
ACTIVE = ("downloading", "ready", "submitted", "running")
PHASE_STATUS = {
    "processing": "running",
    "resolving-genome": "downloading",
    "downloading-input": "downloading",
    "downloading-sra": "downloading",
}
STALE_SECONDS = 7 * 24 * 60 * 60
ERROR_CHARACTERS = 20_000

EVENT_COLUMNS = (
    "unit_id STRING, seq BIGINT, ts TIMESTAMP, kind STRING, claim_id STRING,"
    " fingerprint STRING, execution_id STRING, payload STRING,"
    " force BOOLEAN, retry_failed BOOLEAN, reclaim BOOLEAN"
)
_STATE_FIELDS = (
    ("status", "STRING"),
    ("phase", "STRING"),
    ("attempts", "INT"),
    ("fingerprint", "STRING"),
    ("execution_id", "STRING"),
    ("claim_id", "STRING"),
    ("started_at", "TIMESTAMP"),
    ("finished_at", "TIMESTAMP"),
    ("phase_updated_at", "TIMESTAMP"),
    ("interrupted_at", "TIMESTAMP"),
    ("interruption_reason", "STRING"),
    ("genome", "STRING"),
    ("prepared", "STRING"),
    ("result", "STRING"),
    ("error", "STRING"),
)
STATE_NAMES = tuple(name for name, _ in _STATE_FIELDS)
STATE_COLUMNS = ", ".join(f"{name} {kind}" for name, kind in _STATE_FIELDS)
FOLD_COLUMNS = (
    "unit_id STRING, seq BIGINT, ts TIMESTAMP, kind STRING, event_claim_id STRING,"
    " accepted BOOLEAN, reason STRING, archived_status STRING, archived_fingerprint STRING,"
    f" is_last BOOLEAN, {STATE_COLUMNS}"
)

FOLD_NAMES = tuple(part.split()[0] for part in FOLD_COLUMNS.split(","))
#: Unordered events of one unit that are held in memory, and the sequence numbers that
#: share an entry of the state store when there are more.
HELD_EVENTS, BUCKET_NUMBERS = 10_000, 1_024

State = dict[str, Any]


class Rejected(Exception):
    """An event that must not change the state; the message says why."""


def _claim(state: State, event: State, stale_seconds: float) -> State:
    status = state.get("status")
    same = status is not None and state["fingerprint"] == event["fingerprint"]
    if same and not event["force"]:
        if status == "succeeded":
            raise Rejected("reusable success")
        if status == "failed" and not event["retry_failed"]:
            raise Rejected("failed before, retry not requested")
    if status in ACTIVE and not event["reclaim"]:
        started: datetime = state["started_at"] or event["ts"]
        if (event["ts"] - started).total_seconds() <= stale_seconds:
            raise Rejected("already running")
    return {
        "status": "downloading",
        "phase": "resolving-genome",
        "attempts": state["attempts"] + 1 if same else 1,
        "fingerprint": event["fingerprint"],
        "execution_id": event["execution_id"],
        "claim_id": event["claim_id"],
        "started_at": event["ts"],
        "interrupted_at": state.get("interrupted_at"),
        "interruption_reason": state.get("interruption_reason"),
    }


def _requeue(state: State, event: State, _stale: float) -> State:
    if not state:
        raise Rejected("no state to requeue")
    if state["status"] not in ACTIVE:
        raise Rejected("not active")
    return state | {
        "status": "pending",
        "phase": "interrupted",
        "phase_updated_at": event["ts"],
        "interrupted_at": event["ts"],
        "interruption_reason": event["payload"],
        "claim_id": None,
        "finished_at": None,
        "error": None,
    }


def _owned(change, statuses: tuple[str, ...] | None):
    """A change that only the current claim may make, and only in some statuses."""

    def apply(state: State, event: State, _stale: float) -> State:
        if not state or event["claim_id"] is None or state["claim_id"] != event["claim_id"]:
            raise Rejected("claim was replaced")
        if statuses is not None and state["status"] not in statuses:
            raise Rejected(f"not allowed while {state['status']}")
        return state | change(state, event)

    return apply


TRANSITIONS = {
    "claim": _claim,
    "requeue": _requeue,
    "phase": _owned(
        lambda s, e: {
            "status": PHASE_STATUS.get(e["payload"], s["status"]),
            "phase": e["payload"],
            "phase_updated_at": e["ts"],
        },
        ACTIVE,
    ),
    "genome": _owned(lambda s, e: {"genome": e["payload"]}, ("downloading", "running")),
    "ready": _owned(
        lambda s, e: {
            "status": "ready",
            "phase": "ready",
            "phase_updated_at": e["ts"],
            "prepared": e["payload"],
        },
        ("downloading", "running"),
    ),
    "succeed": _owned(
        lambda s, e: {
            "status": "succeeded",
            "phase": "completed",
            "finished_at": e["ts"],
            "result": e["payload"],
            "error": None,
        },
        None,
    ),
    "fail": _owned(
        lambda s, e: {
            "status": "failed",
            "phase": "failed",
            "finished_at": e["ts"],
            "error": (e["payload"] or "")[-ERROR_CHARACTERS:],
        },
        None,
    ),
}


def advance(state: State, event: State, stale_seconds: float = STALE_SECONDS) -> tuple[State, State]:
    """Apply one event; returns the new state and the verdict row of the event."""
    verdict = {
        "unit_id": event["unit_id"],
        "seq": event["seq"],
        "ts": event["ts"],
        "kind": event["kind"],
        "event_claim_id": event["claim_id"],
        "accepted": True,
        "is_last": False,
    }
    try:
        transition = TRANSITIONS.get(event["kind"])
        if transition is None:
            raise Rejected("unknown kind")
        changed = transition(state, event, stale_seconds)
    except Rejected as rejection:
        return state, verdict | {"accepted": False, "reason": str(rejection)} | state
    if event["kind"] == "claim" and state:
        if state["fingerprint"] != event["fingerprint"] or event["force"]:
            verdict |= {
                "archived_status": state["status"],
                "archived_fingerprint": state["fingerprint"],
            }
    return changed, verdict | changed


def state_to_text(state: State) -> str:
    """State as JSON text, for the state store."""
    return json.dumps(
        {k: {"at": v.isoformat()} if isinstance(v, datetime) else v for k, v in state.items()},
        sort_keys=True,
    )


def state_from_text(text: str) -> State:
    """Inverse of ``state_to_text``."""
    return {
        k: datetime.fromisoformat(v["at"]) if isinstance(v, dict) else v
        for k, v in json.loads(text).items()
    }


class UnitStateProcessor(StatefulProcessor):
    """Folds the events of one unit; one verdict row per event.

    The state of a unit is one entry of the state store, and one state is held in memory
    while its events pass by in order of their sequence numbers. Input that arrives
    ``in_order`` is folded as it comes. Other input is put in order first: up to
    ``held_events`` in memory, more by way of the state store, where every
    ``BUCKET_NUMBERS`` sequence numbers share an entry, so that one entry at a time is
    read back and sorted. With a stale age, a timer per accepted claim reports units that
    are still active when it fires. A unit may start from a state of a snapshot. With
    ``last_only`` every event is folded, but only the row of a unit's last one is given.
    """

    def __init__(
        self, stale_seconds: float = STALE_SECONDS, *, in_order: bool = False, report_stale: bool = False, held_events: int = HELD_EVENTS, last_only: bool = False
    ) -> None:
        self.last_only = last_only
        self.stale_seconds = stale_seconds
        self.in_order = in_order
        self.report_stale = report_stale
        self.held_events = held_events

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", "json STRING")
        self.held = handle.getMapState("held", "bucket BIGINT", "events STRING")

    def _load(self) -> State:
        return state_from_text(self.state.get()[0]) if self.state.exists() else {}

    def _put_aside(self, events: list[State]) -> set[int]:
        events.sort(key=lambda e: e["seq"])
        buckets = set()
        for bucket, group in groupby(events, key=lambda e: e["seq"] // BUCKET_NUMBERS):
            lines = "\n".join(map(state_to_text, group))
            earlier = self.held.getValue((bucket,))[0] + "\n" if self.held.containsKey((bucket,)) else ""
            self.held.updateValue((bucket,), (earlier + lines,))
            buckets.add(bucket)
        return buckets

    def _ordered(self, events: Iterator[State]) -> Iterator[State]:
        if self.in_order:
            yield from events
            return
        waiting: list[State] = []
        buckets: set[int] = set()
        for event in events:
            waiting.append(event)
            if len(waiting) >= self.held_events:
                buckets |= self._put_aside(waiting)
                waiting = []
        if buckets:
            buckets |= self._put_aside(waiting)
            for bucket in sorted(buckets):
                lines = self.held.getValue((bucket,))[0].split("\n")
                self.held.removeKey((bucket,))
                yield from sorted(map(state_from_text, lines), key=lambda e: e["seq"])
        else:
            yield from sorted(waiting, key=lambda e: e["seq"])

    def handleInitialState(self, key, initialState, timerValues) -> None:
        before = {k: v.replace(tzinfo=timezone.utc) if isinstance(v, datetime) else v for k, v in initialState.asDict().items()}
        self.state.update((state_to_text({k: before[k] for k in STATE_NAMES}),))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        state, last = self._load(), None
        events = (row.asDict() | {"ts": row["ts"] and row["ts"].replace(tzinfo=timezone.utc)} for row in rows)
        for event in self._ordered(events):
            if last is not None and not self.last_only:
                yield Row(**{name: last.get(name) for name in FOLD_NAMES})
            state, verdict = advance(state, event, self.stale_seconds)
            if self.report_stale and verdict["accepted"] and event["kind"] == "claim":
                now = timerValues.getCurrentProcessingTimeInMs()
                self.handle.registerTimer(now + int(self.stale_seconds * 1000))
            last = verdict
        if last is not None:
            yield Row(**({name: last.get(name) for name in FOLD_NAMES} | {"is_last": True}))
        if state:
            self.state.update((state_to_text(state),))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        state = self._load()
        if state.get("status") not in ACTIVE:
            return
        age = timedelta(seconds=self.stale_seconds)
        due = datetime.fromtimestamp(expiredTimerInfo.getExpiryTimeInMs() / 1000, timezone.utc)
        verdict = {"unit_id": key[0], "ts": due, "kind": "stale", "accepted": True, "is_last": False, "reason": f"claim is older than {age}"} | state
        yield Row(**{name: verdict.get(name) for name in FOLD_NAMES})

    def close(self) -> None:
        pass


def fold_events(events: DataFrame, stale_seconds: float = STALE_SECONDS, *, snapshot: DataFrame | None = None, last_only: bool = False) -> DataFrame:
    """Verdict and resulting state for every event, in sequence order per unit.

    The rows of a unit reach its task sorted by sequence number and pass through one state
    in memory, however many they are: who owns a unit depends on every claim before, so
    they cannot be judged apart. With a ``snapshot`` (``unit_id`` and the state's columns)
    units start from there. The row with ``is_last`` carries the final state;
    with ``last_only`` it is the only one of its unit.
    """
    rows = with_event_defaults(events)
    # The manager of streaming queries sets up what a state store needs, in batches as well.
    assert events.sparkSession.streams is not None
    tasks = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The operator asks for this very partitioning and an order that begins with the unit,
    # so Spark adds neither a shuffle nor a sort that would undo the order of the numbers.
    ordered = rows.repartition(tasks, "unit_id").sortWithinPartitions("unit_id", "seq")
    start = None if snapshot is None else snapshot.select("unit_id", *STATE_NAMES).groupBy("unit_id")
    return ordered.groupBy("unit_id").transformWithState(
        statefulProcessor=UnitStateProcessor(stale_seconds, in_order=True, last_only=last_only),
        outputStructType=StructType.fromDDL(FOLD_COLUMNS),
        outputMode="append",
        timeMode="None",
        initialState=start,
    )


def with_event_defaults(events: DataFrame) -> DataFrame:
    """Events with every column of ``EVENT_COLUMNS``; absent flags are false."""
    flags = ("force", "retry_failed", "reclaim")
    columns = []
    for part in EVENT_COLUMNS.split(","):
        name, kind = part.split()
        value = F.col(name) if name in events.columns else F.lit(None)
        value = value.cast(kind)
        columns.append((F.coalesce(value, F.lit(False)) if name in flags else value).alias(name))
    return events.select(*columns)


def final_states(folded: DataFrame) -> DataFrame:
    """Current state per unit from a fold; units whose events were all rejected drop out."""
    return folded.filter(F.col("is_last") & F.col("status").isNotNull()).select(
        "unit_id", *STATE_NAMES
    )


def rejected_events(folded: DataFrame) -> DataFrame:
    """Events that did not change anything, with the reason."""
    return folded.filter(~F.col("accepted")).select(
        "unit_id", "seq", "kind", "event_claim_id", "reason"
    )


def archived_states(folded: DataFrame) -> DataFrame:
    """States that were put aside because the work changed or a repair was forced."""
    return folded.filter(F.col("archived_status").isNotNull()).select(
        "unit_id", "seq", "archived_status", "archived_fingerprint"
    )


def latest_per_unit(events: DataFrame, order: str = "seq") -> DataFrame:
    """Last row per unit, reduced on the map side."""
    return keep_last(events, ["unit_id"], order)


def latest_execution(executions: DataFrame) -> DataFrame:
    """The execution created last."""
    return executions.orderBy(F.desc("created_at"), F.desc("execution_id")).limit(1)


def last_items(items: DataFrame, executions: DataFrame) -> DataFrame:
    """Last item per unit over all executions."""
    placed = items.join(executions.select("execution_id", "created_at"), "execution_id")
    return keep_last(placed, ["item_id"], F.struct("created_at", "execution_id"))


def attempts_per_unit(claims: DataFrame) -> DataFrame:
    """Attempts of the latest work of each unit: its claims since the last change.

    ``claims`` is ``(unit_id, seq, fingerprint)``. Three mergeable aggregates replace a
    running count, so a unit with very many claims is not sorted in one task.
    """
    current = claims.groupBy("unit_id").agg(F.max_by("fingerprint", "seq").alias("fingerprint"))
    other = (
        claims.withColumnRenamed("fingerprint", "_seen")
        .join(current, "unit_id")
        .groupBy("unit_id", "fingerprint")
        .agg(F.max(F.when(~F.col("_seen").eqNullSafe(F.col("fingerprint")), F.col("seq"))).alias("_changed"))
    )
    return (
        claims.select("unit_id", "seq")
        .join(other, "unit_id")
        .filter(F.col("_changed").isNull() | (F.col("seq") > F.col("_changed")))
        .groupBy("unit_id", "fingerprint")
        .agg(F.count(F.lit(1)).alias("attempts"))
    )


def status_counts(states: DataFrame, requested: DataFrame | None = None) -> DataFrame:
    """Units per status, zero-filled; requested units without a state are pending."""
    spark = states.sparkSession
    if requested is None:
        statuses = states.select(F.coalesce("status", F.lit("pending")).alias("status"))
    else:
        statuses = (
            requested.select("unit_id")
            .join(states.select("unit_id", "status"), "unit_id", "left")
            .select(F.coalesce("status", F.lit("pending")).alias("status"))
        )
    counts = statuses.groupBy("status").agg(F.count(F.lit(1)).alias("_n"))
    fixed = F.broadcast(spark.createDataFrame([(s,) for s in STATUSES], "status STRING"))
    return fixed.join(counts, "status", "full").select(
        "status", F.coalesce("_n", F.lit(0)).cast("bigint").alias("n")
    )


def report_counts(outcomes: DataFrame) -> DataFrame:
    """Succeeded, failed and skipped units of one build."""
    return outcomes.agg(
        *[F.count_if(F.col("status") == s).alias(s) for s in ("succeeded", "failed", "skipped")]
    )


def is_stale(started: Column, now: Column, stale_seconds: float = STALE_SECONDS) -> Column:
    """Whether a claim is older than the threshold."""
    micros = [F.unix_micros(moment.cast("timestamp")) for moment in (now, started)]
    age = (micros[0] - micros[1]) / F.lit(1_000_000.0)
    return age > F.lit(float(stale_seconds))


def stale_claims(states: DataFrame, now: Column, stale_seconds: float = STALE_SECONDS) -> DataFrame:
    """Active units whose claim may be taken over."""
    return states.filter(
        F.col("status").isin(*ACTIVE) & is_stale(F.col("started_at"), now, stale_seconds)
    )


def plan_resume(
    items: DataFrame,
    states: DataFrame,
    outputs_valid: DataFrame | None,
    now: Column,
    *,
    retry_failed: bool = False,
    reclaim_running: bool = False,
    stale_seconds: float = STALE_SECONDS,
) -> DataFrame:
    """What to do with each item: reuse, skip, leave running, or claim.

    ``items`` is ``(unit_id, fingerprint)``; ``states`` the latest state per unit;
    ``outputs_valid`` is ``(unit_id, valid)`` for units with a success.
    """
    previous = states.select(
        "unit_id",
        F.col("status").alias("_status"),
        F.col("phase").alias("_phase"),
        F.col("fingerprint").alias("_fingerprint"),
        F.col("attempts").alias("_attempts"),
        F.col("started_at").alias("_started"),
        F.lit(True).alias("_known"),
    )
    joined = items.join(previous, "unit_id", "left")
    if outputs_valid is not None:
        joined = joined.join(outputs_valid.select("unit_id", F.col("valid").alias("_valid")), "unit_id", "left")
    else:
        joined = joined.withColumn("_valid", F.lit(True))
    known = F.col("_known").isNotNull()
    same = known & F.col("_fingerprint").eqNullSafe(F.col("fingerprint"))
    succeeded = F.coalesce(F.col("_status") == "succeeded", F.lit(False))
    failed = F.coalesce(F.col("_status") == "failed", F.lit(False))
    active = F.coalesce(F.col("_status").isin(*ACTIVE), F.lit(False))
    force = succeeded & same & ~F.coalesce(F.col("_valid"), F.lit(False))
    fresh = ~F.coalesce(is_stale(F.col("_started"), now, stale_seconds), F.lit(False))
    action = (
        F.when(succeeded & same & ~force, F.lit("reuse"))
        .when(failed & same & ~F.lit(retry_failed), F.lit("skip_failed"))
        .when(active & ~F.lit(reclaim_running) & fresh, F.lit("already_running"))
        .otherwise(F.lit("claim"))
    )
    claimed = F.col("action") == "claim"
    return (
        joined.withColumn("action", action)
        .withColumn("attempts", F.when(claimed, F.when(same, F.coalesce("_attempts", F.lit(0)) + 1).otherwise(F.lit(1))))
        .withColumn(
            "reset_outputs",
            ~known | force | ~same | failed | F.coalesce(F.col("_phase") == "processing", F.lit(False)),
        )
        .withColumn("archive_previous", claimed & known & (~same | force))
        .drop("_status", "_phase", "_fingerprint", "_attempts", "_started", "_known", "_valid")
    )


def outputs_valid(outputs: DataFrame, genomes: DataFrame, files: DataFrame) -> DataFrame:
    """Whether the recorded outputs and the genome of each success are still there.

    ``outputs`` is ``(unit_id, role, path, size, modified, sha256)`` as recorded,
    ``genomes`` is ``(unit_id, fasta)``, ``files`` the current inventory. An unchanged
    size and time is enough; otherwise the checksum must match.
    """
    now = files.select(
        "path", F.col("size").alias("_size"), F.col("modified").alias("_modified"), F.col("sha256").alias("_sha256")
    )
    untouched = (F.col("size") == F.col("_size")) & (F.col("modified") == F.col("_modified"))
    good = (F.col("_size") > 0) & (
        F.coalesce(untouched, F.lit(False)) | F.coalesce(F.col("sha256") == F.col("_sha256"), F.lit(False))
    )
    checked = (
        outputs.join(now, "path", "left")
        .groupBy("unit_id")
        .agg(F.bool_and(F.coalesce(good, F.lit(False))).alias("_outputs"))
    )
    fasta = (
        genomes.join(now.withColumnRenamed("path", "fasta"), "fasta", "left")
        .groupBy("unit_id")
        .agg(F.bool_and(F.coalesce(F.col("_size") > 0, F.lit(False))).alias("_genome"))
    )
    return checked.join(fasta, "unit_id", "left").select(
        "unit_id", (F.col("_outputs") & F.coalesce("_genome", F.lit(False))).alias("valid")
    )


def failure_text(error: Column) -> Column:
    """Error text as it is stored in a state."""
    return bounded_error(error, ERROR_CHARACTERS)
