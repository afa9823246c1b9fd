"""Unit state fold as a stream: the processor of the batch fold on Spark's state store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from ..operators.state import FOLD_COLUMNS, HELD_EVENTS, STALE_SECONDS, STATE_NAMES, UnitStateProcessor, with_event_defaults


def fold_event_stream(
    events: DataFrame,
    stale_seconds: float = STALE_SECONDS,
    *,
    snapshot: DataFrame | None = None,
    report_stale: bool = False,
    held_events: int = HELD_EVENTS,
) -> DataFrame:
    """Streaming counterpart of ``operators.state.fold_events``.

    The state of each unit is one row in the RocksDB state store; no history is held. The
    events of a micro-batch are put in order by the processor; the source must deliver
    micro-batches in order. Units of a ``snapshot`` start from its states.
    """
    start = None if snapshot is None else snapshot.select("unit_id", *STATE_NAMES).groupBy("unit_id")
    return (
        with_event_defaults(events)
        .groupBy("unit_id")
        .transformWithState(
            statefulProcessor=UnitStateProcessor(stale_seconds, report_stale=report_stale, held_events=held_events),
            outputStructType=StructType.fromDDL(FOLD_COLUMNS),
            outputMode="append",
            timeMode="ProcessingTime" if report_stale else "None",
            initialState=start,
        )
    )
