"""Extensions beyond batch curation: windows, sessions, deduplication and state machines over unbounded input."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quern.schema import TRANSITIONS

LATE = "10 minutes"


def tumbling_counts(events: DataFrame, width: str = "1 hour", late: str = LATE) -> DataFrame:
    """(start, event_type, n, total) by event-time windows; works on tables and streams."""
    e = events.withWatermark("ts", late) if events.isStreaming else events
    return e.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = LATE) -> DataFrame:
    """(user_id, start, end, n): runs of a user's events with gaps below `gap`."""
    e = events.withWatermark("ts", late) if events.isStreaming else events
    return e.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def unique_events(events: DataFrame, key: list[str], late: str = LATE) -> DataFrame:
    """Each key once; on streams within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(key) if events.isStreaming else events.dropDuplicates(key)


def _step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState, keep_ms: int) -> Iterator[pd.DataFrame]:
    if state.hasTimedOut:  # no event for so long that the record counts as finished
        state.remove()
        return
    current = state.get[0] if state.exists else None
    for pdf in batches:
        out = []
        for wanted in pdf.sort_values("ts")["state"]:  # whether a move is legal hangs on the one before
            ok = current is None or wanted in TRANSITIONS.get(current, [])
            out.append((key[0], current, wanted, ok))
            if ok:
                current = wanted
        yield pd.DataFrame(out, columns=["id", "previous", "state", "accepted"])
    state.update((current,))
    state.setTimeoutDuration(keep_ms)


def lifecycle(events: DataFrame, keep: timedelta = timedelta(days=30)) -> DataFrame:
    """A stream (id, state, ts) to (id, previous, state, accepted); a record's state is kept and only legal moves change it.

    A state is forgotten once no event has come for `keep` (processing time), so that state does not grow for ever. For
    tables use resolve.check_transitions(), which needs no state.
    """
    step = partial(_step, keep_ms=int(keep.total_seconds() * 1000))
    return events.groupBy("id").applyInPandasWithState(step, "id string, previous string, state string, accepted boolean", "state string", "append", GroupStateTimeout.ProcessingTimeTimeout)


def incremental(events: DataFrame, sink: str, checkpoint: str, mode: str = "append"):
    """Works off everything that is new since the last call, once."""
    return events.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
