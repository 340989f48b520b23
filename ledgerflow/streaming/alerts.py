"""Close-slippage alerts: a stateful stream over close-task events.

A ``scheduled`` event names a task and its due date, a ``completed`` event says when it was done.  Each task has a
state with an event-time timer at the end of its due day.  When the watermark passes the timer and the task is not
done, an ``overdue`` alert is sent, and a later completion sends ``completed_late`` with the days.  Events may come
early (a completion before its schedule), late or more than once; a task alerts once.  The state of a task that was
scheduled and completed is dropped when the watermark is past both, for then its events count as late if they are
repeated.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

EVENTS = ("close_task_id long, company_code string, fiscal_year int, fiscal_period int, task_id string, "
          "event string, event_time timestamp, due_date date")
_NAMES = ["company_code", "fiscal_year", "fiscal_period", "task_id"]
_STATE = "company_code string, fiscal_year int, fiscal_period int, task_id string, due_ms long, done_ms long, overdue_sent boolean, late_sent boolean"
_FIELDS = [*_NAMES, "due_ms", "done_ms", "overdue_sent", "late_sent"]
_SENT = "close_task_id long, company_code string, fiscal_year int, fiscal_period int, task_id string, alert string, due_ms long, alert_ms long"
_COLUMNS = ["close_task_id", *_NAMES, "alert", "due_ms", "alert_ms"]
#: How long a task waits for the event that it lacks, its completion or its schedule; one that comes later says nothing.
RETAIN_DAYS = 400
_DAY = 86_400_000


def _alerts(task: int, held: dict, now: int) -> Iterator[tuple]:
    """What a task has to say at watermark ``now``; marks in ``held`` what was said.  ``due_ms`` is the due day's end."""
    due, done = held["due_ms"], held["done_ms"]
    if due is None or not (done >= due if done is not None else now > due):
        return
    key = (task, *[held[n] for n in _NAMES])
    if not held["overdue_sent"]:
        held["overdue_sent"] = True
        yield (*key, "overdue", due, due)
    if done is not None and not held["late_sent"]:
        held["late_sent"] = True
        yield (*key, "completed_late", due, done)


def _wake(held: dict, now: int) -> int:
    """When to look at a task again: at the due day's end, then when nothing more is awaited."""
    due, done = held["due_ms"], held["done_ms"]
    if due is not None and done is not None:
        return max(due, done)  # from then on repeated events are late, and the state can go
    if due is not None and not held["overdue_sent"]:
        return due
    known = [t for t in (due, done) if t is not None]
    return max(known, default=now) + RETAIN_DAYS * _DAY


def _on_task(key, batches, state: GroupState):
    import pandas as pd

    held = dict(zip(_FIELDS, state.get, strict=True)) if state.exists else dict.fromkeys(_FIELDS[:-2]) | {"overdue_sent": False, "late_sent": False}
    now, timed_out = state.getCurrentWatermarkMs(), state.hasTimedOut
    if not timed_out:
        for frame in batches:
            for e in frame.sort_values(["event_ms", "event"]).itertuples():
                for name in _NAMES:
                    if held[name] is None:
                        held[name] = getattr(e, name)
                if e.event == "scheduled" and held["due_ms"] is None and not pd.isna(e.due_ms):
                    held["due_ms"] = int(e.due_ms)
                elif e.event == "completed" and held["done_ms"] is None:  # of several completions the first known counts
                    held["done_ms"] = int(e.event_ms)
    waited = timed_out and _wake(held, now) < now
    sent = list(_alerts(key[0], held, now))
    if waited and (held["done_ms"] is not None or held["due_ms"] is None or _wake(held, now) < now):
        state.remove()
    else:
        state.update(tuple(held[n] for n in _FIELDS))
        state.setTimeoutTimestamp(max(_wake(held, now), now) + 1)
    yield pd.DataFrame(sent, columns=_COLUMNS)


def slippage(events: DataFrame, lateness: str = "1 day") -> DataFrame:
    """The alerts ``(close_task_id, ..., alert, due_date, alert_time, days_late)`` of a stream of EVENTS.

    An event counts as late, and is dropped, when it is older than the newest by more than ``lateness``.
    """
    due_end = F.unix_millis(F.date_add("due_date", 1).cast("timestamp"))
    timed = events.withWatermark("event_time", lateness).select(
        "close_task_id", *_NAMES, "event", "event_time", F.unix_millis("event_time").alias("event_ms"), due_end.alias("due_ms"))
    sent = timed.groupBy("close_task_id").applyInPandasWithState(_on_task, _SENT, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    due = F.date_sub(F.to_date(F.timestamp_millis("due_ms")), 1)
    at = F.timestamp_millis("alert_ms")
    late = F.when(F.col("alert") == "completed_late", F.date_diff(F.to_date(at), due)).otherwise(0)
    return sent.select("close_task_id", *_NAMES, "alert", due.alias("due_date"), at.alias("alert_time"), late.alias("days_late"))


def start_alerts(events: DataFrame, path: str, checkpoint: str, lateness: str = "1 day", available_now: bool = True) -> StreamingQuery:
    """Write the alerts to Parquet files below ``path``; a restart goes on from the checkpoint, each alert once."""
    writer = slippage(events, lateness).writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()


def close_events(close_tasks: DataFrame) -> DataFrame:
    """The events that led to a table of close tasks: each scheduled at its period's end, done ones completed."""
    key = ["close_task_id", "company_code", "fiscal_year", "fiscal_period", "task_id"]
    planned = close_tasks.select(*key, F.lit("scheduled").alias("event"), F.col("period_end_date").cast("timestamp").alias("event_time"), "due_date")
    done = close_tasks.where(F.col("actual_completion_date").isNotNull()).select(
        *key, F.lit("completed").alias("event"), F.col("actual_completion_date").cast("timestamp").alias("event_time"),
        F.lit(None).cast("date").alias("due_date"))
    return planned.unionByName(done)
