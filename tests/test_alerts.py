"""Close-slippage alerts: late, early and repeated events, restarts, dropped state."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from ledgerflow.streaming import alerts

D = dt.datetime


def event(task, kind, at, due=None):
    return (task, "CO0", 2001, 1, "T12", kind, at, due)


@pytest.fixture
def run(spark, tmp_path):
    """Send each batch of events, then wait until the stream has no more to say."""
    sent = [0]

    def go(batch):
        sent[0] += 1
        spark.createDataFrame(batch, alerts.EVENTS).coalesce(1).write.parquet(str(tmp_path / "events" / f"{sent[0]:03d}"))
        stream = spark.readStream.schema(alerts.EVENTS).parquet(str(tmp_path / "events" / "*"))
        query = alerts.start_alerts(stream, str(tmp_path / "out"), str(tmp_path / "ckpt"), "1 day")
        query.awaitTermination()
        go.state = spark.read.format("statestore").load(str(tmp_path / "ckpt")).select("key.*").collect()
        found = spark.read.parquet(str(tmp_path / "out")).collect() if glob.glob(str(tmp_path / "out" / "*.parquet")) else []
        return sorted((r["close_task_id"], r["alert"], r["alert_time"], r["days_late"]) for r in found)

    return go


def test_alerts_of_late_early_and_repeated_events(run):
    due = dt.date(2001, 2, 7)
    end = D(2001, 2, 8)
    first = [event(k, "scheduled", D(2001, 1, 31), due) for k in (1, 2, 3, 4)] + [event(5, "completed", D(2001, 2, 1, 9))]  # 5 is early
    assert run(first) == []
    # 1 in time, and both its events again; a clock tick of another task moves the watermark to the evening of the due day
    assert run([event(1, "completed", D(2001, 2, 6, 10)), event(1, "completed", D(2001, 2, 6, 12)), event(1, "scheduled", D(2001, 1, 31), due),
                event(5, "scheduled", D(2001, 2, 1, 12), due), event(90, "scheduled", D(2001, 2, 8, 20), dt.date(2001, 3, 7))]) == []
    # past the due day: 2, 3 and 4 are overdue, 1 and 5 are not
    overdue = [(k, "overdue", end, 0) for k in (2, 3, 4)]
    assert run([event(2, "completed", D(2001, 2, 9, 8)), event(90, "scheduled", D(2001, 2, 11), dt.date(2001, 3, 7))]) == sorted(
        [*overdue, (2, "completed_late", D(2001, 2, 9, 8), 2)])
    # repeated and still later completions: one alert each; an event older than the watermark is dropped
    after = run([event(3, "completed", D(2001, 2, 12)), event(3, "completed", D(2001, 2, 12)), event(4, "completed", D(2001, 2, 1)),
                 event(2, "completed", D(2001, 2, 13)), event(90, "scheduled", D(2001, 2, 14, 12), dt.date(2001, 3, 7))])
    assert after == sorted([*overdue, (2, "completed_late", D(2001, 2, 9, 8), 2), (3, "completed_late", D(2001, 2, 12), 5)])
    # tasks that were done are forgotten: what is left is 4, which nobody completed, the tick's task, and 2's second completion
    assert run([event(90, "scheduled", D(2001, 2, 20), dt.date(2001, 3, 7))]) == after
    assert sorted(r[0] for r in run.state) == [2, 4, 90]


def test_events_in_any_batches_give_the_same_alerts(spark, run, ctx):
    """All events at once against the answer that the table itself gives."""
    tasks = ctx.L.close_tasks.where("fiscal_year >= 2001")
    got = run([tuple(r) for r in alerts.close_events(tasks).collect()])
    hi = tasks.agg(F.greatest(F.max("period_end_date"), F.max("actual_completion_date"))).first()[0]
    day = dt.timedelta(days=1)
    want = []
    for r in tasks.collect():
        done, end = r["actual_completion_date"], r["due_date"] + day
        if done >= end if done else hi - day > end:
            want.append((r["close_task_id"], "overdue", D(end.year, end.month, end.day), 0))
            if done:
                want.append((r["close_task_id"], "completed_late", D(done.year, done.month, done.day), (done - r["due_date"]).days))
    assert got == sorted(want) and got
