"""The streams against the batch operators they share their steps with."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.rows import dicts
from tidemark.operators import anomaly
from tidemark.params import Params
from tidemark.plans import catalog
from tidemark.sources.derived import StarSchema
from tidemark.streaming.alerts import alert_writer, read_alerts, run_alerts, stored_slots
from tidemark.streaming.slots import read_slots, run_to_files, stream_slot_metrics
from tidemark.streaming.state import STATE_STORE

FOLDER = "/root/testdata/sf0.001"
P = Params(as_of=date(2024, 1, 30))
FEED = "user_id bigint, time timestamp, action string"
MESSAGES = "user_id bigint, time timestamp"
FILE_MANAGER = "spark.sql.streaming.checkpointFileManagerClass"


@pytest.fixture(autouse=True)
def quick_local_files(spark):
    spark.conf.set(
        FILE_MANAGER,
        "org.apache.spark.sql.execution.streaming.checkpointing"
        ".FileSystemBasedCheckpointFileManager",
    )
    yield
    spark.conf.unset(FILE_MANAGER)


def _closed_slots(spark):
    table = StarSchema(spark, FOLDER)
    slots = anomaly.slot_metrics(table.feed, table.messages, P)
    newest = min(
        table.feed.agg(F.max("time")).first()[0], table.messages.agg(F.max("time")).first()[0]
    )
    # The watermark keeps whole milliseconds.
    watermark = (newest - timedelta(hours=1)).replace(
        microsecond=newest.microsecond // 1000 * 1000
    )
    return slots.where(
        F.col("period") + F.expr("interval 15 minutes")
        <= F.lit(watermark.isoformat(sep=" ")).cast("timestamp_ntz")
    )


def test_stream_equals_batch_on_closed_slots(spark):
    found = catalog.queries()["stream_slot_metrics"](spark, FOLDER)
    expected = dicts(catalog._rounded(_closed_slots(spark)), "period")
    assert expected and dicts(found, "period") == expected


def test_stream_alerts_equal_the_back_test(spark):
    found = catalog.queries()["stream_alerts"](spark, FOLDER)
    closed = _closed_slots(spark)
    bands = anomaly.iqr_bands(closed, anomaly.following_days(P), P)
    expected = catalog._rounded(anomaly.alert_messages(bands, last_only=False))
    rows = dicts(found, "period", "metric")
    assert rows == dicts(expected, "period", "metric")


def _write(spark, path, rows, schema):
    frame = spark.createDataFrame(rows, schema)
    frame.coalesce(1).write.mode("append").parquet(path)


def _streams(spark, folder):
    feed = spark.readStream.schema(FEED).parquet(f"{folder}/feed")
    messages = spark.readStream.schema(MESSAGES).parquet(f"{folder}/messages")
    return stream_slot_metrics(feed, messages, P)


def test_late_events_and_restarts(spark, tmp_path):
    start = datetime(2024, 1, 30, 10)

    def run(minute, users, moves=("view",)):
        when = start + timedelta(minutes=minute)
        _write(spark, f"{tmp_path}/feed", [(u, when, a) for u in users for a in moves], FEED)
        _write(spark, f"{tmp_path}/messages", [(u, when) for u in users], MESSAGES)
        run_to_files(
            _streams(spark, tmp_path), f"{tmp_path}/out", f"{tmp_path}/check"
        ).awaitTermination()
        return {
            r.hm: (r.views, r.likes, r.feed_users, r.mes_users)
            for r in read_slots(spark, f"{tmp_path}/out").collect()
        }

    assert run(1, [1, 2]) == {}
    assert run(50, [1]) == {}  # within the watermark's hour
    assert run(3, [2, 3], ("view", "like")) == {}  # late, but its slot is open
    assert run(200, [1])["10:00"] == (4, 2, 3, 3)
    assert run(4, [9])["10:00"] == (4, 2, 3, 3)  # too late: the slot is closed
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != list(
        STATE_STORE.values()
    )[0]


def test_a_repeated_batch_leaves_no_second_alert(spark, tmp_path):
    start = datetime(2024, 1, 30, 10)
    values = [10.0] * 6 + [500.0]
    rows = [
        (start.date(), start + timedelta(minutes=15 * i), "", 1, 1, int(v), 0, 0.0, 1)
        for i, v in enumerate(values)
    ]
    slots = spark.createDataFrame(
        rows,
        "event_date date, period timestamp, hm string, mes_users bigint, sent_messages bigint,"
        " views bigint, likes bigint, ctr double, feed_users bigint",
    )
    write = alert_writer(f"{tmp_path}/slots", f"{tmp_path}/alerts", P)
    write(slots.limit(0), 0)
    write(slots.where("views < 500"), 1)
    write(slots.where("views = 500"), 2)
    write(slots.where("views = 500"), 2)
    alerts = read_alerts(spark, f"{tmp_path}/alerts").collect()
    assert [(a.metric, a.value, a.reported_value) for a in alerts] == [("Views", 500.0, 10.0)]


def test_alerts_over_several_runs_equal_one_back_test(spark, tmp_path):
    start = datetime(2024, 1, 29, 8)
    feed, messages = [], []
    for slot in range(40):
        when = start + timedelta(minutes=15 * slot + 1)
        users = range(30 if slot % 13 == 12 else 2 + slot % 2)
        feed += [(u, when, "view" if u % 3 else "like") for u in users]
        messages += [(u, when) for u in users]
    cuts = [start, start + timedelta(hours=3), start + timedelta(hours=6), datetime(2024, 2, 1)]
    for first, last in zip(cuts, cuts[1:]):
        _write(spark, f"{tmp_path}/feed", [r for r in feed if first <= r[1] < last], FEED)
        part = [r for r in messages if first <= r[1] < last]
        _write(spark, f"{tmp_path}/messages", part, MESSAGES)
        run_alerts(
            _streams(spark, tmp_path),
            f"{tmp_path}/slots",
            f"{tmp_path}/alerts",
            f"{tmp_path}/check",
            P,
        ).awaitTermination()
    slots = anomaly.slot_metrics(
        spark.createDataFrame(feed, FEED), spark.createDataFrame(messages, MESSAGES), P
    ).where("period < timestamp'2024-01-29 16:45:00'")  # the last hour is still open
    bands = anomaly.iqr_bands(slots, anomaly.following_days(P), P)
    expected = dicts(anomaly.alert_messages(bands, last_only=False), "period", "metric")
    found = dicts(read_alerts(spark, f"{tmp_path}/alerts"), "period", "metric")
    assert {r["metric"] for r in expected} >= {"Views", "Feed_users", "Mes_users"}
    assert found == [{**r, "period": r["period"].replace(tzinfo=None)} for r in expected]


def _slots(spark, values, start):
    rows = [
        (start.date(), start + timedelta(minutes=15 * i), "", 1, 1, int(v), 0, 0.0, 1)
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(
        rows,
        "event_date date, period timestamp, hm string, mes_users bigint, sent_messages bigint,"
        " views bigint, likes bigint, ctr double, feed_users bigint",
    )


def test_a_new_checkpoint_on_an_old_history_loses_and_doubles_nothing(spark, tmp_path):
    history, alerts = f"{tmp_path}/slots", f"{tmp_path}/alerts"
    old = _slots(spark, [10, 10, 10, 10, 500, 10, 10], datetime(2024, 1, 30, 10))
    write = alert_writer(history, alerts, P)
    for batch in (0, 1, 2):
        write(old.where(f"minute(period) / 15 % 3 = {batch}"), batch)
    before = dicts(read_alerts(spark, alerts), "period", "metric")
    assert before
    # Batches count from 0 again; the last old slot comes once more, with new ones.
    again = _slots(spark, [10, 900, 10], datetime(2024, 1, 30, 11, 30))
    write = alert_writer(history, alerts, P)
    write(again, 0)
    write(_slots(spark, [10], datetime(2024, 1, 31, 0, 15)), 1)
    after = dicts(read_alerts(spark, alerts), "period", "metric")
    kept = [r for r in after if r["period"] < datetime(2024, 1, 30, 11, 30)]
    assert kept == [r for r in before if r["period"] < datetime(2024, 1, 30, 11, 30)]
    assert len({(r["period"], r["metric"]) for r in after}) == len(after)
    assert 900 in [r["value"] for r in after]
    stored = stored_slots(spark, history)
    assert stored.count() == 10 == stored.select("period").distinct().count()


def test_event_tables_as_a_stream(spark, tmp_path):
    from tests.rows import feed, messages
    from tidemark.__main__ import main
    from tidemark.sources.tables import FEED_ACTIONS, MESSAGE_ACTIONS, append_events

    paths = {name: f"{tmp_path}/{name}" for name in ("feed", "messages", "target")}
    clock = [f"2024-01-30 {h:02d}:{m:02d}" for h in (10, 11, 12) for m in (0, 15, 30, 45)]
    rows = [(u, t, "view") for t in clock for u in range(40 if t.endswith("11:00") else 3)]
    for part in ("10", "11", "12"):
        own = [r for r in rows if r[1][11:13] == part]
        append_events(feed(spark, own), FEED_ACTIONS, paths["feed"])
        sent = [(u, u + 1, t) for u, t, _ in own]
        append_events(messages(spark, sent), MESSAGE_ACTIONS, paths["messages"])
        main(["alert-stream", "--as-of=2024-01-30", *[f"--{n}={p}" for n, p in paths.items()]])
    found = dicts(read_alerts(spark, f"{paths['target']}/stream_alerts"), "period", "metric")
    assert {(r["period"].hour, r["metric"]) for r in found if r["value"] == 40} == {
        (11, m) for m in ("Views", "Feed_users", "Mes_users", "Sent_messages")
    }
