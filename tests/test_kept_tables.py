"""Tables that runs keep: loads by day, logs of slots, users by bucket."""

from __future__ import annotations

import json
import random
from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.rows import dicts, feed, messages
from tests.test_sources_and_jobs import some_rows
from tidemark.functions.calendar import on_days
from tidemark.operators import anomaly, cohorts, slices
from tidemark.params import Params
from tidemark.plans import jobs, seen
from tidemark.sources import loads, tables
from tidemark.sources.scratch import run_folder, shared_folder
from tidemark.sources.tables import (
    FEED_ACTIONS,
    MESSAGE_ACTIONS,
    append_events,
    read_events,
    stream_events,
    write_events,
)
from tidemark.streaming import alerts as stream_alerts
from tidemark.streaming.log import FILES, SlotLog
from tidemark.streaming.slots import stream_slot_metrics

P = Params(as_of=date(2024, 1, 30))


def users(frame) -> list[int]:
    return sorted(r.user_id for r in frame.collect())


def test_a_load_counts_once_it_is_whole_and_days_are_listed_alone(spark, tmp_path):
    path = str(tmp_path / "feed")
    rows = lambda *users: feed(spark, [(u, f"2024-01-{u:02d} 10:00", "view") for u in users])
    append_events(rows(3, 4, 5), FEED_ACTIONS, path)
    before = loads.load_sources(spark, [path])
    assert sorted(before) == [date(2024, 1, d) for d in (3, 4, 5)]
    # A load that has written files but did not come to its end.
    rows(4).withColumn("event_date", F.to_date("time")).withColumn("load", F.lit("half")).write.mode(
        "append"
    ).partitionBy("event_date", "load").parquet(path)
    assert users(read_events(spark, FEED_ACTIONS, path)) == [3, 4, 5]
    assert loads.load_sources(spark, [path]) == before
    days = [date(2024, 1, 4), date(2024, 1, 9)]
    own = read_events(spark, FEED_ACTIONS, path, days=days)
    assert users(own) == [4]
    assert all("event_date=2024-01-04" in name for name in own.inputFiles())
    assert users(read_events(spark, FEED_ACTIONS, path, days=[date(2024, 2, 1)])) == []
    append_events(rows(4), FEED_ACTIONS, path)
    changed = loads.load_sources(spark, [path])
    assert [d.day for d in before if before[d] != changed[d]] == [4]
    write_events(rows(4, 6), FEED_ACTIONS, path)
    assert users(read_events(spark, FEED_ACTIONS, path)) == [3, 4, 5, 6]
    append_events(rows(4), FEED_ACTIONS, path)
    assert users(read_events(spark, FEED_ACTIONS, path)) == [3, 4, 4, 5, 6]
    append_events(rows(), FEED_ACTIONS, path)
    assert loads.load_sources(spark, [path, f"{tmp_path}/none"]) is None


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_damaged_rows_are_set_aside_with_their_reason(spark, tmp_path, fmt):
    names = FEED_ACTIONS.names
    good = [1, "2024-01-29 10:00:00", "view", 0, 20, "iOS", "Peru", "ads"]
    rows = [good, [2, *good[1:]], [3, "yesterday", *good[2:]], [None, *good[1:]], [4, None, *good[2:]]]
    source = tmp_path / "in"
    source.mkdir()
    if fmt == "csv":
        lines = [",".join("" if v is None else str(v) for v in row) for row in rows] + ["x,y"]
    else:
        lines = [json.dumps(dict(zip(names, row, strict=True))) for row in rows] + ["{broken"]
    (source / "rows").write_text("\n".join(lines) + "\n")
    path, aside = f"{tmp_path}/feed", f"{tmp_path}/aside"
    counts = tables.load_sifted(spark, FEED_ACTIONS, str(source), fmt, path, aside)
    assert counts == {"kept": 2, "unreadable": 2, "no user_id": 1, "no time": 1}
    assert sum(counts.values()) == len(lines)
    assert users(read_events(spark, FEED_ACTIONS, path)) == [1, 2]
    found = spark.read.parquet(aside).collect()
    assert len(found) == 4 and all(r.raw and r.file.endswith("rows") for r in found)
    assert any(lines[-1] in r.raw for r in found if r.reason == "unreadable")


def test_days_of_slices_are_published_together(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "slices")
    days = [date(2024, 1, 28), date(2024, 1, 29)]

    def of(n, *some):
        rows = [(day, "os", "iOS", n, 0, 0, 0, 0, 0) for day in some]
        return spark.createDataFrame(rows, slices.SLICE_METRICS)

    def held():
        return [r[3] for r in sorted(map(tuple, slices.read_slices(spark, path).collect()))]

    slices.write_slices(of(1, *days), path, days)
    publish = slices._publish

    def killed(*args):
        raise KeyboardInterrupt

    monkeypatch.setattr(slices, "_publish", killed)
    with pytest.raises(KeyboardInterrupt):
        slices.write_slices(of(2, *days), path, days)
    assert held() == [1, 1]
    monkeypatch.setattr(slices, "_publish", publish)
    slices.write_slices(of(3, *days), path, days)
    assert held() == [3, 3]
    slices.write_slices(of(4, days[0]), path, days)
    assert held() == [4]
    slices.write_slices(of(5, days[1]), path)
    assert held() == [4, 5]


LOG = T.StructType([T.StructField("period", T.TimestampType()), T.StructField("x", T.LongType())])


def log_rows(spark, *rows):
    return spark.createDataFrame([(datetime(2024, 1, d, h), x) for d, h, x in rows], LOG)


def held(log, *days):
    return sorted((r.period.day, r.period.hour, r.x) for r in log.rows(*days).collect())


def test_the_newest_version_of_a_slot_counts_and_days_are_gathered(spark, tmp_path):
    log = SlotLog(spark, str(tmp_path / "log"), LOG)
    first, second = date(2024, 1, 1), date(2024, 1, 2)
    assert held(log) == []
    log.add(log_rows(spark, (1, 1, 10), (1, 2, 20), (2, 1, 30)), [first, second])
    log.add(log_rows(spark, (1, 2, 21)), [first])
    log.add(log_rows(spark, (1, 2, 21)), [first])
    assert held(log) == [(1, 1, 10), (1, 2, 21), (2, 1, 30)]
    assert held(log, second) == [(2, 1, 30)] and held(log, None, first) == [(1, 1, 10), (1, 2, 21)]
    log.add(log_rows(spark, (1, 1, 0)).withColumn("gone", F.lit(True)), [first])
    assert held(log, first, first) == [(1, 2, 21)]
    for x in range(FILES + 3):
        log.add(log_rows(spark, (1, 3, x)), [first])
        assert held(log) == [(1, 2, 21), (1, 3, x), (2, 1, 30)]
    files = list((tmp_path / "log" / "event_date=2024-01-01").glob("*.parquet"))
    assert len(files) <= FILES
    log.add(log_rows(spark, (1, 1, 11)), [first])
    assert (1, 1, 11) in held(log)


def test_late_rows_give_the_slots_and_alerts_of_all_rows(spark, tmp_path):
    pick = random.Random(5)
    start, rows = datetime(2024, 1, 28, 20), []
    for slot in range(70):
        when = start + timedelta(minutes=15 * slot + 2)
        rows += [(u, str(when)) for u in range(25 if slot % 11 == 10 else 2 + pick.randrange(2))]
    late = [(u + 50, str(start + timedelta(minutes=15 * s + 5))) for s in (3, 20, 41) for u in range(30)]
    late += [(90, str(start + timedelta(minutes=15 * 69 + 6)))]
    paths = f"{tmp_path}/feed", f"{tmp_path}/messages"
    logs = f"{tmp_path}/slots", f"{tmp_path}/alerts"

    def load(some, write=append_events):
        views = feed(spark, [(u, t, "view" if u % 3 else "like") for u, t in some])
        write(views, FEED_ACTIONS, paths[0])
        write(messages(spark, [(u, u + 1, t) for u, t in some]), MESSAGE_ACTIONS, paths[1])

    def correct():
        events = (
            read_events(spark, FEED_ACTIONS, paths[0]), read_events(spark, MESSAGE_ACTIONS, paths[1])
        )
        sources = loads.load_sources(spark, paths)
        days = jobs.run_late_corrections(*events, P, *logs, f"{tmp_path}/store", sources)
        newest = stream_alerts.stored_slots(spark, logs[0]).agg(F.max("period")).first()[0]
        slots = anomaly.slot_metrics(*events, P).where(F.col("period") <= F.lit(str(newest)))
        found = stream_alerts.stored_slots(spark, logs[0])
        found = found.withColumn("period", F.col("period").cast("timestamp_ntz"))
        assert dicts(found.select(*slots.columns), "period") == dicts(slots, "period")
        bands = anomaly.iqr_bands(slots, anomaly.following_days(P), P)
        told = dicts(anomaly.alert_messages(bands, last_only=False), "period", "metric")
        assert dicts(stream_alerts.read_alerts(spark, logs[1]), "period", "metric") == told
        return days, told

    load(rows)
    streams = [
        stream_events(spark, schema, path)
        for schema, path in zip((FEED_ACTIONS, MESSAGE_ACTIONS), paths, strict=True)
    ]
    stream_alerts.run_alerts(
        stream_slot_metrics(*streams, P), *logs, f"{tmp_path}/check", P
    ).awaitTermination()
    days, before = correct()
    assert days == [] and before
    load(late)
    days, after = correct()
    assert days == [date(2024, 1, 28), date(2024, 1, 29)] and after != before
    assert correct() == ([], after)
    # A day that is loaded anew may lose slots.
    load([r for r in rows if r[1] < "2024-01-28 22"], write_events)
    assert correct()[0] == [date(2024, 1, 28)]


def test_a_run_leaves_no_steps_behind(spark, tmp_path):
    with run_folder(spark) as folder:
        first = f"{shared_folder(spark, 'step')}"
        assert first.startswith(f"{folder}/step-")
        spark.range(5).write.parquet(first)
        with run_folder(spark, "inner") as inner:
            spark.range(3).write.parquet(f"{inner}/x")
        spark.read.parquet(first).write.parquet(f"{tmp_path}/result")
    assert not shared_folder(spark, "step").startswith(folder)
    assert spark.read.parquet(f"{tmp_path}/result").count() == 5
    for gone in (first, inner):
        with pytest.raises(AnalysisException):
            spark.read.parquet(gone)


def scans_below(plan: str, node: str) -> list[bool]:
    """For each scan of the table of users, whether a node of that name is above it."""
    found, above = [], []
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" +-:*(0123456789)"))
        above = [(d, name) for d, name in above if d < depth]
        above.append((depth, line[depth:]))
        if "Bucketed: true" in line:
            found.append(any(name.startswith(node) for _, name in above))
    return found


def test_the_table_of_users_follows_the_events_and_is_not_shuffled(spark, tmp_path):
    path, store = str(tmp_path / "feed"), str(tmp_path / "seen")

    def load(rows, write=append_events):
        write(feed(spark, [(u, t, "view") for u, t in rows]), FEED_ACTIONS, path)

    def same(day):
        p = replace(P, as_of=date(2024, 1, day))
        events = read_events(spark, FEED_ACTIONS, path)
        sources = loads.load_sources(spark, [path])
        found = dicts(jobs.seen_weekly_dynamics(events, p, store, sources, buckets=4))
        own = on_days(events, [(date(2024, 1, 1), p.as_of)])
        assert found == dicts(cohorts.weekly_dynamics(cohorts.user_weeks(own)))
        return found

    load(some_rows(2, 14, 1))
    same(14)
    load(some_rows(15, 25, 2))
    first = same(25)
    load([(70, "2024-01-18 10:00"), (71, "2024-01-04 10:00"), (71, "2024-01-23 10:00")])
    assert same(25) != first
    assert same(25) == same(25)
    same(10)
    load(some_rows(8, 9, 7)[:5], write_events)
    same(25)
    kept = seen.SeenUsers(spark, store, 4)
    version, _ = kept._merged()
    weeks = spark.createDataFrame([(date(2024, 1, 28), 5)], seen.WEEK_USERS)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(threshold, -1)
    try:
        merged = kept.merge(version, weeks)
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(threshold)
    assert scans_below(plan, "Exchange") == [False]


def test_a_grid_of_back_tests_equals_single_ones(spark):
    pick = random.Random(9)
    rows = []
    for slot in range(400):
        when = datetime(2024, 1, 27) + timedelta(minutes=15 * slot)
        if pick.random() < 0.9:
            views = pick.randrange(5) * (9 if slot % 37 == 0 else 1)
            likes = pick.randrange(3)
            ctr = likes / views if views else None
            rows.append((when.date(), when, "", 1 + slot % 3, 4, views, likes, ctr, 2))
    slots = spark.createDataFrame(
        rows,
        "event_date date, period timestamp_ntz, hm string, mes_users bigint, sent_messages bigint,"
        " views bigint, likes bigint, ctr double, feed_users bigint",
    )
    factors, widths = (0.5, 2.0), (0, 2, 5)
    grid = anomaly.backtest_grid(slots, P, factors, widths)
    found = dicts(grid, "iqr_a", "neighbour_slots", "metric", "event_date")
    expected = []
    for a in factors:
        for width in widths:
            flags = anomaly.anomaly_backtest(slots, replace(P, iqr_a=a, neighbour_slots=width))
            per_day = flags.groupBy("metric", F.to_date("period").alias("event_date")).agg(
                F.count("*").alias("slots"), F.count("low").alias("with_band"),
                F.count_if("is_anomaly").alias("flagged"),
            )
            expected += [{"iqr_a": a, "neighbour_slots": width, **r} for r in dicts(per_day)]
    order = ("iqr_a", "neighbour_slots", "metric", "event_date")
    assert found == sorted(expected, key=lambda r: tuple(str(r[c]) for c in order))
    assert len({r["flagged"] for r in found}) > 3


@pytest.fixture(autouse=True)
def quick_local_files(spark):
    name = "spark.sql.streaming.checkpointFileManagerClass"
    spark.conf.set(
        name,
        "org.apache.spark.sql.execution.streaming.checkpointing"
        ".FileSystemBasedCheckpointFileManager",
    )
    yield
    spark.conf.unset(name)
