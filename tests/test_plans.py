"""The plans: what is pushed to the scan, how often tables are read, which joins appear."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import activity, reports
from tidemark.plans import catalog, jobs
from tidemark.plans.catalog import P
from tidemark.sources.derived import StarSchema
from tidemark.sources.tables import (
    FEED_ACTIONS,
    MESSAGE_ACTIONS,
    read_events,
    write_events,
)

FOLDER = "/root/testdata/sf0.001"
STREAMS = {"stream_slot_metrics", "stream_alerts"}
WRITERS = STREAMS | {"slice_sink", "slots_from_store", "weekly_from_store", "alert_run"}


def plan(frame, mode: str = "formatted") -> str:
    execution = frame._jdf.queryExecution()
    return frame.sparkSession._jvm.PythonSQLUtils.explainString(execution, mode)


def scan_lines(text: str, label: str) -> list[str]:
    return [line for line in text.splitlines() if line.startswith(label)]


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - WRITERS))
def test_no_python_and_no_pairing_of_everything(spark, name):
    text = plan(catalog.queries()[name](spark, FOLDER))
    for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text


@pytest.mark.parametrize(
    "name",
    [
        "filter_yesterday",
        "filter_last_7_days",
        "filter_last_30_days",
        "filter_reference_days",
        "slice_metrics_daily",
        "feed_kpi_7d",
        "slot_metrics_15m",
    ],
)
def test_days_reach_the_scan(spark, name):
    text = plan(catalog.queries()[name](spark, FOLDER))
    pushed = scan_lines(text, "PushedFilters")
    assert pushed and all("GreaterThanOrEqual(ts," in line for line in pushed)


@pytest.mark.parametrize(
    ("name", "reads"),
    [
        ("feed_weekly_dynamics", 1),
        ("msg_weekly_dynamics", 1),
        ("first_seen_week", 1),
        ("service_usage", 2),
        ("service_usage_stack", 2),
        ("iqr_bands", 2),
        ("slot_history", 2),
        ("band_backfill", 2),
        ("alert_chart_series", 2),
        ("alert_messages", 2),
        ("anomaly_backtest", 2),
    ],
)
def test_each_table_is_read_once(spark, name, reads):
    text = plan(catalog.queries()[name](spark, FOLDER))
    schemas = scan_lines(text, "ReadSchema")
    assert len([line for line in schemas if "ts:" in line]) == reads


def test_only_used_columns_are_read(spark):
    text = plan(catalog.queries()["service_usage"](spark, FOLDER))
    assert set(scan_lines(text, "ReadSchema")) == {
        "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>"
    }


def test_feed_is_not_shuffled_by_user_for_the_slices(spark):
    table = StarSchema(spark, FOLDER)
    no_messages = table.messages.where("false")
    text = plan(activity.attribute_totals(table.feed, no_messages), "simple")
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)", text)
    assert exchanges and not any("user_id" in keys for keys in exchanges)


def test_a_run_for_some_days_reads_only_their_files(spark, tmp_path):
    path = str(tmp_path / "by_day")
    table = StarSchema(spark, FOLDER)
    write_events(table.with_country(table.feed), FEED_ACTIONS, path)
    stored = read_events(spark, FEED_ACTIONS, path)
    assert stored.count() == table.feed.count()
    kpi = reports.feed_kpi(stored, P)
    assert kpi.collect() == reports.feed_kpi(table.feed, P).collect()
    pruned = [line for line in plan(kpi).splitlines() if "PartitionFilters" in line]
    assert pruned and all("2024-01-23" in line for line in pruned)


def test_an_overfull_country_lookup_is_split(spark, tmp_path):
    """A third of all events belong to one account; the join must not keep them together."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16kb",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    path = str(tmp_path)
    source = StarSchema(spark, "/root/testdata/sf0.01")
    hot = source.events.withColumn(
        "user_id", F.when(F.col("event_id") % 3 == 0, 7).otherwise(F.col("user_id"))
    )
    hot.repartition(8).write.parquet(f"{path}/events.parquet")
    for name in ("customer", "nation"):
        spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet").write.parquet(
            f"{path}/{name}.parquet"
        )
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        frame = catalog.queries()["feed_actions"](spark, path)
        rows = frame.collect()
        text = plan(frame, "simple")
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert len(rows) == hot.where("event_type in ('view', 'click', 'error')").count()
    assert "skew=true" in text


def test_weekly_cohorts_take_one_shuffle_by_user(spark):
    text = plan(catalog.queries()["feed_weekly_dynamics"](spark, FOLDER), "simple")
    by_user = re.findall(r"Exchange hashpartitioning\(user_id", text)
    assert len(by_user) == 1
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 3


def test_the_app_report_reads_each_event_table_once(spark, tmp_path, monkeypatch):
    table = StarSchema(spark, FOLDER)
    frames = {}
    for name, schema, events in (
        ("feed", FEED_ACTIONS, table.feed), ("messages", MESSAGE_ACTIONS, table.messages),
    ):
        write_events(table.with_country(events), schema, f"{tmp_path}/{name}")
        frames[name] = read_events(spark, schema, f"{tmp_path}/{name}")
    readers = {name: [] for name in frames}
    written = jobs._Run.store

    def store(self, name, frame):
        for table_name, found in readers.items():
            if any(f"/{table_name}/event_date=" in path for path in frame.inputFiles()):
                found.append(len(scan_lines(plan(frame), "ReadSchema")))
        return written(self, name, frame)

    monkeypatch.setattr(jobs._Run, "store", store)
    jobs.run_app_report(*frames.values(), P, f"{tmp_path}/reports")
    # One result set, the base, reads both tables, each by one scan.
    assert readers == {"feed": [2], "messages": [2]}


def test_stored_stream_slots_are_pruned_by_day(spark, tmp_path):
    from datetime import date, datetime

    from tidemark.streaming.alerts import slot_log, stored_slots
    from tidemark.streaming.slots import SLOT_METRICS

    day, period = date(2024, 1, 30), datetime(2024, 1, 30, 10, 15)
    row = spark.createDataFrame([(day, period, "10:15", 1, 1, 1, 0, 0.0, 1)], SLOT_METRICS)
    path = str(tmp_path / "slots")
    slot_log(spark, path).add(row, [day])
    frame = stored_slots(spark, path, date(2024, 1, 14))
    assert frame.count() == 1
    (filters,) = [line for line in plan(frame).splitlines() if "PartitionFilters" in line]
    assert "event_date" in filters and "2024-01-14" in filters


def test_both_message_directions_share_one_scan(spark):
    frame = catalog.queries()["messages_activity_daily"](spark, FOLDER)
    frame.collect()
    final = frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in final or final.count("FileScan") == 1
