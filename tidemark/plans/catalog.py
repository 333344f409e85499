"""Every operator as a query over one test-data folder.

Doubles are rounded to six places here, and only here, because the last bit
of a sum or an interpolation depends on the order of its terms.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import (
    activity,
    anomaly,
    cohorts,
    filters,
    reports,
    services,
    slices,
    user_days,
)
from tidemark.params import Params
from tidemark.plans import jobs
from tidemark.sources.derived import StarSchema, feed_rows, message_rows
from tidemark.sources.loads import load_sources
from tidemark.sources.scratch import shared_folder
from tidemark.sources.tables import (
    FEED_ACTIONS,
    MESSAGE_ACTIONS,
    append_events,
    read_events,
    stream_events,
)
from tidemark.streaming import alerts as stream_alerts
from tidemark.streaming import slots as stream_slots

# The test data ends on this day. Its users are not active enough for the
# default thresholds of the reports.
TEST_RUN = Params(
    as_of=date(2024, 1, 30),
    report_days=20,
    min_views=2,
    min_sent_exclusive=1,
    min_country_users=6,
)
# The factors and widths that a grid of back-tests compares.
TEST_FACTORS, TEST_WIDTHS = (1.5, 2.0, 3.0), (1, 3, 6)
# On that day, a run at this time finds its newest slot outside its band.
TEST_RUN_AT = datetime(2024, 1, 30, 16, 30)

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _rounded(frame: DataFrame) -> DataFrame:
    return frame.select(
        *[
            F.round(f.name, 6).alias(f.name) if f.dataType == T.DoubleType() else F.col(f.name)
            for f in frame.schema
        ]
    )


def _query(name: str) -> Callable[[Callable[[StarSchema], DataFrame]], None]:
    """Register a function of the star schema under ``name``."""

    def register(build: Callable[[StarSchema], DataFrame]) -> None:
        _QUERIES[name] = lambda spark, folder: _rounded(build(StarSchema(spark, folder)))

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


P = TEST_RUN


# Sources and date windows


@_query("feed_actions")
def _(t):
    return t.with_country(t.feed)


@_query("message_actions")
def _(t):
    return t.with_country(t.messages)


@_query("filter_yesterday")
def _(t):
    return filters.on_yesterday(t.feed, P).drop("account_id")


@_query("filter_last_7_days")
def _(t):
    return filters.in_kpi_days(t.feed, P).drop("account_id")


@_query("filter_last_30_days")
def _(t):
    return filters.in_report_days(t.feed, P).drop("account_id")


@_query("filter_reference_days")
def _(t):
    return filters.in_alert_days(t.messages, P).drop("account_id")


# Daily activity and its slices


@_query("feed_activity_daily")
def _(t):
    return activity.feed_activity(filters.on_yesterday(t.feed, P))


@_query("messages_sent_daily")
def _(t):
    return activity.messages_sent(filters.on_yesterday(t.messages, P))


@_query("messages_received_daily")
def _(t):
    return activity.messages_received(filters.on_yesterday(t.messages, P))


@_query("messages_activity_daily")
def _(t):
    return activity.messages_activity(filters.on_yesterday(t.messages, P))


def _yesterday(t: StarSchema) -> tuple[DataFrame, DataFrame]:
    return filters.on_yesterday(t.feed, P), filters.on_yesterday(t.messages, P)


@_query("user_activity_merged")
def _(t):
    return activity.user_activity(*_yesterday(t))


@_query("slice_gender")
def _(t):
    return slices.slice_by(activity.attribute_totals(*_yesterday(t)), "gender")


@_query("slice_os")
def _(t):
    return slices.slice_by(activity.attribute_totals(*_yesterday(t)), "os")


@_query("slice_age")
def _(t):
    return slices.slice_by(activity.attribute_totals(*_yesterday(t)), "age")


@_query("slice_metrics_daily")
def _(t):
    return jobs.daily_slices(t.feed, t.messages, P)


@_query("slice_metrics_backfill")
def _(t):
    return slices.slice_metrics(activity.attribute_totals(t.feed, t.messages))


@_query("slice_sink")
def _(t):
    target = shared_folder(t.spark, "slices")
    jobs.run_daily_slices(t.feed, t.messages, P, target)
    return slices.read_slices(t.spark, target)


# Reports


@_query("feed_kpi_7d")
def _(t):
    return reports.feed_kpi(t.feed, P)


@_query("feed_kpi_digest")
def _(t):
    return reports.feed_kpi_digest(reports.feed_kpi(t.feed, P))


@_query("feed_kpi_series")
def _(t):
    return reports.feed_kpi_series(reports.feed_kpi(t.feed, P))


def _dau_by_country(t: StarSchema) -> DataFrame:
    accounts = reports.audience_days(t.feed, t.messages, P, keys=("account_id",))
    return reports.dau_by_country(t.with_country(accounts))


@_query("dau_by_country")
def _(t):
    return _dau_by_country(t)


@_query("dau_by_country_major")
def _(t):
    return reports.dau_by_country_major(_dau_by_country(t), P)


@_query("avg_feed_usage")
def _(t):
    return reports.avg_feed_usage(t.feed, P)


@_query("avg_msg_usage")
def _(t):
    return reports.avg_message_usage(t.messages, P)


@_query("feed_dau_by_source")
def _(t):
    return reports.dau_by_source(t.feed, P)


@_query("msg_dau_by_source")
def _(t):
    return reports.dau_by_source(t.messages, P)


# Weekly cohorts


def _weekly(events: DataFrame) -> DataFrame:
    return cohorts.weekly_dynamics(cohorts.user_weeks(events))


@_query("feed_weekly_dynamics")
def _(t):
    return _weekly(t.feed)


@_query("msg_weekly_dynamics")
def _(t):
    return _weekly(t.messages)


@_query("first_seen_week")
def _(t):
    return cohorts.first_seen_week(t.feed)


@_query("weekly_stayed_compare")
def _(t):
    return cohorts.weekly_stayed_compare(_weekly(t.feed), _weekly(t.messages))


@_query("weekly_dynamics_series")
def _(t):
    return cohorts.weekly_dynamics_series(_weekly(t.feed), _weekly(t.messages))


# Overlap of the services


@_query("service_usage")
def _(t):
    return services.service_usage(services.presence(t.feed, t.messages)).orderBy("event_date")


@_query("service_usage_stack")
def _(t):
    usage = services.service_usage(services.presence(t.feed, t.messages))
    return services.service_usage_stack(usage)


@_query("feed_only_users")
def _(t):
    return services.feed_only_users(services.presence(t.feed, t.messages))


@_query("message_only_users")
def _(t):
    return services.message_only_users(services.presence(t.feed, t.messages))


@_query("both_service_users")
def _(t):
    return services.both_service_users(services.presence(t.feed, t.messages))


# Alerts


def _alert_slots(t: StarSchema) -> DataFrame:
    return jobs.alert_slots(t.feed, t.messages, P)


def _bands(t: StarSchema) -> DataFrame:
    return anomaly.iqr_bands(_alert_slots(t), anomaly.loaded_days(P.alert_days), P)


def _chart(t: StarSchema) -> DataFrame:
    return anomaly.chart_bands(_alert_slots(t), anomaly.loaded_days(P.alert_days), P)


@_query("slot_metrics_15m")
def _(t):
    return _alert_slots(t).orderBy("period")


@_query("slot_history")
def _(t):
    return anomaly.slot_history(_alert_slots(t), anomaly.loaded_days(P.alert_days), P)


@_query("iqr_bands")
def _(t):
    return _bands(t)


@_query("anomaly_flags")
def _(t):
    return anomaly.anomaly_flags(_bands(t))


@_query("band_backfill")
def _(t):
    return anomaly.band_backfill(_chart(t))


@_query("band_smoothing")
def _(t):
    return anomaly.band_smoothing(_chart(t), P)


@_query("alert_chart_series")
def _(t):
    return anomaly.alert_chart_series(_chart(t), P)


@_query("alert_messages")
def _(t):
    return anomaly.alert_messages(_bands(t))


@_query("alert_messages_replay")
def _(t):
    return anomaly.alert_messages(_bands(t), last_only=False)


@_query("anomaly_backtest")
def _(t):
    return anomaly.anomaly_backtest(anomaly.slot_metrics(t.feed, t.messages, P), P)


@_query("anomaly_backtest_grid")
def _(t):
    slots = anomaly.slot_metrics(t.feed, t.messages, P)
    return anomaly.backtest_grid(slots, P, TEST_FACTORS, TEST_WIDTHS)


# The same from rows kept between runs; the store is filled by an earlier run.


def _load(t: StarSchema, store: str, late: bool | None = None) -> None:
    """Load both event tables by day, as a production table is; of two loads one brings
    what comes a day late."""
    for events, schema, name in (
        (t.with_country(t.feed), FEED_ACTIONS, "feed"),
        (t.with_country(t.messages), MESSAGE_ACTIONS, "messages"),
    ):
        if late is not None:
            slow = (F.minute("time") % 5 == 3) & (F.to_date("time") < F.lit(P.as_of))
            events = events.where(slow if late else ~slow)
        append_events(events, schema, f"{store}/{name}")


def _loaded(
    t: StarSchema, store: str, days: list[date] | None = None
) -> tuple[tuple[DataFrame, DataFrame], dict[date, str] | None]:
    """Both tables, and what their days consist of."""
    paths = [f"{store}/feed", f"{store}/messages"]
    feed = read_events(t.spark, FEED_ACTIONS, paths[0], days=days)
    messages = read_events(t.spark, MESSAGE_ACTIONS, paths[1], days=days)
    return (feed, messages), load_sources(t.spark, paths, days)


@_query("slots_from_store")
def _(t):
    store = shared_folder(t.spark, "kept")
    _load(t, store)
    earlier = replace(P, as_of=P.day(2))
    for p in (earlier, P):
        events, sources = _loaded(t, store, p.alert_days)
        slots = jobs.kept_alert_slots(*events, p, store, sources=sources)
        if p is earlier:
            slots.write.format("noop").mode("append").save()
    return slots.orderBy("period")


@_query("weekly_from_store")
def _(t):
    store = shared_folder(t.spark, "kept")
    _load(t, store)
    events, sources = _loaded(t, store)
    earlier = replace(P, as_of=P.day(9))
    jobs.kept_user_days(*events, earlier, store, sources).write.format("noop").mode("append").save()
    base = user_days.of_feed(jobs.kept_user_days(*events, P, store, sources))
    return cohorts.weekly_dynamics(user_days.user_weeks(base))


@_query("weekly_from_seen")
def _(t):
    store = shared_folder(t.spark, "seen")
    for late, p in ((False, replace(P, as_of=P.day(9))), (True, P)):
        _load(t, store, late)
        (feed, _), _ = _loaded(t, store)
        sources = load_sources(t.spark, [f"{store}/feed"])
        weekly = jobs.seen_weekly_dynamics(feed, p, f"{store}/seen", sources, buckets=8)
    return weekly


@_query("alert_run")
def _(t):
    target = shared_folder(t.spark, "alert-run")
    for at in (TEST_RUN_AT, TEST_RUN_AT.replace(minute=45)):
        jobs.run_alerts(t.feed, t.messages, P, target, at=at)
    runs = t.spark.read.parquet(f"{target}/alert_messages")
    own = F.col("run").cast("int") == int(f"{TEST_RUN_AT:%H%M}")
    return runs.where(own).drop("as_of", "run")


# Streams, worked off up to the end of the data


def _slot_stream(t: StarSchema) -> DataFrame:
    feed = feed_rows(t.stream_of_events())
    # The receivers play no part in the slots, so their number does not matter.
    messages = message_rows(t.stream_of_events(), F.lit(1))
    return stream_slots.stream_slot_metrics(feed, messages, P)


@_query("stream_slot_metrics")
def _(t):
    folder = shared_folder(t.spark, "slot-stream")
    stream_slots.run_to_files(
        _slot_stream(t), f"{folder}/slots", f"{folder}/checkpoint"
    ).awaitTermination()
    return stream_slots.read_slots(t.spark, f"{folder}/slots")


@_query("stream_alerts")
def _(t):
    folder = shared_folder(t.spark, "alert-stream")
    stream_alerts.run_alerts(
        _slot_stream(t), f"{folder}/slots", f"{folder}/alerts", f"{folder}/checkpoint", P
    ).awaitTermination()
    return stream_alerts.read_alerts(t.spark, f"{folder}/alerts")


@_query("stream_alerts_late")
def _(t):
    folder = shared_folder(t.spark, "late-stream")
    _load(t, folder, late=False)
    streams = [
        stream_events(t.spark, schema, f"{folder}/{name}")
        for name, schema in (("feed", FEED_ACTIONS), ("messages", MESSAGE_ACTIONS))
    ]
    paths = f"{folder}/slots", f"{folder}/alerts"
    slots = stream_slots.stream_slot_metrics(*streams, P)
    stream_alerts.run_alerts(slots, *paths, f"{folder}/checkpoint", P).awaitTermination()
    _load(t, folder, late=True)
    events, sources = _loaded(t, folder)
    jobs.run_late_corrections(*events, P, *paths, f"{folder}/store", sources)
    return stream_alerts.read_alerts(t.spark, paths[1])
