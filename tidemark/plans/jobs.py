"""The scheduled jobs: each builds its results from the two event tables.

A scheduler calls these with the day to run for; alerts also take a time of the
day. Every job can be repeated and leaves the same rows behind, also for an
earlier day on later data: rows after ``as_of`` do not exist for a run.

A result that others are derived from is written first and read back, so the
events behind it are aggregated once and a lost executor does not bring them
back in. With a `store`, rows per day are kept between runs as well; see
`tidemark.plans.kept` for when a kept day is made again.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.calendar import ONE_DAY, on_days, runs, up_to
from tidemark.operators import activity, anomaly, cohorts, reports, services, slices, user_days
from tidemark.operators.filters import in_alert_days, on_yesterday
from tidemark.params import Params
from tidemark.plans import seen
from tidemark.plans.kept import KeptDays, Sources, day_sources
from tidemark.streaming import alerts as stream_alerts


# Days whose stored slots have been compared with their events need no more than a mark.
COMPARED = T.StructType([T.StructField("event_date", T.DateType())])


class _Run:
    """The result folder of one run: a folder per result set, a partition per run."""

    def __init__(self, p: Params, target: str, part: str = "") -> None:
        self._part = f"as_of={p.as_of}{part}"
        self._target = target

    def store(self, name: str, frame: DataFrame) -> DataFrame:
        path = f"{self._target}/{name}/{self._part}"
        frame.write.mode("overwrite").parquet(path)
        return frame.sparkSession.read.schema(frame.schema).parquet(path)


def daily_slices(feed: DataFrame, messages: DataFrame, p: Params) -> DataFrame:
    """Yesterday's activity by gender, os and age."""
    totals = activity.attribute_totals(on_yesterday(feed, p), on_yesterday(messages, p))
    return slices.slice_metrics(totals)


def run_daily_slices(feed: DataFrame, messages: DataFrame, p: Params, target: str) -> None:
    """Write yesterday's slices; a repeat replaces the day, also by no rows."""
    slices.write_slices(daily_slices(feed, messages, p), target, [p.yesterday])


def run_feed_report(feed: DataFrame, p: Params, target: str) -> None:
    """The feed's KPI with its digest and chart series."""
    run = _Run(p, target)
    kpi = run.store("feed_kpi", reports.feed_kpi(feed, p))
    run.store("feed_kpi_digest", reports.feed_kpi_digest(kpi))
    run.store("feed_kpi_series", reports.feed_kpi_series(kpi))


def kept_user_days(
    feed: DataFrame, messages: DataFrame, p: Params, store: str, sources: Sources | None = None
) -> DataFrame:
    """`user_days` of all days up to the run's, where past days are kept in `store`.

    `sources` tells what the days consist of, see `sources.loads.load_sources`;
    without it, the names of the tables' files do.
    """

    def make(days: Sequence[date]) -> DataFrame:
        return user_days.user_days(on_days(feed, runs(days)), on_days(messages, runs(days)))

    sources = sources or day_sources(feed, messages)
    if sources is None:
        return user_days.user_days(up_to(feed, p.as_of), up_to(messages, p.as_of))
    past = {day: source for day, source in sources.items() if day < p.as_of}
    kept = KeptDays(feed.sparkSession, f"{store}/user_days", user_days.USER_DAYS)
    return kept.rows(past, make).unionByName(make([p.as_of]))


def seen_weekly_dynamics(
    events: DataFrame, p: Params, store: str, sources: Sources, buckets: int = 64
) -> DataFrame:
    """`cohorts.weekly_dynamics` of a table up to the run's day, without its history.

    Only weeks whose events have changed are read; `store` keeps the users of each
    week and when each user was first seen. `sources` tells what the days of the
    table consist of.
    """

    def make(weeks: Sequence[date]) -> DataFrame:
        days = [week + i * ONE_DAY for week in weeks for i in range(7)]
        return cohorts.user_weeks(on_days(events, runs(day for day in days if day <= p.as_of)))

    kept = seen.SeenUsers(events.sparkSession, store, buckets)
    return seen.weekly_dynamics(*kept.update(seen.week_sources(sources, p.as_of), make))


def _usage_counts(
    base: DataFrame,
    feed: DataFrame,
    messages: DataFrame,
    p: Params,
    store: str | None,
    sources: Sources | None,
) -> DataFrame:
    """`services.usage_counts` of all days of the base, where past days are kept."""

    def make(days: Sequence[date]) -> DataFrame:
        own = base.where(F.col("event_date").isin(list(days)))
        return services.usage_counts(user_days.presence(own))

    sources = sources or day_sources(feed, messages) if store else None
    if sources is None:
        return services.usage_counts(user_days.presence(base))
    past = {day: source for day, source in sources.items() if day < p.as_of}
    kept = KeptDays(base.sparkSession, f"{store}/usage_days", services.USAGE_COUNTS)
    return kept.rows(past, make).unionByName(make([p.as_of]))


def run_app_report(
    feed: DataFrame,
    messages: DataFrame,
    p: Params,
    target: str,
    store: str | None = None,
    sources: Sources | None = None,
) -> None:
    """All result sets of the whole-app report.

    They follow from one base of a row per day and user, so each event table is
    read once; with a `store`, only days that are not kept are read at all.
    """
    run = _Run(p, target)
    if store:
        base = kept_user_days(feed, messages, p, store, sources)
    else:
        base = user_days.user_days(up_to(feed, p.as_of), up_to(messages, p.as_of))
        base = run.store("user_days", base)
    of_feed, of_messages = user_days.of_feed(base), user_days.of_messages(base)

    dau = run.store("dau_by_country", reports.dau_by_country(user_days.audience(base, p)))
    run.store("dau_by_country_major", reports.dau_by_country_major(dau, p))

    run.store("avg_feed_usage", user_days.avg_feed_usage(base, p))
    run.store("avg_msg_usage", user_days.avg_message_usage(base, p))
    run.store("feed_dau_by_source", user_days.dau_by_source(of_feed, p))
    run.store("msg_dau_by_source", user_days.dau_by_source(of_messages, p))

    feed_weekly = run.store(
        "feed_weekly_dynamics", cohorts.weekly_dynamics(user_days.user_weeks(of_feed))
    )
    message_weekly = run.store(
        "msg_weekly_dynamics", cohorts.weekly_dynamics(user_days.user_weeks(of_messages))
    )
    both = feed_weekly, message_weekly
    run.store("weekly_stayed_compare", cohorts.weekly_stayed_compare(*both))
    run.store("weekly_dynamics_series", cohorts.weekly_dynamics_series(*both))

    counts = _usage_counts(base, feed, messages, p, store, sources)
    usage = run.store("service_usage", services.usage_shares(counts))
    run.store("service_usage_stack", services.service_usage_stack(usage))


def alert_slots(
    feed: DataFrame, messages: DataFrame, p: Params, at: datetime | None = None
) -> DataFrame:
    """The slots an alert run looks at: six days of both tables, up to the time `at`."""
    loaded = [in_alert_days(_before(events, at), p) for events in (feed, messages)]
    return anomaly.slot_metrics(*loaded, p)


def kept_alert_slots(
    feed: DataFrame,
    messages: DataFrame,
    p: Params,
    store: str,
    at: datetime | None = None,
    sources: Sources | None = None,
) -> DataFrame:
    """`alert_slots`, where the days before the run's are kept in `store`.

    A run every 15 minutes then reads its own day, and again those days whose
    events have changed.
    """

    sources = sources or day_sources(feed, messages)
    if sources is None:
        return alert_slots(feed, messages, p, at)
    today = [(p.as_of, p.as_of)]
    own = anomaly.slot_metrics(
        on_days(_before(feed, at), today), on_days(_before(messages, at), today), p
    )
    past = {
        day: source
        for day, source in sources.items()
        if day in p.alert_days and day != p.as_of
    }
    return _kept_slots(feed, messages, p, store, past).unionByName(own)


def _kept_slots(
    feed: DataFrame, messages: DataFrame, p: Params, store: str, sources: Sources
) -> DataFrame:
    """The slots of whole days, kept in `store`."""

    def make(days: Sequence[date]) -> DataFrame:
        ranges = runs(days)
        return anomaly.slot_metrics(on_days(feed, ranges), on_days(messages, ranges), p)

    schema = anomaly.slot_metrics(feed, messages, p).schema
    kept = KeptDays(feed.sparkSession, f"{store}/slots_{p.slot_minutes}m", schema)
    return kept.rows(sources, make)


def _before(events: DataFrame, at: datetime | None) -> DataFrame:
    if at is None:
        return events
    return events.where(F.col("time") < F.lit(str(at)).cast("timestamp_ntz"))


def run_alerts(
    feed: DataFrame,
    messages: DataFrame,
    p: Params,
    target: str,
    store: str | None = None,
    at: datetime | None = None,
    sources: Sources | None = None,
) -> None:
    """Messages for the newest slot and the charts of the metrics they name.

    `at` is the time of the run on its day; events from then on do not exist for
    it. Results are kept by run, so a later run of the day leaves them alone and
    a repeat of the run replaces its own. Without a time the run sees all of
    its day.
    """
    if at is not None and at.date() != p.as_of:
        raise ValueError("the time of a run is on its day")
    run = _Run(p, target, f"/run={at:%H%M}" if at else "/run=2400")
    found = (
        kept_alert_slots(feed, messages, p, store, at, sources)
        if store
        else alert_slots(feed, messages, p, at)
    )
    slots = run.store("slot_metrics", found)
    days = anomaly.loaded_days(p.alert_days)
    alerts = run.store(
        "alert_messages", anomaly.alert_messages(anomaly.iqr_bands(slots, days, p))
    )
    chart = anomaly.alert_chart_series(anomaly.chart_bands(slots, days, p), p)
    run.store(
        "alert_chart_series", chart.join(alerts.select("metric"), "metric", "left_semi")
    )


def run_late_corrections(
    feed: DataFrame,
    messages: DataFrame,
    p: Params,
    history: str,
    alerts: str,
    store: str,
    sources: Sources | None = None,
) -> list[date]:
    """Take rows that came too late for the alert stream into its slots and alerts.

    Of the days up to the run's, those are made again whose events are not the ones
    they were last compared with; the newest day of the history, whose slots are
    still closing, always is. Afterwards the stored slots and alerts are those of
    all events. Returns the days with changes. To be run between two micro-batches.
    """
    spark = feed.sparkSession
    newest = stream_alerts.stored_slots(spark, history).agg(F.max("event_date")).first()[0]
    if newest is None:
        return []
    sources = sources or day_sources(feed, messages)
    if sources is None:
        raise ValueError("corrections need event tables by day")
    past = {day: source for day, source in sources.items() if day < newest and day <= p.as_of}
    compared = KeptDays(spark, f"{store}/compared_slots_{p.slot_minutes}m", COMPARED)
    todo = {day: past[day] for day in compared.missing(past)}
    found = _kept_slots(feed, messages, p, store, todo)
    days = list(todo)
    if newest in sources and newest <= p.as_of:
        own = [(newest, newest)]
        found = found.unionByName(
            anomaly.slot_metrics(on_days(feed, own), on_days(messages, own), p)
        )
        days.append(newest)
    changed = stream_alerts.correct_slots(found, days, history, alerts, p)
    if todo:
        compared.keep(todo, spark.createDataFrame([], COMPARED))
    return changed
