from __future__ import annotations

import random
from dataclasses import replace
from datetime import date, datetime, timedelta
from types import SimpleNamespace

import pytest

from tests.rows import dicts, feed, messages
from tidemark.__main__ import JOBS, main
from tidemark.operators import anomaly, reports, slices
from tidemark.params import Params
from tidemark.plans import catalog, jobs
from tidemark.sources.scratch import CHECKPOINT_SETTING, shared_folder
from tidemark.sources.tables import (
    FEED_ACTIONS,
    MESSAGE_ACTIONS,
    append_events,
    read_events,
    write_events,
)

P = Params(as_of=date(2024, 1, 30))
FEED_ROWS = [
    (1, "2024-01-29 10:00:00.5", "view", None, 23, None),
    (2, "2024-01-29 23:59:59", "like", 1, 40, "iOS"),
]


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_event_tables_from_files(spark, tmp_path, fmt):
    f = feed(spark, FEED_ROWS)
    path = str(tmp_path / fmt)
    f.write.format(fmt).option("header", "true").save(path)
    read = read_events(spark, FEED_ACTIONS, path, fmt, header="true")
    assert read.schema.names == FEED_ACTIONS.names
    assert [x.dataType for x in read.schema] == [x.dataType for x in FEED_ACTIONS]
    assert dicts(read, "user_id") == dicts(f, "user_id")


def test_day_partitions_stay_visible(spark, tmp_path):
    path = str(tmp_path / "by_day")
    m = messages(spark, [(1, 2, "2024-01-29 10:00")])
    m.selectExpr("*", "to_date(time) as event_date").write.partitionBy("event_date").parquet(path)
    read = read_events(spark, MESSAGE_ACTIONS, path)
    assert read.columns == [*MESSAGE_ACTIONS.names, "event_date"]


def test_a_missing_column_is_named(spark, tmp_path):
    path = str(tmp_path / "short")
    feed(spark, FEED_ROWS).drop("os").write.parquet(path)
    with pytest.raises(ValueError, match="os"):
        read_events(spark, FEED_ACTIONS, path)


def test_written_data_goes_to_the_shared_folder(spark):
    root = spark.conf.get(CHECKPOINT_SETTING)
    assert shared_folder(spark, "x").startswith(f"{root}/x-")
    sink = catalog.queries()["slice_sink"](spark, "/root/testdata/sf0.001")
    assert all(root in path for path in sink.inputFiles())


def test_a_cluster_must_name_its_shared_folder():
    cluster = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: default),
        sparkContext=SimpleNamespace(master="yarn"),
    )
    with pytest.raises(ValueError, match=CHECKPOINT_SETTING):
        shared_folder(cluster, "x")


REPORT_SETS = [
    "dau_by_country", "avg_feed_usage", "avg_msg_usage", "feed_dau_by_source",
    "msg_dau_by_source", "feed_weekly_dynamics", "msg_weekly_dynamics", "weekly_stayed_compare",
    "weekly_dynamics_series", "service_usage", "service_usage_stack",
]
BUSY = replace(P, min_views=2, min_sent_exclusive=1)


class Tables:
    """Both event tables by day, from rows of (user, time), loaded in several steps."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        self.loads = 0

    def add(self, rows):
        views = feed(self.spark, [(u, t, "view") for u, t in rows if u % 4])
        sent = messages(self.spark, [(u, u + 1, t) for u, t in rows if u % 3])
        append_events(views, FEED_ACTIONS, f"{self.folder}/feed")
        append_events(sent, MESSAGE_ACTIONS, f"{self.folder}/messages")

    def read(self):
        return (
            read_events(self.spark, FEED_ACTIONS, f"{self.folder}/feed"),
            read_events(self.spark, MESSAGE_ACTIONS, f"{self.folder}/messages"),
        )

    def report(self, p, store):
        """All result sets of a report run, through the store or from the events."""
        self.loads += 1
        target = f"{self.folder}/reports-{self.loads}"
        jobs.run_app_report(*self.read(), p, target, f"{self.folder}/store" if store else None)
        return {n: dicts(self.spark.read.parquet(f"{target}/{n}")) for n in REPORT_SETS}


def some_rows(first, last, seed):
    pick = random.Random(seed)
    return [
        (pick.randrange(1, 25), f"2024-01-{d:02d} {pick.randrange(24):02d}:{pick.randrange(60):02d}")
        for d in range(first, last + 1)
        for _ in range(20)
    ]


def test_a_store_is_never_short(spark, tmp_path):
    """Empty, after missed days, after late rows, and for an old day: as from the events."""
    tables = Tables(spark, tmp_path)
    tables.add(some_rows(2, 14, 1))
    day = lambda d: replace(BUSY, as_of=date(2024, 1, d))
    assert tables.report(day(14), True) == tables.report(day(14), False)
    tables.add(some_rows(14, 25, 2))
    assert tables.report(day(25), True) == tables.report(day(25), False)
    tables.add([(30, "2024-01-04 10:00"), (31, "2024-01-18 10:00")])
    late = tables.report(day(25), True)
    assert late == tables.report(day(25), False)
    old = tables.report(day(10), True)
    assert old == tables.report(day(10), False)
    assert max(r["week"] for r in old["feed_weekly_dynamics"]) == date(2024, 1, 7)
    assert max(r["event_date"] for r in old["service_usage"]) <= date(2024, 1, 10)
    assert tables.report(day(25), True) == late


def test_a_report_for_an_earlier_day_does_not_see_later_data(spark, tmp_path):
    full, cut = Tables(spark, tmp_path / "full"), Tables(spark, tmp_path / "cut")
    rows = some_rows(2, 28, 3)
    full.add(rows)
    cut.add([r for r in rows if r[1] < "2024-01-11"])
    p = replace(BUSY, as_of=date(2024, 1, 10))
    assert full.report(p, False) == cut.report(p, False)


def test_kept_slots_are_those_of_the_events(spark, tmp_path):
    tables, store = Tables(spark, tmp_path), f"{tmp_path}/store"
    tables.add(some_rows(12, 28, 4))

    def same(p, at=None):
        found = jobs.kept_alert_slots(*tables.read(), p, store, at)
        expected = jobs.alert_slots(*tables.read(), p, at)
        rows = dicts(found)
        assert rows == dicts(expected)
        return rows

    day = lambda d: replace(P, as_of=date(2024, 1, d))
    assert same(day(28))
    tables.add(some_rows(30, 30, 5))
    assert same(P)
    before = same(P, datetime(2024, 1, 30, 12))
    assert before and all(r["period"] < datetime(2024, 1, 30, 12) for r in before)
    when = next(r["period"] for r in same(P) if r["event_date"] == date(2024, 1, 23))
    tables.add([(41, str(when))])
    assert same(P) != before
    assert same(day(20))
    assert same(P)


def test_tables_without_days_are_read_in_full(spark, tmp_path):
    f = feed(spark, [(1, "2024-01-29 10:00", "view"), (2, "2024-01-31 10:00", "view")])
    m = messages(spark, [(1, 2, "2024-01-29 10:00")])
    for store in (None, f"{tmp_path}/store"):
        target = f"{tmp_path}/{store is None}"
        jobs.run_app_report(f, m, P, target, store)
        weekly = spark.read.parquet(f"{target}/feed_weekly_dynamics")
        assert [(r.week, r.new) for r in weekly.collect()] == [(date(2024, 1, 28), 1)]


def test_reports_are_written_per_run_day(spark, tmp_path):
    f = feed(spark, FEED_ROWS)
    m = messages(spark, [(1, 2, "2024-01-29 10:00"), (3, 1, "2024-01-29 11:00")])
    target = str(tmp_path / "reports")
    for _ in range(2):
        jobs.run_feed_report(f, P, target)
        jobs.run_app_report(f, m, P, target)

    def stored(name):
        return spark.read.parquet(f"{target}/{name}")

    digest = stored("feed_kpi_digest").first()
    assert digest.as_of == P.as_of
    assert digest.message.splitlines()[1:] == [
        "        DAU = 2 users",
        "        Views = 1",
        "        Likes = 1",
        "        CTR = 100.00%",
    ]
    assert stored("feed_kpi_series").count() == 4
    assert stored("dau_by_country").count() == 2
    assert stored("dau_by_country_major").count() == 0
    assert stored("feed_dau_by_source").count() == 1
    assert stored("weekly_dynamics_series").count() == 6
    assert stored("service_usage_stack").first().message_only_top == 1


def test_an_alert_run_leaves_messages_and_the_charts_they_name(spark, tmp_path):
    target = str(tmp_path / "alerts")
    clock = [f"10:{minute:02d}" for minute in (0, 15, 30, 45)] + ["11:00"]
    f = feed(
        spark,
        [(u, f"2024-01-30 {t}", "view") for t in clock for u in range(20 if t > "11" else 2)],
    )
    m = messages(spark, [(1, 2, f"2024-01-30 {t}") for t in clock])
    for _ in range(2):
        jobs.run_alerts(f, m, P, target)
    alerts = spark.read.parquet(f"{target}/alert_messages")
    assert {(r.metric, r.value) for r in alerts.collect()} == {("Views", 20), ("Feed_users", 20)}
    chart = spark.read.parquet(f"{target}/alert_chart_series")
    assert dicts(chart.groupBy("metric").count()) == [
        {"metric": "Feed_users", "count": 5},
        {"metric": "Views", "count": 5},
    ]


def test_every_alert_run_of_a_day_is_kept(spark, tmp_path):
    target = str(tmp_path / "alerts")
    clock = [f"{h}:{m:02d}" for h in (10, 11, 12) for m in (0, 15, 30, 45)]
    busy = {"11:00": 20, "11:45": 50}
    f = feed(
        spark, [(u, f"2024-01-30 {t}", "view") for t in clock for u in range(busy.get(t, 2))]
    )
    m = messages(spark, [(1, 2, f"2024-01-30 {t}") for t in clock])

    def run(hour, minute):
        jobs.run_alerts(f, m, P, target, at=datetime(2024, 1, 30, hour, minute))
        alerts = spark.read.parquet(f"{target}/alert_messages")
        return dicts(alerts.select("run", "metric", "value"))

    first = run(11, 15)
    assert {(r["metric"], r["value"]) for r in first} == {("Views", 20), ("Feed_users", 20)}
    both = run(12, 0)
    assert [r for r in both if r["run"] == first[0]["run"]] == first
    assert {r["value"] for r in both} == {20, 50}
    assert run(11, 15) == both
    assert run(11, 30) == both
    with pytest.raises(ValueError):
        jobs.run_alerts(f, m, P, target, at=datetime(2024, 1, 29, 11))


def test_late_rows_join_their_day(spark, tmp_path):
    path = str(tmp_path / "feed")
    write_events(feed(spark, FEED_ROWS), FEED_ACTIONS, path)
    append_events(feed(spark, [(3, "2024-01-29 11:00", "view")]), FEED_ACTIONS, path)
    assert read_events(spark, FEED_ACTIONS, path).count() == 3
    write_events(feed(spark, FEED_ROWS), FEED_ACTIONS, path)
    assert read_events(spark, FEED_ACTIONS, path).count() == 2


def test_a_day_that_became_empty_loses_its_slices(spark, tmp_path):
    path = str(tmp_path / "slices")
    f, m = feed(spark, FEED_ROWS), messages(spark, [(1, 2, "2024-01-29 10:00")])
    jobs.run_daily_slices(f, m, P, path)
    assert slices.read_slices(spark, path).count() == 6
    jobs.run_daily_slices(f.limit(0), m.limit(0), P, path)
    assert slices.read_slices(spark, path).count() == 0
    jobs.run_daily_slices(f, m, P, path)
    assert slices.read_slices(spark, path).count() == 6


@pytest.mark.parametrize(
    ("slots", "value", "percent"),
    [
        # views, likes of the slot before the compared one, the compared, the reported, the newest
        ([(4, 2), (4, 2), (0, 3), (4, 40)], "inf", "inf"),
        ([(4, 2), (0, 3), (4, 2), (4, 40)], "0.50", "100.00"),
        ([(4, 2), (0, 3), (0, 3), (4, 40)], "inf", "nan"),
        ([(4, 2), (0, 0), (0, 3), (4, 40)], "inf", "nan"),
    ],
)
def test_likes_without_views_read_inf_in_alerts(spark, slots, value, percent):
    rows = []
    for i, (views, likes) in enumerate(slots):
        period = datetime(2024, 1, 30, 10) + timedelta(minutes=15 * i)
        ctr = likes / views if views else None
        for metric, number in (("Views", views), ("Likes", likes), ("CTR", ctr)):
            newest = metric == "CTR" and i == len(slots) - 1
            rows.append((period, metric, None if number is None else float(number),
                         0.0 if newest else None, 1.0 if newest else None))
    bands = spark.createDataFrame(
        rows, "period timestamp_ntz, metric string, value double, low double, up double"
    )
    (alert,) = anomaly.alert_messages(bands, last_only=False).collect()
    assert f"значение {value}." in alert.message and f"более {percent}%" in alert.message


def test_likes_without_views_read_inf_in_the_digest(spark):
    rows = [(1, "2024-01-29 10:00", "like")]
    digest = reports.feed_kpi_digest(reports.feed_kpi(feed(spark, rows), P)).first()
    assert digest.ctr is None and digest.message.endswith("CTR = inf%")


def test_jobs_from_the_command_line(spark, tmp_path):
    paths = {name: str(tmp_path / name) for name in ("feed", "messages", "target", "store")}
    feed(spark, FEED_ROWS).write.parquet(paths["feed"])
    messages(spark, [(1, 2, "2024-01-29 10:00")]).write.parquet(paths["messages"])
    for job in JOBS:
        if job.endswith("stream"):
            continue
        arguments = [f"--{name}={path}" for name, path in paths.items()]
        main([job, "--as-of=2024-01-30", *arguments])
    written = slices.read_slices(spark, f"{paths['target']}/slice_metrics_daily")
    assert written.count() == 6
    assert spark.read.parquet(f"{paths['target']}/feed_weekly_dynamics").first().new == 2
    assert spark.read.parquet(f"{paths['target']}/anomaly_backtest").count() > 0
