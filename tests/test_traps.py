"""One case per behaviour that is easy to get wrong."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.rows import dicts, feed, messages
from tidemark.functions.calendar import week_start
from tidemark.operators import activity, anomaly, cohorts, filters, reports, services, slices
from tidemark.params import Params
from tidemark.plans import jobs

P = Params(as_of=date(2024, 1, 30))
DAY = "2024-01-29"


def _slots(spark, rows):
    """Slot rows of (time, value): ``value`` views and half as many likes."""
    data = [
        (datetime.fromisoformat(t).date(), datetime.fromisoformat(t), 1, 1, v, 0, 0.0, 1)
        for t, v in rows
    ]
    schema = (
        "event_date date, period timestamp_ntz, mes_users bigint, sent_messages bigint,"
        " views double, likes bigint, ctr double, feed_users bigint"
    )
    return spark.createDataFrame(data, schema).withColumn("hm", F.date_format("period", "HH:mm"))


def _series(start, values, minutes=15):
    first = datetime.fromisoformat(start)
    return [
        ((first + timedelta(minutes=minutes * i)).isoformat(), v) for i, v in enumerate(values)
    ]


def _views(frame):
    return {r["period"]: r for r in dicts(frame.where("metric = 'Views'"), "period")}


def test_weeks_start_on_sunday(spark):
    days = spark.createDataFrame([(date(2024, 1, 6),), (date(2024, 1, 7),)], "d date")
    weeks = {r.d: r.w for r in days.select("d", week_start(F.col("d")).alias("w")).collect()}
    assert weeks == {
        date(2024, 1, 6): date(2023, 12, 31),
        date(2024, 1, 7): date(2024, 1, 7),
    }


def test_gap_week_counts_zero(spark):
    f = feed(spark, [(1, "2024-01-02 10:00", "view"), (1, "2024-01-16 10:00", "view")])
    rows = dicts(cohorts.weekly_dynamics(cohorts.user_weeks(f)), "week")
    assert [r["week"] for r in rows] == [date(2023, 12, 31), date(2024, 1, 14)]
    assert rows[0] == {
        "week": date(2023, 12, 31), "retained": 0, "new": 1, "gone": 0, "stayed": 0.0,
    }
    assert rows[1] == {
        "week": date(2024, 1, 14), "retained": 1, "new": 0, "gone": 1, "stayed": 0.0,
    }


def test_returning_users_count_as_retained(spark):
    f = feed(
        spark,
        [
            (1, "2024-01-02 10:00", "view"),
            (2, "2024-01-09 10:00", "view"),
            (1, "2024-01-16 10:00", "view"),
        ],
    )
    last = dicts(cohorts.weekly_dynamics(cohorts.user_weeks(f)), "week")[-1]
    assert (last["retained"], last["gone"], last["stayed"]) == (1, 0, 100.0)


def test_undefined_ratio_is_null(spark):
    f = feed(spark, [(1, f"{DAY} 10:00", "like")])
    row = reports.feed_kpi(f, P).first()
    assert (row.views, row.likes, row.ctr) == (0, 1, None)
    assert "CTR = inf%" in reports.feed_kpi_digest(reports.feed_kpi(f, P)).first().message


def test_ctr_is_percent_in_report_and_fraction_in_alerts(spark):
    rows = [(u, f"{DAY} 10:01", "view") for u in range(10)]
    rows += [(u, f"{DAY} 10:02", "like") for u in range(2)]
    f, m = feed(spark, rows), messages(spark, [(1, 2, f"{DAY} 10:03")])
    assert reports.feed_kpi(f, P).first().ctr == pytest.approx(20.0)
    assert jobs.alert_slots(f, m, P).first().ctr == pytest.approx(0.2)


def test_date_windows(spark):
    days = {back: P.day(back) for back in (0, 1, 7, 8, 14, 15, 16, 30, 31)}
    f = feed(spark, [(back, f"{d} 00:00", "view") for back, d in days.items()])

    def kept(frame):
        return {r.user_id for r in frame.collect()}

    assert kept(filters.on_yesterday(f, P)) == {1}
    assert kept(filters.in_kpi_days(f, P)) == {1, 7}
    assert kept(filters.in_report_days(f, P)) == set(days) - {31}
    assert kept(filters.in_alert_days(f, P)) == {0, 1, 7, 8, 14, 15}


def test_last_instant_of_a_day_belongs_to_it(spark):
    f = feed(spark, [(1, f"{DAY} 23:59:59.999999", "view"), (2, "2024-01-30 00:00", "view")])
    assert [r.user_id for r in filters.on_yesterday(f, P).collect()] == [1]


def test_distinct_users(spark):
    f = feed(spark, [(1, f"{DAY} 10:00", "view")] * 3)
    assert reports.feed_kpi(f, P).first().dau == 1


def test_only_users_who_send_and_receive_have_messages(spark):
    m = messages(spark, [(1, 2, f"{DAY} 10:00")])
    assert activity.messages_activity(m).count() == 0


def test_received_counts_repeat_per_attribute_set(spark):
    m = messages(
        spark,
        [
            (1, 5, f"{DAY} 10:00", 0, 20, "iOS"),
            (1, 6, f"{DAY} 11:00", 0, 20, "Android"),
            (5, 1, f"{DAY} 12:00"),
        ],
    )
    mine = activity.messages_activity(m).where("user_id = 1")
    assert mine.agg(F.sum("messages_received")).first()[0] == 2


def test_received_counts_stay_on_their_day(spark):
    m = messages(spark, [(1, 2, f"{DAY} 10:00"), (2, 1, "2024-01-28 10:00")])
    assert activity.messages_activity(m).count() == 0


def test_missing_attributes_match_and_read_zero(spark):
    f = feed(spark, [(1, f"{DAY} 10:00", "view", None, 23, None)])
    m = messages(
        spark,
        [(1, 2, f"{DAY} 10:00", None, 23, None), (2, 1, f"{DAY} 10:00", 1, None, "iOS")],
    )
    merged = dicts(activity.user_activity(f, m), "user_id")
    assert len(merged) == 2
    assert (merged[0]["gender"], merged[0]["os"], merged[0]["views"]) == (0, "0", 1)
    assert merged[0]["messages_sent"] == 1
    totals = activity.attribute_totals(f, m)
    values = {(r.dimension, r.dimension_value) for r in slices.slice_metrics(totals).collect()}
    assert values == {
        ("gender", "Female"), ("gender", "Male"), ("os", "0"), ("os", "iOS"),
        ("age", "23"), ("age", "0"),
    }


def test_unknown_gender_code_is_kept(spark):
    f = feed(spark, [(1, f"{DAY} 10:00", "view", 2)])
    m = messages(spark, [])
    row = slices.slice_by(activity.attribute_totals(f, m), "gender").first()
    assert row.dimension_value == "2"


def test_slices_add_up_distinct_people_per_user(spark):
    m = messages(
        spark,
        [(1, 3, f"{DAY} 10:00"), (2, 3, f"{DAY} 10:00"), (3, 1, f"{DAY} 10:00"),
         (3, 2, f"{DAY} 10:00", 1)],
    )
    totals = activity.attribute_totals(feed(spark, []), m)
    female = slices.slice_by(totals, "gender").where("dimension_value = 'Female'").first()
    assert female.users_sent == 3  # 1 -> 3, 2 -> 3, 3 -> 1
    assert female.messages_received == 4  # 1 and 2 one each, 3 two


def test_slices_of_merged_users_and_of_totals_agree(spark):
    f = feed(spark, [(u, f"{DAY} 10:00", "view", u % 2, u % 3, "iOS") for u in range(9)])
    m = messages(
        spark,
        [(u, (u * 5 + 1) % 9, f"{DAY} 11:00", u % 2, u % 3, "iOS") for u in range(9)] * 2,
    )
    direct = slices.slice_metrics(activity.attribute_totals(f, m))
    merged = activity.user_activity(f, m)
    for d in slices.DIMENSIONS:
        assert dicts(slices.slice_by(merged, d)) == dicts(direct.where(F.col("dimension") == d))
    sums = {
        tuple(r[m] for m in activity.METRICS)
        for r in direct.groupBy("dimension").agg(
            *[F.sum(m).alias(m) for m in activity.METRICS]
        ).collect()
    }
    assert len(sums) == 1


def test_day_without_common_users_is_left_out(spark):
    f = feed(spark, [(1, f"{DAY} 10:00", "view"), (1, "2024-01-28 10:00", "view"),
                     (2, "2024-01-28 10:00", "view")])
    m = messages(spark, [(2, 1, f"{DAY} 10:00"), (2, 1, "2024-01-28 10:00"),
                         (3, 1, "2024-01-28 10:00")])
    usage = dicts(services.service_usage(services.presence(f, m)))
    assert [r["event_date"] for r in usage] == [date(2024, 1, 28)]
    row = usage[0]
    assert row["all_users"] == 3
    shares = ("message_only_share", "feed_only_share", "both_share")
    assert sum(row[share] for share in shares) == pytest.approx(1)


def test_service_groups_partition_the_day(spark):
    f = feed(spark, [(u, f"{DAY} 10:00", "view") for u in (1, 2, 3)])
    m = messages(spark, [(u, 1, f"{DAY} 10:00") for u in (3, 4)])
    users = services.presence(f, m)
    assert services.feed_only_users(users).first().feed_only_users == 2
    assert services.message_only_users(users).first().message_only_users == 1
    assert services.both_service_users(users).first().both_service_users == 1


def test_slot_of_one_service_is_left_out(spark):
    f = feed(spark, [(1, f"{DAY} 10:00", "view"), (1, f"{DAY} 10:15", "view")])
    m = messages(spark, [(1, 2, f"{DAY} 10:14:59")])
    assert [r.hm for r in jobs.alert_slots(f, m, P).collect()] == ["10:00"]


def test_neighbourhood_wraps_midnight(spark):
    rows = _series("2024-01-29 00:00", [1.0] * 96) + _series("2024-01-30 00:00", [1.0] * 96)
    history = anomaly.slot_history(_slots(spark, rows), anomaly.loaded_days(P.alert_days), P)
    pairs = history.where("metric = 'Views'").collect()

    def clocks(target):
        when = datetime.fromisoformat(target)
        return sorted(r.history_period.strftime("%d %H:%M") for r in pairs if r.period == when)

    assert clocks("2024-01-30 00:00") == [
        "29 00:00", "29 00:15", "29 00:30", "29 00:45", "29 23:15", "29 23:30", "29 23:45",
    ]
    assert clocks("2024-01-30 23:45") == sorted(
        ["29 00:00", "29 00:15", "29 00:30", "29 23:00", "29 23:15", "29 23:30", "29 23:45"]
        + ["30 00:00", "30 00:15", "30 00:30", "30 23:00", "30 23:15", "30 23:30"]
    )


def test_quartiles_interpolate_and_leave_out_the_slot_itself(spark):
    days = ["2024-01-15", "2024-01-16", "2024-01-22", "2024-01-23"]
    values = [3.0, 1.0, 7.0, 10.0, 2.0, 9.0, 4.0, 4.0]
    rows = []
    for i, day in enumerate(days):
        rows += _series(f"{day} 10:00", values[2 * i : 2 * i + 2])
    rows.append(("2024-01-29 10:00", 8.0))
    band = _views(anomaly.iqr_bands(_slots(spark, rows), anomaly.loaded_days(P.alert_days), P))
    last = band[datetime(2024, 1, 29, 10)]
    assert (last["q25"], last["q75"], last["low"], last["up"]) == (2.75, 7.5, -6.75, 17.0)


def test_undefined_history_gives_no_band(spark):
    rows = _series("2024-01-29 10:00", [1.0, None, 100.0])
    bands = anomaly.iqr_bands(_slots(spark, rows), anomaly.loaded_days(P.alert_days), P)
    views = _views(bands)
    assert views[datetime(2024, 1, 29, 10, 0)]["up"] is None  # no history
    assert views[datetime(2024, 1, 29, 10, 15)]["up"] == 1.0
    assert views[datetime(2024, 1, 29, 10, 30)]["up"] is None  # undefined history
    flags = anomaly.anomaly_flags(bands).where("metric = 'Views'").first()
    assert flags.is_anomaly is False


def test_message_reports_the_slots_before_the_flagged_one(spark):
    rows = _series("2024-01-29 10:00", [100.0, 100.0, 100.0, 150.0, 900.0])
    bands = anomaly.iqr_bands(_slots(spark, rows), anomaly.loaded_days(P.alert_days), P)
    message = anomaly.alert_messages(bands).collect()
    assert [m.metric for m in message] == ["Views"]
    assert message[0].value == 900
    assert message[0].reported_value == 150
    assert "150.00." in message[0].message and "50.00%" in message[0].message


def test_message_when_compared_to_zero(spark):
    rows = _series("2024-01-29 10:00", [1.0, 1.0, 1.0, 0.0, 2.0, 900.0])
    bands = anomaly.iqr_bands(_slots(spark, rows), anomaly.loaded_days(P.alert_days), P)
    message = anomaly.alert_messages(bands).first()
    assert message.deviation is None and "inf%" in message.message


def test_backfill_centres_on_the_next_slot(spark):
    rows = _series("2024-01-29 08:00", [float(v * v % 17) for v in range(12)])
    chart = anomaly.chart_bands(_slots(spark, rows), anomaly.loaded_days(P.alert_days), P)
    raw = _views(anomaly.band_backfill(chart))
    # Centre 09:00 reaches back to 08:15; the newest of these, 08:45, is the target.
    target = raw[datetime(2024, 1, 29, 8, 45)]
    assert target["centre_lead"] == 1
    assert (target["q25"], target["q75"]) == (1.75, 3.25)  # of 1 and 4
    assert raw[datetime(2024, 1, 29, 10, 45)]["centre_lead"] == 0


def test_backfill_oldest_centre_wins_a_shared_target(spark):
    rows = [
        ("2024-01-29 10:00", 1.0),
        ("2024-01-29 10:15", 2.0),
        ("2024-01-29 12:00", 3.0),
        ("2024-01-30 10:00", 4.0),
    ]
    rows += [("2024-01-23 10:00", 7.0), ("2024-01-23 10:15", 9.0)]
    chart = anomaly.chart_bands(_slots(spark, rows), anomaly.loaded_days(P.alert_days), P)
    raw = _views(anomaly.band_backfill(chart))
    # Nothing lies within three slots of 12:00, and 01-30 10:00 looks back to 10:15.
    assert raw[datetime(2024, 1, 29, 10, 15)]["centre_lead"] == 95
    assert datetime(2024, 1, 29, 12, 0) not in raw
    assert raw[datetime(2024, 1, 29, 10, 0)]["centre_lead"] == 1
    rows.append(("2024-01-30 10:15", 5.0))
    rows.append(("2024-01-30 11:00", 6.0))
    chart = anomaly.chart_bands(_slots(spark, rows), anomaly.loaded_days(P.alert_days), P)
    raw = _views(anomaly.band_backfill(chart))
    assert raw[datetime(2024, 1, 30, 10, 15)]["centre_lead"] == 3


def test_chart_rows_are_bounded(spark):
    rows = _series("2024-01-29 00:00", [float(i % 7) for i in range(96 + 60)])
    slots = _slots(spark, rows)
    chart = anomaly.chart_bands(slots, anomaly.loaded_days(P.alert_days), P)
    assert anomaly.band_backfill(chart).where("metric = 'Views'").count() == 102
    assert anomaly.band_smoothing(chart, P).where("metric = 'Views'").count() == 102
    series = anomaly.alert_chart_series(chart, P).where("metric = 'CTR'")
    assert series.count() == 96
    assert {r.title for r in series.collect()} == {"Ctr"}


def test_smoothing_is_partial_at_the_edges(spark):
    bands = spark.createDataFrame(
        [("CTR", i, float(i), float(i)) for i in range(1, 7)],
        "metric string, period int, low double, up double",
    )
    smooth = [r.low for r in anomaly.smooth_bands(bands, P).orderBy("period").collect()]
    assert smooth == [2.0, 2.5, 3.0, 4.0, 4.5, 5.0]


def test_writing_a_day_twice_changes_nothing(spark, tmp_path):
    f = feed(spark, [(1, f"{DAY} 10:00", "view")])
    m = messages(spark, [])
    target = str(tmp_path / "slices")
    earlier = replace(P, as_of=date(2024, 1, 29))
    jobs.run_daily_slices(feed(spark, [(2, "2024-01-28 09:00", "view")]), m, earlier, target)
    jobs.run_daily_slices(f, m, P, target)
    first = dicts(slices.read_slices(spark, target))
    jobs.run_daily_slices(f, m, P, target)
    assert dicts(slices.read_slices(spark, target)) == first
    assert {r["event_date"] for r in first} == {date(2024, 1, 28), date(2024, 1, 29)}


def test_thresholds_are_inclusive_for_views_and_exclusive_for_messages(spark):
    f = feed(
        spark,
        [(1, f"{DAY} 10:00", "view")] * 10 + [(2, f"{DAY} 10:00", "view")] * 9,
    )
    assert reports.avg_feed_usage(f, P).first().avg_views == 10
    m = messages(spark, [(1, 2, f"{DAY} 10:00")] * 6 + [(2, 1, f"{DAY} 10:00")] * 5)
    assert reports.avg_message_usage(m, P).first().avg_sent == 6


def test_major_countries_are_of_the_feed(spark):
    f = feed(spark, [(u, f"{DAY} 10:00", "view") for u in range(3)])
    m = messages(spark, [(u, 1, f"{DAY} 10:00") for u in range(5)])
    dau = reports.dau_by_country(reports.audience_days(f, m, P))
    assert dicts(dau, "service") == [
        {"event_date": P.yesterday, "country": "Peru", "service": "Feed", "users": 3},
        {"event_date": P.yesterday, "country": "Peru", "service": "Message", "users": 5},
    ]
    major = reports.dau_by_country_major(dau, replace(P, min_country_users=3))
    assert [r.service for r in major.collect()] == ["Feed"]
