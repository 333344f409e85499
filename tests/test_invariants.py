"""What must hold between results, on the driver's tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.functions.calendar import event_date, week_start
from tidemark.operators import activity, cohorts, services, slices
from tidemark.sources.derived import StarSchema

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return StarSchema(spark, FOLDER)


def test_every_slice_has_the_same_totals(tables):
    rows = slices.slice_metrics(activity.attribute_totals(tables.feed, tables.messages))
    totals = rows.groupBy("event_date").pivot("dimension", slices.DIMENSIONS)
    sums = totals.agg(F.sum("views").alias("views"), F.sum("messages_sent").alias("sent"))
    for row in sums.collect():
        assert row.gender_views == row.os_views == row.age_views
        assert row.gender_sent == row.os_sent == row.age_sent
    views = rows.where("dimension = 'os'").agg(F.sum("views")).first()[0]
    assert views == tables.feed.where("action = 'view'").count()


def test_retained_and_new_are_the_active_users(tables):
    for events in (tables.feed, tables.messages):
        dynamics = cohorts.weekly_dynamics(cohorts.user_weeks(events))
        active = {
            r.week: r.users
            for r in events.groupBy(week_start(event_date()).alias("week"))
            .agg(F.count_distinct("user_id").alias("users"))
            .collect()
        }
        rows = dynamics.collect()
        assert {r.week: r.retained + r.new for r in rows} == active
        users = events.agg(F.count_distinct("user_id")).first()[0]
        assert sum(r.new for r in rows) == users
        first_seen = {r.week: r.new_users for r in cohorts.first_seen_week(events).collect()}
        assert first_seen == {r.week: r.new for r in rows if r.new}


def test_service_groups_add_up_to_the_days_users(tables):
    users = services.presence(tables.feed, tables.messages)
    counted = {}
    for group in (
        services.feed_only_users,
        services.message_only_users,
        services.both_service_users,
    ):
        for day, n in group(users).collect():
            counted[day] = counted.get(day, 0) + n
    everyone = tables.feed.select(event_date(), "user_id").union(
        tables.messages.select(event_date(), "user_id")
    )
    assert counted == {
        r.event_date: r.users
        for r in everyone.groupBy("event_date")
        .agg(F.count_distinct("user_id").alias("users"))
        .collect()
    }
