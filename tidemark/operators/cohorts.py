"""Weekly cohorts: new, retained and gone users of a service."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.calendar import event_date, week_start
from tidemark.functions.numbers import ratio


def user_weeks(events: DataFrame) -> DataFrame:
    """Users and the weeks of their events: all the cohorts need. Rows may repeat."""
    return events.select("user_id", week_start(event_date()).alias("week"))


def first_seen_week(events: DataFrame) -> DataFrame:
    """New users per week: a user is new in the first week with an event."""
    first = events.groupBy("user_id").agg(F.min(week_start(event_date())).alias("week"))
    return first.groupBy("week").agg(F.count("user_id").alias("new_users")).orderBy("week")


def weekly_dynamics(weeks: DataFrame) -> DataFrame:
    """Retained, new and gone users and the share that stayed, from `user_weeks`.

    "Retained" is everyone who is not new, returning users included; "gone" is
    retained minus last week's active users, so it is normally negative.

    A user's weeks meet in one set, one entry per week the user was active, whose
    smallest entry is the first week; so everything takes one shuffle by user.
    From there on there is one row per week.
    """
    return dynamics(
        weeks.groupBy("user_id")
        .agg(F.collect_set("week").alias("weeks"))
        .select(
            "user_id", F.array_min("weeks").alias("first_week"), F.explode("weeks").alias("week")
        )
        .groupBy("week")
        .agg(
            F.count("user_id").alias("active_users"),
            F.count_if(F.col("week") == F.col("first_week")).alias("new_users"),
        )
    )


def dynamics(counts: DataFrame) -> DataFrame:
    """`weekly_dynamics` from ``week, active_users, new_users``.

    Each week also passes its active users on to the calendar week after it; a
    week following a gap hence finds none and counts 0.
    """
    none = F.lit(0).cast("bigint")
    this_week = F.struct("week", "active_users", "new_users", none.alias("previous_users"))
    next_week = F.struct(
        F.date_add("week", 7).alias("week"),
        none.alias("active_users"),
        none.alias("new_users"),
        F.col("active_users").alias("previous_users"),
    )
    passed_on = counts.select(F.explode(F.array(this_week, next_week)).alias("r")).select("r.*")
    retained = F.col("active_users") - F.col("new_users")
    return (
        passed_on.groupBy("week")
        .agg(*[F.sum(c).alias(c) for c in ("active_users", "new_users", "previous_users")])
        .where(F.col("active_users") > 0)
        .select(
            "week",
            retained.alias("retained"),
            F.col("new_users").alias("new"),
            (retained - F.col("previous_users")).alias("gone"),
            F.coalesce(ratio(retained, F.col("previous_users")) * 100, F.lit(0.0)).alias(
                "stayed"
            ),
        )
        .orderBy("week")
    )


def _by_service(feed: DataFrame, messages: DataFrame) -> DataFrame:
    return feed.withColumn("service", F.lit("Feed")).unionByName(
        messages.withColumn("service", F.lit("Message"))
    )


def weekly_stayed_compare(feed: DataFrame, messages: DataFrame) -> DataFrame:
    """The share that stayed in both services, each over its own weeks."""
    return _by_service(feed, messages).select("service", "week", "stayed").orderBy(
        "service", "week"
    )


def weekly_dynamics_series(feed: DataFrame, messages: DataFrame) -> DataFrame:
    """`weekly_dynamics` of both services with one row per charted value."""
    wide = _by_service(feed, messages).select(
        "service",
        "week",
        F.col("new").alias("New"),
        F.col("retained").alias("Retained"),
        F.col("gone").alias("Gone"),
    )
    series = wide.unpivot(["service", "week"], ["New", "Retained", "Gone"], "metric", "value")
    return series.orderBy("service", "metric", "week")
