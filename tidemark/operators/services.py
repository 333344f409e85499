"""How the daily audiences of the two services overlap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.calendar import event_date
from tidemark.functions.numbers import ratio


USAGE_COUNTS = T.StructType(
    [
        T.StructField("event_date", T.DateType()),
        *[T.StructField(n, T.LongType()) for n in ("all_users", "message_only", "feed_only", "both")],
    ]
)


def presence(feed: DataFrame, messages: DataFrame) -> DataFrame:
    """One row per day and user, telling which of the services they used.

    The differences and the intersection of the two audiences are all read
    off these flags, so each table is scanned and shuffled once.
    """
    rows = feed.select(
        event_date(), "user_id", F.lit(True).alias("in_feed"), F.lit(False).alias("in_messages")
    ).unionByName(
        messages.select(
            event_date(),
            "user_id",
            F.lit(False).alias("in_feed"),
            F.lit(True).alias("in_messages"),
        )
    )
    return rows.groupBy("event_date", "user_id").agg(
        F.bool_or("in_feed").alias("in_feed"), F.bool_or("in_messages").alias("in_messages")
    )


def _feed_only() -> Column:
    return F.col("in_feed") & ~F.col("in_messages")


def _message_only() -> Column:
    return F.col("in_messages") & ~F.col("in_feed")


def _both() -> Column:
    return F.col("in_feed") & F.col("in_messages")


def _count(users: DataFrame, name: str) -> DataFrame:
    return users.groupBy("event_date").agg(F.count("user_id").alias(name))


def feed_only_users(users: DataFrame) -> DataFrame:
    return _count(users.where(_feed_only()), "feed_only_users")


def message_only_users(users: DataFrame) -> DataFrame:
    return _count(users.where(_message_only()), "message_only_users")


def both_service_users(users: DataFrame) -> DataFrame:
    return _count(users.where(_both()), "both_service_users")


def service_usage(users: DataFrame) -> DataFrame:
    """All users of a day and how they split, from `presence`.

    Days that lack one of the three groups are left out, and all days in the
    tables are covered.
    """
    return usage_shares(usage_counts(users))


def usage_counts(users: DataFrame) -> DataFrame:
    """Per day the users of both services and of each group, from `presence`."""
    return users.groupBy("event_date").agg(
        F.count("user_id").alias("all_users"),
        F.count_if(_message_only()).alias("message_only"),
        F.count_if(_feed_only()).alias("feed_only"),
        F.count_if(_both()).alias("both"),
    )


def usage_shares(counts: DataFrame) -> DataFrame:
    """`service_usage` from `usage_counts`."""
    groups = ["message_only", "feed_only", "both"]
    kept = counts
    for group in groups:
        kept = kept.where(F.col(group) > 0)
    return kept.select(
        "event_date",
        "all_users",
        *[ratio(F.col(g), F.col("all_users")).alias(f"{g}_share") for g in groups],
    )


def service_usage_stack(usage: DataFrame) -> DataFrame:
    """Lower and upper bounds of the stacked bars: feed, both, messages."""
    feed_top = F.col("feed_only_share")
    both_top = feed_top + F.col("both_share")
    return usage.select(
        "event_date",
        F.lit(0.0).alias("feed_only_bottom"),
        feed_top.alias("feed_only_top"),
        feed_top.alias("both_bottom"),
        both_top.alias("both_top"),
        both_top.alias("message_only_bottom"),
        (both_top + F.col("message_only_share")).alias("message_only_top"),
    ).orderBy("event_date")
