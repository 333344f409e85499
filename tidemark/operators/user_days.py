"""One row per day, user, country and traffic source: the base of the whole-app report.

The report's audiences, averages, cohorts and overlaps all follow from it, so
each event table is read and shuffled once, however many of them are built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.calendar import event_date, week_start
from tidemark.operators import reports
from tidemark.params import Params

COUNTS = ["views", "likes", "feed_rows", "sent"]
USER_DAYS = T.StructType(
    [
        T.StructField("event_date", T.DateType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("country", T.StringType()),
        T.StructField("source", T.StringType()),
        *[T.StructField(name, T.LongType()) for name in COUNTS],
    ]
)


def user_days(feed: DataFrame, messages: DataFrame) -> DataFrame:
    """What each user did on each day, from either table or both."""
    keys = [event_date(), "user_id", "country", "source"]
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")

    def if_action(name: str) -> Column:
        return F.when(F.col("action") == name, one).otherwise(none)

    rows = feed.select(
        *keys,
        if_action("view").alias("views"),
        if_action("like").alias("likes"),
        one.alias("feed_rows"),
        none.alias("sent"),
    ).unionByName(
        messages.select(
            *keys, none.alias("views"), none.alias("likes"), none.alias("feed_rows"),
            one.alias("sent"),
        )
    )
    return rows.groupBy(*USER_DAYS.names[:4]).agg(*[F.sum(c).alias(c) for c in COUNTS])


def in_report(base: DataFrame, p: Params) -> DataFrame:
    return base.where(F.col("event_date").between(F.lit(p.day(p.report_days)), F.lit(p.as_of)))


def of_feed(base: DataFrame) -> DataFrame:
    return base.where("feed_rows > 0")


def of_messages(base: DataFrame) -> DataFrame:
    return base.where("sent > 0")


def audience(base: DataFrame, p: Params) -> DataFrame:
    """`reports.audience_days` from the base."""
    services = F.filter(
        F.array(F.when(F.col("feed_rows") > 0, "Feed"), F.when(F.col("sent") > 0, "Message")),
        lambda service: service.isNotNull(),
    )
    return (
        in_report(base, p)
        .select("event_date", "user_id", "country", F.explode(services).alias("service"))
        .distinct()
    )


def avg_feed_usage(base: DataFrame, p: Params) -> DataFrame:
    per_user = (
        of_feed(in_report(base, p))
        .groupBy("event_date", "user_id")
        .agg(F.sum("views").alias("views"), F.sum("likes").alias("likes"))
    )
    return reports.average_of_viewers(per_user, p)


def avg_message_usage(base: DataFrame, p: Params) -> DataFrame:
    per_user = (
        of_messages(in_report(base, p))
        .groupBy("event_date", "user_id")
        .agg(F.sum("sent").alias("sent"))
    )
    return reports.average_of_senders(per_user, p)


def dau_by_source(base: DataFrame, p: Params) -> DataFrame:
    """For `of_feed` or `of_messages`."""
    return reports.users_by_source(in_report(base, p))


def user_weeks(base: DataFrame) -> DataFrame:
    """`cohorts.user_weeks` from the base."""
    return base.select("user_id", week_start(F.col("event_date")).alias("week"))


def presence(base: DataFrame) -> DataFrame:
    """`services.presence` from the base."""
    return base.groupBy("event_date", "user_id").agg(
        F.bool_or(F.col("feed_rows") > 0).alias("in_feed"),
        F.bool_or(F.col("sent") > 0).alias("in_messages"),
    )
