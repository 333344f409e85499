"""Result sets of the two daily reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.calendar import event_date
from tidemark.functions.numbers import ratio, two_places
from tidemark.operators.activity import likes, views
from tidemark.operators.filters import in_kpi_days, in_report_days
from tidemark.params import Params

# The text of the feed digest.
DIGEST_TEXT = (
    "Cтатистика за вчера:\n"
    "        DAU = %d users\n"
    "        Views = %d\n"
    "        Likes = %d\n"
    "        CTR = %s%%"
)


def feed_kpi(feed: DataFrame, p: Params) -> DataFrame:
    """Users, views, likes and CTR in percent for each of the last full days."""
    return (
        in_kpi_days(feed, p)
        .groupBy(event_date().alias("day"))
        .agg(F.count_distinct("user_id").alias("dau"), views(), likes())
        .withColumn("ctr", ratio(F.col("likes"), F.col("views")) * 100)
        .orderBy("day")
    )


def feed_kpi_digest(kpi: DataFrame) -> DataFrame:
    """The newest day of `feed_kpi` as a message; likes without views read ``inf``."""
    undefined = F.when(F.col("likes") > 0, "inf").otherwise("nan")
    ctr = F.coalesce(two_places(F.col("ctr")), undefined)
    message = F.format_string(DIGEST_TEXT, "dau", "views", "likes", ctr)
    return kpi.orderBy(F.desc("day")).limit(1).withColumn("message", message)


def feed_kpi_series(kpi: DataFrame) -> DataFrame:
    """`feed_kpi` with one row per day and metric, as the charts need it."""
    values = {"DAU": "dau", "Views": "views", "Likes": "likes", "CTR": "ctr"}
    wide = kpi.select("day", *[F.col(c).cast("double").alias(m) for m, c in values.items()])
    return wide.unpivot("day", list(values), "metric", "value").orderBy("metric", "day")


def audience_days(
    feed: DataFrame, messages: DataFrame, p: Params, keys: tuple[str, ...] = ("country",)
) -> DataFrame:
    """Who used which service on which day, once each.

    ``keys`` are the attributes to keep. When the country has to be looked up,
    keep the lookup key instead and join afterwards: by then a user with any
    number of events is down to one row a day.
    """
    columns = [event_date(), "user_id", *keys]
    rows = (
        in_report_days(feed, p)
        .select(*columns, F.lit("Feed").alias("service"))
        .unionByName(
            in_report_days(messages, p).select(*columns, F.lit("Message").alias("service"))
        )
    )
    return rows.distinct()


def dau_by_country(audience: DataFrame) -> DataFrame:
    """Users per day, country and service, from `audience_days`."""
    return audience.groupBy("event_date", "country", "service").agg(
        F.count_distinct("user_id").alias("users")
    )


def dau_by_country_major(dau: DataFrame, p: Params) -> DataFrame:
    """The feed's larger countries."""
    return dau.where((F.col("users") >= p.min_country_users) & (F.col("service") == "Feed"))


def avg_feed_usage(feed: DataFrame, p: Params) -> DataFrame:
    """Average views and likes of the day's more active users."""
    per_user = in_report_days(feed, p).groupBy(event_date(), "user_id").agg(views(), likes())
    return average_of_viewers(per_user, p)


def average_of_viewers(per_user: DataFrame, p: Params) -> DataFrame:
    return (
        per_user.where(F.col("views") >= p.min_views)
        .groupBy("event_date")
        .agg(F.avg("views").alias("avg_views"), F.avg("likes").alias("avg_likes"))
        .orderBy("event_date")
    )


def avg_message_usage(messages: DataFrame, p: Params) -> DataFrame:
    """Average messages sent by the day's more active senders."""
    per_user = (
        in_report_days(messages, p)
        .groupBy(event_date(), "user_id")
        .agg(F.count("user_id").alias("sent"))
    )
    return average_of_senders(per_user, p)


def average_of_senders(per_user: DataFrame, p: Params) -> DataFrame:
    return (
        per_user.where(F.col("sent") > p.min_sent_exclusive)
        .groupBy("event_date")
        .agg(F.avg("sent").alias("avg_sent"))
        .orderBy("event_date")
    )


def dau_by_source(events: DataFrame, p: Params) -> DataFrame:
    """Users per day and traffic source, for either event table."""
    return users_by_source(in_report_days(events, p).select(event_date(), "source", "user_id"))


def users_by_source(days: DataFrame) -> DataFrame:
    return (
        days.groupBy("event_date", "source")
        .agg(F.count_distinct("user_id").alias("users"))
        .orderBy("event_date", "source")
    )
