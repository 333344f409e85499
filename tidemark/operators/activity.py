"""Per-user daily activity of the feed and the messenger.

The frames passed in decide the days covered: one day for the daily run, any
number of days for a back-fill, since every step also groups by date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.calendar import event_date

USER_KEYS = ["user_id", "gender", "age", "os", "event_date"]

# The metrics of the slice table, in its column order.
METRICS = [
    "views",
    "likes",
    "messages_received",
    "messages_sent",
    "users_received",
    "users_sent",
]


def views() -> Column:
    return F.count_if(F.col("action") == "view").alias("views")


def likes() -> Column:
    return F.count_if(F.col("action") == "like").alias("likes")


def feed_activity(feed: DataFrame) -> DataFrame:
    return feed.groupBy("user_id", "gender", "age", "os", event_date()).agg(views(), likes())


def contacts(messages: DataFrame) -> DataFrame:
    """Messages per day, sender with attributes, and receiver.

    Both directions add these up. A sender or a receiver with a large part of
    all rows is spread over its partners here.
    """
    return messages.groupBy("user_id", "gender", "age", "os", event_date(), "reciever_id").agg(
        F.count("*").alias("messages")
    )


def _messages_with(column: str) -> Column:
    counted = F.when(F.col(column).isNotNull(), F.col("messages")).otherwise(F.lit(0))
    return F.sum(counted)


def messages_sent(messages: DataFrame) -> DataFrame:
    """Messages sent and distinct people written to, per sender."""
    return sent_to(contacts(messages))


def sent_to(pairs: DataFrame) -> DataFrame:
    """`messages_sent` from `contacts`, which has a receiver once per sender."""
    return pairs.groupBy("user_id", "gender", "age", "os", "event_date").agg(
        _messages_with("reciever_id").alias("messages_sent"),
        F.count("reciever_id").alias("users_sent"),
    )


def messages_received(messages: DataFrame) -> DataFrame:
    """Messages received and distinct senders, per receiver."""
    return received_from(contacts(messages))


def received_from(pairs: DataFrame) -> DataFrame:
    """`messages_received` from `contacts`; a sender may be there in several attributes."""
    return pairs.groupBy("reciever_id", "event_date").agg(
        _messages_with("user_id").alias("messages_received"),
        F.count_distinct("user_id").alias("users_received"),
    )


def messages_activity(messages: DataFrame) -> DataFrame:
    """Both directions for users who sent and received on the same day.

    Received counts belong to the user alone, so they repeat for a user who
    sent from two sets of attributes. Both directions start from the same
    `contacts`, whose shuffle is done once.
    """
    pairs = contacts(messages)
    sent = sent_to(pairs)
    received = received_from(pairs).withColumnsRenamed({"reciever_id": "user_id"})
    return sent.join(received, ["user_id", "event_date"])


def _as_metrics(frame: DataFrame, keys: list[Column | str]) -> DataFrame:
    """``frame`` with all six metrics; those it does not have are 0."""
    return frame.select(
        *keys,
        *[
            (F.col(m) if m in frame.columns else F.lit(0).cast("bigint")).alias(m)
            for m in METRICS
        ],
    )


def _totals() -> list[Column]:
    return [F.sum(m).alias(m) for m in METRICS]


def user_activity(feed: DataFrame, messages: DataFrame) -> DataFrame:
    """Feed and messenger activity side by side, 0 where a user has only one.

    Both inputs have one row per key, so adding up their union is the full
    outer merge. ``groupBy`` matches NULL keys with each other, as the merge
    must, and needs no join; missing attributes then read 0 like the metrics.
    """
    rows = _as_metrics(feed_activity(feed), USER_KEYS).unionByName(
        _as_metrics(messages_activity(messages), USER_KEYS)
    )
    return rows.groupBy(*USER_KEYS).agg(*_totals()).select(
        "user_id", *_filled_attributes(), "event_date", *METRICS
    )


def _filled_attributes() -> list[Column]:
    return [
        F.coalesce("gender", F.lit(0)).alias("gender"),
        F.coalesce("age", F.lit(0)).alias("age"),
        F.coalesce("os", F.lit("0")).alias("os"),
    ]


def attribute_totals(feed: DataFrame, messages: DataFrame) -> DataFrame:
    """The six metrics per day and set of attributes, the base of all slices.

    The slices only add up per-user numbers, and adding does not care whether
    a user's feed and messenger rows were merged first. So the feed goes from
    the scan straight into a handful of totals and is never shuffled by user;
    only the distinct counts of the messenger are.
    """
    keys = [event_date(), "gender", "age", "os"]
    feed_totals = feed.groupBy(*keys).agg(views(), likes())
    filled = ["event_date", *_filled_attributes()]
    rows = _as_metrics(feed_totals, filled).unionByName(
        _as_metrics(messages_activity(messages), filled)
    )
    return rows.groupBy("event_date", "gender", "age", "os").agg(*_totals())
