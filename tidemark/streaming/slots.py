"""The slot metrics as a stream that emits each slot once it is closed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.operators.activity import likes, views
from tidemark.operators.anomaly import slot_columns
from tidemark.params import Params
from tidemark.streaming.state import state_on_disk

SLOT_METRICS = T.StructType(
    [
        T.StructField("event_date", T.DateType()),
        T.StructField("period", T.TimestampType()),
        T.StructField("hm", T.StringType()),
        T.StructField("mes_users", T.LongType()),
        T.StructField("sent_messages", T.LongType()),
        T.StructField("views", T.LongType()),
        T.StructField("likes", T.LongType()),
        T.StructField("ctr", T.DoubleType()),
        T.StructField("feed_users", T.LongType()),
    ]
)


def _tagged(feed: DataFrame, messages: DataFrame) -> DataFrame:
    """Both tables under one another; messages have no ``action``."""
    return feed.select("time", "user_id", "action", F.lit(True).alias("in_feed")).unionByName(
        messages.select(
            "time",
            "user_id",
            F.lit(None).cast("string").alias("action"),
            F.lit(False).alias("in_feed"),
        )
    )


def stream_slot_metrics(
    feed: DataFrame, messages: DataFrame, p: Params, lateness: str = "1 hour"
) -> DataFrame:
    """`slot_metrics` over two streams.

    Streams do not take ``count_distinct`` and would hold two states to join,
    so both tables go into one aggregation per slot and user, which a second
    one sums up to slots. State is kept per user and open slot and is dropped
    with the slot. Each side has its own watermark, so that the slower source
    holds a slot open.
    """
    rows = _tagged(feed.withWatermark("time", lateness), messages.withWatermark("time", lateness))
    users = rows.groupBy(F.window("time", f"{p.slot_minutes} minutes"), "user_id").agg(
        views(),
        likes(),
        F.count_if(F.col("in_feed")).alias("feed_rows"),
        F.count_if(~F.col("in_feed")).alias("message_rows"),
    )
    slots = users.groupBy("window").agg(
        F.count_if(F.col("message_rows") > 0).alias("mes_users"),
        F.sum("message_rows").alias("sent_messages"),
        F.sum("views").alias("views"),
        F.sum("likes").alias("likes"),
        F.count_if(F.col("feed_rows") > 0).alias("feed_users"),
    )
    in_both = slots.where((F.col("mes_users") > 0) & (F.col("feed_users") > 0))
    return slot_columns(in_both.withColumn("period", F.col("window.start")))


def trigger(every: str | None) -> dict[str, str | bool]:
    return {"processingTime": every} if every else {"availableNow": True}


def run_to_files(
    slots: DataFrame, out: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Write closed slots to files, by default working off what is there and then stopping.

    `every` is the time between micro-batches of a stream that does not stop.
    A batch closes a few slots, one row each, which go into one file.
    """
    with state_on_disk(slots.sparkSession):
        return (
            slots.repartition(1)
            .writeStream.format("parquet")
            .outputMode("append")
            .option("path", out)
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger(every))
            .start()
        )


def read_slots(spark: SparkSession, path: str) -> DataFrame:
    """The stored slots, with ``period`` as in batch."""
    stored = spark.read.schema(SLOT_METRICS).parquet(path)
    return stored.withColumn("period", F.col("period").cast("timestamp_ntz"))
