"""The two event tables as seen through the test-data star schema.

``events`` holds one row per user event; a content feed and a messenger are
read out of it by event type. All rules are plain expressions on the row, so
nothing is shuffled except where ``country`` is looked up.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
    ]
)
CUSTOMER = T.StructType(
    [T.StructField("c_custkey", T.LongType()), T.StructField("c_nationkey", T.IntegerType())]
)
NATION = T.StructType(
    [T.StructField("n_nationkey", T.IntegerType()), T.StructField("n_name", T.StringType())]
)

FEED_TYPES = ("view", "click", "error")
MESSAGE_TYPES = ("purchase", "signup")


def _renewed(account: Column) -> Column:
    """A third of the accounts get a new user id each week, so that weeks have new users."""
    week = F.floor(F.day("ts") / 7.0).cast("int")
    return F.when(account % 3 == 0, account + 100000 * week).otherwise(account)


def _who(account: Column) -> list[Column]:
    return [
        (account % 2).cast("int").alias("gender"),
        (15 + (account * 7) % 50).cast("int").alias("age"),
        F.when(account % 5 < 2, "iOS").otherwise("Android").alias("os"),
        F.when(account % 7 < 3, "ads").otherwise("organic").alias("source"),
        account.alias("account_id"),
    ]


def feed_rows(events: DataFrame) -> DataFrame:
    account = F.col("user_id")
    return events.where(F.col("event_type").isin(*FEED_TYPES)).select(
        _renewed(account).alias("user_id"),
        F.col("ts").alias("time"),
        F.when(F.col("event_type") == "click", "like").otherwise("view").alias("action"),
        *_who(account),
    )


def message_rows(events: DataFrame, accounts: Column) -> DataFrame:
    """``accounts`` is the number of distinct accounts, the range of receivers."""
    account = F.col("user_id")
    receiver = (F.col("event_id") * 7 + 3) % accounts
    return events.where(F.col("event_type").isin(*MESSAGE_TYPES)).select(
        _renewed(account).alias("user_id"),
        _renewed(receiver).alias("reciever_id"),
        F.col("ts").alias("time"),
        *_who(account),
    )


class StarSchema:
    """Lazy frames over one test-data folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self._folder = folder

    def _table(self, name: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self._folder}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        return self._table("events", EVENTS)

    @cached_property
    def feed(self) -> DataFrame:
        """Feed events without ``country``; see `with_country`."""
        return feed_rows(self.events)

    @cached_property
    def messages(self) -> DataFrame:
        """Messages without ``country``; see `with_country`."""
        accounts = self.events.select(F.count_distinct("user_id")).scalar()
        return message_rows(self.events, accounts)

    def with_country(self, frame: DataFrame) -> DataFrame:
        """Add ``country`` by ``account_id``; no row is lost or repeated.

        No broadcast is forced: Spark broadcasts the lookup only while its
        size is under ``autoBroadcastJoinThreshold`` and sorts and merges
        beyond it, where adaptive execution splits an overfull partition.
        Reduce the frame first where the query allows it.
        """
        nation = self._table("nation", NATION)
        country = (
            self._table("customer", CUSTOMER)
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("c_custkey").alias("account_id"), F.col("n_name").alias("country"))
        )
        return frame.join(country, "account_id", "left").drop("account_id")

    def stream_of_events(self, files_per_batch: int | None = None) -> DataFrame:
        """The events as a stream; watermarks need ``timestamp``, hence the cast.

        Without ``files_per_batch`` all files found at the start are one
        batch, so none is late whatever their order. Limit it only for files
        that arrive in order of time.
        """
        reader = self.spark.readStream.schema(EVENTS)
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        # The pattern matches a single file as well as a folder of files.
        events = reader.parquet(f"{self._folder}/events.parque[t]")
        return events.withColumn("ts", F.col("ts").cast("timestamp"))
