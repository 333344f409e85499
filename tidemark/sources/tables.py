"""The two event tables: their schemas and how to read them."""

from __future__ import annotations

from collections.abc import Collection
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.loads import add_load, loaded_events

_WHO = [
    T.StructField("gender", T.IntegerType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("os", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("source", T.StringType()),
]

FEED_ACTIONS = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("time", T.TimestampNTZType()),
        T.StructField("action", T.StringType()),
        *_WHO,
    ]
)

# `reciever_id` is the column's established spelling.
MESSAGE_ACTIONS = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("reciever_id", T.LongType()),
        T.StructField("time", T.TimestampNTZType()),
        *_WHO,
    ]
)

# Where Spark leaves a row that does not fit.
RAW = "_raw"


def conform(frame: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast ``frame`` to ``schema``, keeping an ``event_date`` partition column."""
    missing = [name for name in schema.names if name not in frame.columns]
    if missing:
        raise ValueError(f"columns missing from the source: {', '.join(missing)}")
    columns = [F.col(field.name).cast(field.dataType).alias(field.name) for field in schema]
    if "event_date" in frame.columns and "event_date" not in schema.names:
        columns.append(F.col("event_date").cast("date").alias("event_date"))
    return frame.select(*columns)


def read_events(
    spark: SparkSession,
    schema: T.StructType,
    path: str | None = None,
    fmt: str = "parquet",
    days: Collection[date] | None = None,
    **options: str,
) -> DataFrame:
    """Read one of the event tables from any batch format Spark knows.

    Of a table that `append_events` or `write_events` wrote, the loads that count
    are read; with `days`, only the folders of those days are listed.

    Files without column types of their own (csv, json) are read straight into
    ``schema``. For ``fmt='jdbc'`` pass ``partitionColumn``, ``lowerBound``,
    ``upperBound`` and ``numPartitions``, so that the warehouse is read by many
    tasks and not by one.
    """
    if fmt == "parquet" and path:
        events = loaded_events(spark, path, schema, days)
        if events is not None:
            return conform(events, schema)
    reader = spark.read.format(fmt).options(**options)
    if fmt in ("csv", "json"):
        reader = reader.schema(schema)
    return conform(reader.load(path) if path else reader.load(), schema)


def sift_events(
    spark: SparkSession, schema: T.StructType, path: str, fmt: str, **options: str
) -> tuple[DataFrame, DataFrame]:
    """The events of csv or json files, and the rows that are damaged.

    A row is damaged if it cannot be read as `schema` (``reason`` "unreadable"), or has
    no user or no time ("no user_id", "no time"), without which it counts nowhere;
    ``raw`` is the row as it stands in the file, ``file`` its name. Every row is in
    exactly one of the two.
    """
    if fmt not in ("csv", "json"):
        raise ValueError("only csv and json have rows that do not fit their schema")
    marked = T.StructType([*schema, T.StructField(RAW, T.StringType())])
    rows = (
        spark.read.format(fmt)
        .options(**{**options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW})
        .schema(marked)
        .load(path)
        .withColumn("file", F.col("_metadata.file_path"))
    )
    reason = (
        F.when(F.col(RAW).isNotNull(), "unreadable")
        .when(F.col("user_id").isNull(), "no user_id")
        .when(F.col("time").isNull(), "no time")
    )
    sifted = rows.withColumn("reason", reason)
    raw = F.coalesce(F.col(RAW), F.to_json(F.struct(*schema.names)))
    damaged = sifted.where(F.col("reason").isNotNull()).select(
        F.to_date("time").alias("event_date"), "file", "reason", raw.alias("raw")
    )
    return conform(sifted.where(F.col("reason").isNull()), schema), damaged


def load_sifted(
    spark: SparkSession, schema: T.StructType, source: str, fmt: str, path: str, aside: str,
    **options: str,
) -> dict[str, int]:
    """Append the sound rows of files to the event table at `path`, the others to `aside`.

    Returns how many rows were ``kept`` and how many were set aside, by reason. The rows
    set aside stay with their reason and file, for a load of their own once they are mended.
    """
    sound, damaged = sift_events(spark, schema, source, fmt, **options)
    damaged.write.mode("append").partitionBy("reason").parquet(aside)
    append_events(sound, schema, path)
    counts = {row.reason: row["count"] for row in damaged.groupBy("reason").count().collect()}
    return {"kept": sound.count(), **counts}


def stream_events(
    spark: SparkSession,
    schema: T.StructType,
    path: str,
    fmt: str = "parquet",
    **options: str,
) -> DataFrame:
    """One of the event tables as a stream of the files that arrive in its folder.

    ``time`` is a ``timestamp``, as watermarks need it. Folders by day add an
    ``event_date``, which the streams do not use.
    """
    files = spark.readStream.format(fmt).options(**options).schema(schema).load(path)
    return conform(files, schema).withColumn("time", F.col("time").cast("timestamp"))


def append_events(events: DataFrame, schema: T.StructType, path: str) -> None:
    """Add events to the days they fall on, late ones to older days; nothing is replaced.

    For loads that bring each event once; a load that is repeated as a whole
    belongs to `write_events`.
    """
    add_load(_by_day(events, schema), path, replaces=False)


def write_events(events: DataFrame, schema: T.StructType, path: str) -> None:
    """Store whole days of events, replacing the days they cover.

    Days that the load covers only in part lose the rest: see `append_events`.
    Earlier loads of its days stay until someone deletes them and are not read. A job for one day then reads one day. ``rebalance`` gathers a day's events
    into files of the advisory size: it merges the pieces of a small day and
    splits a large one over many tasks.
    """
    add_load(_by_day(events, schema), path, replaces=True)


def _by_day(events: DataFrame, schema: T.StructType) -> DataFrame:
    return (
        conform(events, schema)
        .withColumn("event_date", F.to_date("time"))
        .hint("rebalance", "event_date")
    )
