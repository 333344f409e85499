"""Which loads a day of an event table consists of.

A table by day lies in ``event_date=D/load=L`` folders, one per load and day. Once
a load's files are all there, a row per day is added to a small table of loads
beside them, itself in a folder per day. Readers follow that table: a load that
did not end is not seen, and a job that needs a few days lists and opens only
theirs. A load may replace its days; the loads before it then no longer count
there, and their folders may be deleted. One load at a time writes to a table.
"""

from __future__ import annotations

import uuid
from collections.abc import Collection
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Folders that begin with an underscore are not part of the data.
LOADS = "_loads"
LOAD_ROWS = T.StructType(
    [
        T.StructField("number", T.LongType()),
        T.StructField("load", T.StringType()),
        T.StructField("replaces", T.BooleanType()),
        T.StructField("event_date", T.DateType()),
    ]
)


def add_load(by_day: DataFrame, path: str, replaces: bool) -> None:
    """Write events that have an ``event_date`` as a load of their days."""
    spark, load = by_day.sparkSession, uuid.uuid4().hex
    by_day.withColumn("load", F.lit(load)).write.mode("append").partitionBy(
        "event_date", "load"
    ).parquet(path)
    written = _read(spark, path, f"event_date=*/load={load}", schema=None)
    if written is None:
        return
    days = [row.event_date for row in written.select("event_date").distinct().collect()]
    _record(spark, path, load, days, replaces)


def _record(
    spark: SparkSession, path: str, load: str, days: Collection[date], replaces: bool
) -> None:
    known = live_loads(spark, path, days, all_of_them=True)
    before = known.agg(F.max("number")).first()[0] if known is not None else None
    rows = [((before or 0) + 1, load, replaces, day) for day in days]
    (
        spark.createDataFrame(rows, LOAD_ROWS)
        .coalesce(1)
        .write.mode("append")
        .partitionBy("event_date")
        .parquet(f"{path}/{LOADS}")
    )


def _read(
    spark: SparkSession, path: str, below: str, schema: T.StructType | None
) -> DataFrame | None:
    reader = spark.read.option("basePath", path)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.parquet(f"{path}/{below}" if below else path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def live_loads(
    spark: SparkSession,
    path: str,
    days: Collection[date] | None = None,
    all_of_them: bool = False,
) -> DataFrame | None:
    """``event_date, load, number`` of the loads that count on the given days, or on all.

    None if the table has no table of loads. Only the folders of the days are opened.
    """
    rows = _read(spark, f"{path}/{LOADS}", "", LOAD_ROWS)
    if rows is None:
        return None
    if days is not None:
        rows = rows.where(F.col("event_date").isin(list(days)))
    if not all_of_them:
        since = rows.groupBy("event_date").agg(
            F.max(F.when(F.col("replaces"), F.col("number"))).alias("since")
        )
        rows = rows.join(since, "event_date").where("since is null or number >= since")
    return rows.select("event_date", "load", "number")


def loaded_events(
    spark: SparkSession, path: str, schema: T.StructType, days: Collection[date] | None = None
) -> DataFrame | None:
    """The events of the loads that count; None if the table has no table of loads.

    Only the folders of these loads are listed, with `days` only those of the days.
    """
    loads = live_loads(spark, path, days)
    if loads is None:
        return None
    laid_out = T.StructType(
        [
            *schema,
            T.StructField("event_date", T.DateType()),
            T.StructField("load", T.StringType()),
        ]
    )
    folders = [f"{path}/event_date={row.event_date}/load={row.load}" for row in loads.collect()]
    if not folders:
        return spark.createDataFrame([], laid_out).drop("load")
    return spark.read.option("basePath", path).schema(laid_out).parquet(*folders).drop("load")


def load_sources(
    spark: SparkSession, paths: Collection[str], days: Collection[date] | None = None
) -> dict[date, str] | None:
    """What each day's events consist of, as a digest of the loads of all the tables.

    None if one of the tables has no table of loads.
    """
    parts = []
    for number, path in enumerate(paths):
        loads = live_loads(spark, path, days)
        if loads is None:
            return None
        parts.append(
            loads.select("event_date", F.concat_ws(" ", F.lit(str(number)), "load").alias("part"))
        )
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    named = F.concat_ws("\n", F.col("event_date").cast("string"), F.sort_array(F.collect_list("part")))
    rows = every.groupBy("event_date").agg(F.sha2(named, 256).alias("source"))
    return {row.event_date: row.source for row in rows.collect()}
