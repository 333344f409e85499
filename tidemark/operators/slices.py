"""Slices of daily activity by one user attribute, and the table they go to."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.activity import METRICS

DIMENSIONS = ["gender", "os", "age"]

SLICE_METRICS = T.StructType(
    [
        T.StructField("event_date", T.DateType()),
        T.StructField("dimension", T.StringType()),
        T.StructField("dimension_value", T.StringType()),
        *[T.StructField(name, T.LongType()) for name in METRICS],
    ]
)

# The version of a day that counts is the one with the highest number.
PUBLISHED = "number long, version string, event_date date"


def _label(dimension: str) -> Column:
    """The slice value as text; gender codes are spelled out, others kept."""
    value = F.col(dimension)
    text = value.cast("string")
    if dimension == "gender":
        return F.when(value == 0, "Female").when(value == 1, "Male").otherwise(text)
    return text


def _to_target(frame: DataFrame) -> DataFrame:
    return frame.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SLICE_METRICS])


def slice_by(totals: DataFrame, dimension: str) -> DataFrame:
    """One slice from `activity.attribute_totals` or `activity.user_activity`."""
    sums = totals.groupBy("event_date", dimension).agg(*[F.sum(m).alias(m) for m in METRICS])
    return _to_target(
        sums.withColumns({"dimension": F.lit(dimension), "dimension_value": _label(dimension)})
    )


def slice_metrics(totals: DataFrame) -> DataFrame:
    """All slices at once: the totals are expanded and shuffled a single time.

    A row's slice is told by ``grouping``, not by which attributes are NULL.
    """
    sums = totals.groupingSets(
        [["event_date", d] for d in DIMENSIONS], "event_date", *DIMENSIONS
    ).agg(
        *[F.sum(m).alias(m) for m in METRICS],
        *[F.grouping(d).alias(f"no_{d}") for d in DIMENSIONS],
    )
    dimension = F.lit(None).cast("string")
    value = F.lit(None).cast("string")
    for d in DIMENSIONS:
        here = F.col(f"no_{d}") == 0
        dimension = F.when(here, d).otherwise(dimension)
        value = F.when(here, _label(d)).otherwise(value)
    return _to_target(sums.withColumns({"dimension": dimension, "dimension_value": value}))


def write_slices(slices: DataFrame, path: str, days: Sequence[date] = ()) -> None:
    """Write days of slices, replacing those days and leaving all others.

    `days` are replaced even if there is no row for them: a day whose events are
    gone must not keep its old slices. A repeated run therefore never doubles a
    day. A day has a few hundred rows, so each goes into one file, sorted by slice.

    The rows lie in a new version of each day, and one file then names the version
    for all of them: readers see all days of a run or none. What it replaced
    stays until someone deletes it. One run at a time writes.
    """
    version = uuid.uuid4().hex
    (
        _to_target(slices)
        .withColumn("version", F.lit(version))
        .repartition("event_date")
        .sortWithinPartitions("event_date", "dimension", "dimension_value")
        .write.mode("append")
        .partitionBy("event_date", "version")
        .parquet(path)
    )
    spark = slices.sparkSession
    written = _versions(spark, path).where(F.col("version") == version)
    found = {row.event_date for row in written.select("event_date").distinct().collect()}
    _publish(spark, path, version, sorted({*found, *days}))


def _versions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(T.StructType([*SLICE_METRICS]).add("version", "string")).parquet(path)


def _published(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(PUBLISHED).parquet(f"{path}/_published")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], PUBLISHED)


def _publish(spark: SparkSession, path: str, version: str, days: Sequence[date]) -> None:
    number = (_published(spark, path).agg(F.max("number")).first()[0] or 0) + 1
    rows = spark.createDataFrame([(number, version, day) for day in days], PUBLISHED)
    rows.coalesce(1).write.mode("append").parquet(f"{path}/_published")


def read_slices(spark: SparkSession, path: str) -> DataFrame:
    """The published version of every day."""
    newest = _published(spark, path).groupBy("event_date").agg(
        F.max_by("version", "number").alias("version")
    )
    rows = _versions(spark, path).join(newest, ["event_date", "version"], "left_semi")
    return _to_target(rows)
