"""What a stream has found out per slot, in a folder per day.

Every write adds one small file per day it touches and carries a version that is
higher than all before it in those days. Of a slot's rows only those of the
highest version count, so a batch that runs twice, a stream that starts anew or
a correction replaces a slot by itself and leaves all others. A day of more
than `FILES` files is written again as one: the rows that count come first, as
a version of their own, and only then do the files before them go, so whatever
is lost on the way, no slot is. One writer at a time; who reads while a day is
gathered may have to read again.
"""

from __future__ import annotations

from collections.abc import Collection
from datetime import date
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.scratch import delete

FILES = 8


class SlotLog:
    """Rows with a ``period`` and the given other columns; ``gone`` takes a slot back."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType) -> None:
        self._spark = spark
        self._path = path
        self._names = [name for name in schema.names if name != "event_date"]
        own = [schema[name] for name in self._names]
        self._schema = T.StructType(
            [
                *own,
                T.StructField("version", T.LongType()),
                T.StructField("gone", T.BooleanType()),
                T.StructField("event_date", T.DateType()),
            ]
        )

    def _written(self) -> DataFrame:
        try:
            return self._spark.read.schema(self._schema).parquet(self._path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self._spark.createDataFrame([], self._schema)

    def _counting(self, written: DataFrame) -> DataFrame:
        """The rows that count, with their version, and the slots taken back."""
        rest = [F.col(n) for n in (*self._names[:], "gone") if n != "period"]
        newest = F.max_by(F.struct(*rest), "version").alias("row")
        return written.groupBy("event_date", "period").agg(
            newest, F.max("version").alias("version")
        ).select("event_date", "period", "version", "row.*")

    def rows(self, since: date | None = None, until: date | None = None) -> DataFrame:
        """The slots of the given days, both included; the folders of others are not opened."""
        rows = self._counting(self._between(since, until)).where("not gone")
        return rows.select("event_date", *self._names)

    def _between(self, since: date | None, until: date | None) -> DataFrame:
        written = self._written()
        if since is not None:
            written = written.where(F.col("event_date") >= F.lit(since))
        if until is not None:
            written = written.where(F.col("event_date") <= F.lit(until))
        return written

    def add(self, rows: DataFrame, days: Collection[date]) -> None:
        """Store the rows, which fall on `days`; a true ``gone``, if there, takes a slot back."""
        if not days:
            return
        held = self._between(min(days), max(days)).select("event_date", "version")
        version = (held.agg(F.max("version")).first()[0] or 0) + 1
        gone = F.col("gone") if "gone" in rows.columns else F.lit(False)
        self._append(rows.withColumn("gone", gone), F.lit(version))
        self._gather(days)

    def _append(self, rows: DataFrame, version) -> None:
        (
            rows.withColumn("event_date", F.to_date("period"))
            .select(*self._names, version.cast("long").alias("version"), "gone", "event_date")
            .repartition(1)
            .sortWithinPartitions("event_date", "period")
            .write.mode("append")
            .partitionBy("event_date")
            .parquet(self._path)
        )

    def _gather(self, days: Collection[date]) -> None:
        """Write days of many files as one file each."""
        written = self._between(min(days), max(days)).where(F.col("event_date").isin(list(days)))
        files = written.select("event_date", F.col("_metadata.file_path").alias("file")).distinct()
        held: dict[date, list[str]] = {}
        for row in files.collect():
            held.setdefault(row.event_date, []).append(row.file)
        full = {day: names for day, names in held.items() if len(names) > FILES}
        if not full:
            return
        rows = self._counting(written.where(F.col("event_date").isin(list(full))))
        self._append(rows, F.col("version") + 1)
        # File names are given as in a URI.
        delete(self._spark, [unquote(name) for names in full.values() for name in names])
