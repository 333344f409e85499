"""Per-day rows derived from the event tables, kept between runs.

Kept rows of a day are used only if they were made from exactly the files that
the day's events now consist of. A day that was never kept, was missed, got
late rows or was loaded anew is therefore made again, and a run for an earlier
day finds whole days and takes none away. What a day consists of is told by its
table's loads (`sources.loads`); only for tables without them it is read off the
list of their files.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Sequence
from datetime import date
from hashlib import sha256

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY = re.compile(r"/event_date=(\d{4}-\d{2}-\d{2})/")

Sources = dict[date, str]


def day_sources(*events: DataFrame) -> Sources | None:
    """What each day's events consist of, as a digest of their files' names.

    For tables without loads. None if a table is not laid out by day; nothing can be kept then. Files of
    event tables are written once and never changed, so their names tell.
    """
    files = defaultdict(list)
    for number, frame in enumerate(events):
        names = frame.inputFiles()
        days = [DAY.search(name) for name in names]
        if not names or not all(days):
            return None
        for name, day in zip(names, days, strict=True):
            files[date.fromisoformat(day[1])].append(f"{number} {name}")
    return {
        day: sha256("\n".join([str(day), *sorted(names)]).encode()).hexdigest()
        for day, names in files.items()
    }


class KeptDays:
    """Rows of one schema, which starts with ``event_date``, in a folder per day and source.

    Each folder also holds a row that only marks it as complete, so a day
    without rows counts as made. Folders of outdated sources are not read and
    may be deleted.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType) -> None:
        self._spark = spark
        self._path = path
        self._names = schema.names
        marks = [
            T.StructField("kept_mark", T.BooleanType()), T.StructField("kept_from", T.StringType()),
        ]
        self._schema = T.StructType([*schema, *marks])

    def _stored(self) -> DataFrame | None:
        try:
            return self._spark.read.schema(self._schema).parquet(self._path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def missing(self, sources: Sources) -> list[date]:
        """The days that are not kept as they now are."""
        stored = self._stored()
        made = set()
        if stored is not None and sources:
            marks = stored.where("kept_mark").where(F.col("kept_from").isin(list(sources.values())))
            made = {row["kept_from"] for row in marks.select("kept_from").collect()}
        return sorted(day for day, source in sources.items() if source not in made)

    def rows(self, sources: Sources, make: Callable[[Sequence[date]], DataFrame]) -> DataFrame:
        """The rows of all days in `sources`; `make` gives those of the days not kept."""
        missing = self.missing(sources)
        if missing:
            self.keep({day: sources[day] for day in missing}, make(missing))
        stored = self._stored()
        if stored is None:
            return self._spark.createDataFrame([], self._schema).select(*self._names)
        kept = F.col("kept_from").isin(list(sources.values()))
        return stored.where(kept).where("not kept_mark").select(*self._names)

    def keep(self, sources: Sources, rows: DataFrame) -> None:
        """Keep the rows as those of the days."""
        days = self._spark.createDataFrame(
            list(sources.items()), "event_date date, kept_from string"
        )
        marks = days.select(
            "event_date",
            *[
                F.lit(None).cast(field.dataType).alias(field.name)
                for field in self._schema
                if field.name not in ("event_date", "kept_mark", "kept_from")
            ],
            F.lit(True).alias("kept_mark"),
            "kept_from",
        )
        own = rows.select(*self._names).withColumn("kept_mark", F.lit(False)).join(days, "event_date")
        (
            own.unionByName(marks)
            .hint("rebalance", "event_date")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("event_date", "kept_from")
            .parquet(self._path)
        )
