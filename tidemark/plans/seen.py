"""When each user was first and last seen, kept between runs in buckets by user.

The users of a week are kept as rows (`KeptDays`) and made again only if events of
the week have changed. What changed is merged into a table of one row per user,
which lies in buckets by user, so the join leaves it where it is and shuffles
the users of the changed weeks alone. Every merge writes a new version and names it
only once it is whole; older versions may be deleted. If a week lost users or
is no longer there, as in a run for an earlier day, the table is built again from
the kept weeks, without any events.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, timedelta
from hashlib import sha256

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import cohorts
from tidemark.plans.kept import KeptDays, Sources

# A week's users, under the Sunday it starts on.
WEEK_USERS = T.StructType(
    [T.StructField("event_date", T.DateType()), T.StructField("user_id", T.LongType())]
)
MERGED = "version int, week date, source string"


def week_sources(sources: Sources, last: date) -> Sources:
    """What each week up to the day `last` consists of, from what its days do."""
    parts: dict[date, list[str]] = {}
    for day in sorted(day for day in sources if day <= last):
        sunday = day - timedelta(days=day.isoweekday() % 7)
        parts.setdefault(sunday, []).append(f"{day} {sources[day]}")
    return {week: sha256("\n".join(days).encode()).hexdigest() for week, days in parts.items()}


class SeenUsers:
    """The kept weeks and the table of users below `path`; the number of buckets is for good."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64) -> None:
        self._spark = spark
        self._path = path
        self._buckets = buckets
        self._weeks = KeptDays(spark, f"{path}/weeks", WEEK_USERS)

    def _merged(self) -> tuple[int, Sources]:
        """The newest version and what went into it."""
        try:
            rows = self._spark.read.schema(MERGED).parquet(f"{self._path}/merged")
            newest = rows.agg(F.max("version")).first()[0]
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0, {}
        found = rows.where(F.col("version") == newest).collect()
        return newest or 0, {row.week: row.source for row in found}

    def users(self, version: int) -> DataFrame:
        """``user_id, first_week, last_week`` of a version, known to lie in buckets."""
        folder = f"{self._path}/users/version={version}"
        name = f"tidemark_seen_{sha256(folder.encode()).hexdigest()[:24]}"
        self._spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (user_id BIGINT, first_week DATE, last_week DATE)"
            f" USING parquet CLUSTERED BY (user_id) SORTED BY (user_id)"
            f" INTO {self._buckets} BUCKETS LOCATION '{folder}'"
        )
        return self._spark.table(name)

    def merge(self, version: int, weeks: DataFrame) -> DataFrame:
        """The users of a version with those of some weeks (``event_date, user_id``)."""
        # Dealt like the buckets, so that the join needs no other order on either side.
        new = weeks.repartition(self._buckets, "user_id").groupBy("user_id").agg(
            F.min("event_date").alias("new_first"), F.max("event_date").alias("new_last")
        )
        if not version:
            return new.toDF("user_id", "first_week", "last_week")
        return (
            self.users(version)
            .join(new.withColumnRenamed("user_id", "new_id"), F.col("user_id") == F.col("new_id"), "full")
            .select(
                F.coalesce("user_id", "new_id").alias("user_id"),
                F.least("first_week", "new_first").alias("first_week"),
                F.greatest("last_week", "new_last").alias("last_week"),
            )
        )

    def _lost(self, before: Sources, now: Sources, rows: DataFrame) -> bool:
        """Whether a week that went into the table has lost a user since."""
        if set(before) - set(now):
            return True
        changed = {week: source for week, source in before.items() if now[week] != source}
        if not changed:
            return False
        if self._weeks.missing(changed):
            return True
        old = self._weeks.rows(changed, lambda weeks: rows)
        return not old.join(rows, WEEK_USERS.names, "left_anti").isEmpty()

    def update(
        self, sources: Sources, make: Callable[[Sequence[date]], DataFrame]
    ) -> tuple[DataFrame, DataFrame]:
        """The kept rows of all weeks, and the table of users for exactly those.

        `sources` tells what each week consists of (`week_sources`); `make` gives
        ``user_id, week`` of the events of some weeks, rows may repeat.
        """

        def users_of(weeks: Sequence[date]) -> DataFrame:
            rows = make(weeks).where("user_id is not null").distinct()
            return rows.select(F.col("week").alias("event_date"), "user_id")

        version, before = self._merged()
        rows = self._weeks.rows(sources, users_of)
        if before != sources:
            changed = [week for week, source in sources.items() if before.get(week) != source]
            if version and not self._lost(before, sources, rows):
                merged = self.merge(version, rows.where(F.col("event_date").isin(changed)))
            else:
                merged = self.merge(0, rows)
            version += 1
            self._write(merged, version, sources)
        if not version:
            return rows, self._spark.createDataFrame([], "user_id long, first_week date, last_week date")
        return rows, self.users(version)

    def _write(self, users: DataFrame, version: int, sources: Sources) -> None:
        name = f"tidemark_seen_{sha256(f'{self._path} {version} write'.encode()).hexdigest()[:24]}"
        self._spark.sql(f"DROP TABLE IF EXISTS {name}")
        # The rows of a task are those of one bucket already.
        (
            users.write.mode("overwrite")
            .bucketBy(self._buckets, "user_id")
            .sortBy("user_id")
            .option("path", f"{self._path}/users/version={version}")
            .saveAsTable(name)
        )
        self._spark.sql(f"DROP TABLE {name}")
        merged = [(version, week, source) for week, source in sources.items()]
        self._spark.createDataFrame(merged, MERGED).coalesce(1).write.mode("append").parquet(
            f"{self._path}/merged"
        )


def weekly_dynamics(weeks: DataFrame, users: DataFrame) -> DataFrame:
    """`cohorts.weekly_dynamics` from the kept weeks and the table of users."""
    zero = F.lit(0).cast("bigint")
    active = weeks.groupBy(F.col("event_date").alias("week")).agg(
        F.count("*").alias("active_users"), F.first(zero).alias("new_users")
    )
    new = users.groupBy(F.col("first_week").alias("week")).agg(
        F.first(zero).alias("active_users"), F.count("*").alias("new_users")
    )
    counts = active.unionByName(new).groupBy("week")
    return cohorts.dynamics(
        counts.agg(*(F.sum(c).alias(c) for c in ("active_users", "new_users")))
    )
