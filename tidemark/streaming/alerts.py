"""Alerts on every slot as it closes."""

from __future__ import annotations

from collections.abc import Callable, Collection
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.operators.anomaly import alert_messages, following_days, iqr_bands
from tidemark.params import Params
from tidemark.streaming.log import SlotLog
from tidemark.streaming.slots import SLOT_METRICS, trigger
from tidemark.streaming.state import state_on_disk

ALERT = T.StructType(
    [
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("reported_value", T.DoubleType()),
        T.StructField("compared_value", T.DoubleType()),
        T.StructField("deviation", T.DoubleType()),
        T.StructField("message", T.StringType()),
    ]
)
# A judged slot with its alerts, mostly none.
JUDGED = T.StructType(
    [T.StructField("period", T.TimestampType()), T.StructField("alerts", T.ArrayType(ALERT))]
)


def slot_log(spark: SparkSession, path: str) -> SlotLog:
    return SlotLog(spark, path, SLOT_METRICS)


def alert_log(spark: SparkSession, path: str) -> SlotLog:
    return SlotLog(spark, path, JUDGED)


def stored_slots(
    spark: SparkSession, path: str, since: date | None = None, until: date | None = None
) -> DataFrame:
    """The stored slots of the given days; folders of other days are not opened."""
    return slot_log(spark, path).rows(since, until)


def look_back(p: Params) -> timedelta:
    """How far before a slot those lie that it is judged by."""
    return timedelta(days=max(p.reference_days) + 1)


def judged(slots: DataFrame, p: Params) -> DataFrame:
    """``period, alerts`` of all the slots, as runs of their own days judge them."""
    told = (
        alert_messages(iqr_bands(slots, following_days(p), p), last_only=False)
        .groupBy("period")
        .agg(F.sort_array(F.collect_list(F.struct(*ALERT.names))).alias("alerts"))
    )
    none = F.array().cast(JUDGED["alerts"].dataType)
    return (
        slots.select("period")
        .join(told, "period", "left")
        .select("period", F.coalesce("alerts", none).alias("alerts"))
    )


def alert_writer(history: str, alerts: str, p: Params) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` step: store the batch's slots, then judge them.

    Slots and alerts go to a log each (`SlotLog`), so a batch that runs twice, or
    a stream that starts anew over an old history, replaces a slot by itself
    and leaves all others. Of the history, only the days that the new slots are
    compared to are listed and read; older ones may be deleted.
    """

    def write(slots: DataFrame, batch: int) -> None:
        spark = slots.sparkSession
        # A micro-batch closes a few slots of one row each, which are used three times.
        slots = slots.persist()
        try:
            days = _days(slots)
            if not days:
                return
            log = slot_log(spark, history)
            log.add(slots, days)
            known = log.rows(min(days) - look_back(p), max(days))
            fresh = judged(known, p).join(slots.select("period"), "period", "left_semi")
            alert_log(spark, alerts).add(fresh, days)
        finally:
            slots.unpersist()

    return write


def _days(slots: DataFrame) -> Collection[date]:
    return [row.event_date for row in slots.select("event_date").distinct().collect()]


def correct_slots(
    found: DataFrame, days: Collection[date], history: str, alerts: str, p: Params
) -> list[date]:
    """Replace closed slots whose events have changed, and every alert that follows from them.

    `found` are the slots of all events of the given whole days. A slot counts as
    closed up to the newest one of the history; later ones are the stream's. The
    changed slots go into the history, and all slots that look back at their days
    are judged again. Returns the days with changes. To be run between two
    micro-batches, and again if it did not end.
    """
    spark = found.sparkSession
    log, told = slot_log(spark, history), alert_log(spark, alerts)
    newest = log.rows().agg(F.max("period")).first()[0] if days else None
    if newest is None:
        return []
    names = SLOT_METRICS.names
    closed = found.withColumn("period", F.col("period").cast("timestamp")).select(*names)
    closed = closed.where(F.col("event_date").isin(list(days))).where(F.col("period") <= newest)
    held = log.rows(min(days), max(days)).where(F.col("event_date").isin(list(days)))
    changes = (
        closed.exceptAll(held.select(*names))
        .withColumn("gone", F.lit(False))
        .unionByName(held.join(closed, "period", "left_anti").withColumn("gone", F.lit(True)))
        .persist()
    )
    try:
        changed = _days(changes)
        log.add(changes, changed)
    finally:
        changes.unpersist()
    # Days whose slots were replaced by an earlier run that did not come to judge them
    # are not known as such, so the alerts of all days are compared.
    first, last = min(days), max(days) + look_back(p)
    now = judged(log.rows(first - look_back(p), last), p).where(F.to_date("period") >= F.lit(first))
    before = told.rows(first, last).select("period", F.col("alerts").alias("before"))
    other = (
        now.join(before, "period", "full")
        .where(~F.col("alerts").eqNullSafe(F.col("before")))
        .select("period", "alerts", F.col("alerts").isNull().alias("gone"))
        .withColumn("event_date", F.to_date("period"))
        .persist()
    )
    try:
        told.add(other, _days(other))
    finally:
        other.unpersist()
    return sorted(changed)


def run_alerts(
    slots: DataFrame,
    history: str,
    alerts: str,
    checkpoint: str,
    p: Params,
    every: str | None = None,
) -> StreamingQuery:
    """`every` is the time between micro-batches; without it, the stream ends with its input."""
    with state_on_disk(slots.sparkSession):
        return (
            slots.writeStream.outputMode("append")
            .foreachBatch(alert_writer(history, alerts, p))
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger(every))
            .start()
        )


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """The stored alerts, with ``period`` as in batch."""
    rows = alert_log(spark, path).rows()
    return rows.select(F.col("period").cast("timestamp_ntz").alias("period"), F.inline("alerts"))
