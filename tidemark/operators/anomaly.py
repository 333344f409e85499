"""Fifteen-minute metrics and interquartile alerts on them.

Only `slot_metrics` touches events. Everything after it works on one row per
slot (96 a day) and is written without self joins: each slot hands its values
to all the slots that will look back at it, and a ``groupBy`` on the receiving
slot collects a history of bounded size. So the events are aggregated once,
however many steps follow.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import replace
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.calendar import clock_slot, day_number, slot_number
from tidemark.functions.numbers import ratio, two_places
from tidemark.operators.activity import likes, views
from tidemark.params import Params

# The watched metrics, as named in messages and on charts.
ALERT_METRICS = ["Views", "Likes", "CTR", "Feed_users", "Mes_users", "Sent_messages"]

# The text of an alert.
ALERT_TEXT = "Метрика %s.\nТекущее значение %s. Отклонение более %s%%.\n"


def _slot(p: Params) -> Column:
    return F.window("time", f"{p.slot_minutes} minutes")


def slot_metrics(feed: DataFrame, messages: DataFrame, p: Params) -> DataFrame:
    """The six metrics of every slot that both services were used in.

    The distinct counts spread a busy slot over its users before they meet,
    and the join sees one row per slot from either side.
    """
    feed_slots = feed.groupBy(_slot(p).start.alias("period")).agg(
        views(), likes(), F.count_distinct("user_id").alias("feed_users")
    )
    message_slots = messages.groupBy(_slot(p).start.alias("period")).agg(
        F.count_distinct("user_id").alias("mes_users"),
        F.count("user_id").alias("sent_messages"),
    )
    return slot_columns(message_slots.join(feed_slots, "period"))


def slot_columns(slots: DataFrame) -> DataFrame:
    return slots.select(
        F.to_date("period").alias("event_date"),
        "period",
        F.date_format("period", "HH:mm").alias("hm"),
        "mes_users",
        "sent_messages",
        "views",
        "likes",
        ratio(F.col("likes"), F.col("views")).alias("ctr"),
        "feed_users",
    )


def _numbers(values: Iterable[int]) -> str:
    return f"array({', '.join(f'{value}L' for value in values)})"


def loaded_days(days: Iterable[date]) -> Column:
    """All the given days: what a single alert run looks back over."""
    return F.expr(_numbers(day_number(day) for day in days))


def following_days(p: Params) -> Column:
    """The days whose own alert runs load a slot's day."""
    backs = _numbers(p.reference_days)
    return F.expr(f"transform({backs}, back -> slot div {p.slots_per_day} + back)")


OWN = "slot = centre"
EARLIER = "slot <> centre"


def _look_backs(slots: DataFrame, days: Column, p: Params) -> DataFrame:
    """Hand every slot to itself and to the later slots it is history for.

    ``centre`` is a slot on one of ``days`` within ``neighbour_slots`` of the
    row's clock time, across midnight if need be. Centres without a row of
    their own are in the result, too; they lack the row with ``slot = centre``.
    """
    per_day = p.slots_per_day
    steps = _numbers(range(-p.neighbour_slots, p.neighbour_slots + 1))
    numbered = slots.select(
        "period",
        slot_number("period", p.slot_minutes).alias("slot"),
        clock_slot("period", p.slot_minutes).alias("clock"),
        *[F.col(m.lower()).cast("double").alias(m) for m in ALERT_METRICS],
    )
    reached = numbered.select(
        "period",
        "slot",
        *ALERT_METRICS,
        days.alias("days"),
        F.expr(f"array_distinct(transform({steps}, step -> pmod(clock + step, {per_day})))").alias(
            "near"
        ),
    )
    centres = f"flatten(transform(days, day -> transform(near, at -> day * {per_day} + at)))"
    return reached.select(
        "period",
        "slot",
        *ALERT_METRICS,
        F.expr(
            f"explode(concat(array(slot), filter({centres}, centre -> centre > slot)))"
        ).alias("centre"),
    )


def _of_own(column: str) -> Column:
    return F.expr(f"max(CASE WHEN {OWN} THEN {column} END)")


def _stats(metric: str, used: str) -> Column:
    """Sample size and exact quartiles of a metric over the rows that satisfy ``used``."""
    sample = f"CASE WHEN {used} THEN {metric} END"
    return F.expr(
        f"struct(count_if({used}) AS rows, count({sample}) AS defined,"
        f" percentile({sample}, array(0.25D, 0.75D)) AS quartiles)"
    )


def _per_metric(frame: DataFrame, *names: str) -> DataFrame:
    """One row per metric; ``names`` start the columns that exist for each of them."""
    shared = [c for c in frame.columns if not c.endswith(tuple(ALERT_METRICS))]
    rows = [
        f"struct('{m}' AS metric, " + ", ".join(f"{n}_{m} AS {n}" for n in names) + ")"
        for m in ALERT_METRICS
    ]
    return frame.select(*shared, F.expr(f"inline(array({', '.join(rows)}))"))


def _band(p: Params, factor: Column | None = None) -> list[Column]:
    """Band columns from ``stats``, by the factor of the parameters or another one.

    One undefined value in the sample leaves the whole band undefined, and so
    does an empty sample; ``percentile`` alone would skip the undefined value.
    """
    rows, quartiles = F.col("stats.rows"), F.col("stats.quartiles")
    usable = (rows > 0) & (rows == F.col("stats.defined"))
    q25, q75 = F.when(usable, quartiles[0]), F.when(usable, quartiles[1])
    iqr = q75 - q25
    a = F.lit(p.iqr_a) if factor is None else factor
    return [
        q25.alias("q25"),
        q75.alias("q75"),
        iqr.alias("iqr"),
        (q25 - a * iqr).alias("low"),
        (q75 + a * iqr).alias("up"),
    ]


def slot_history(slots: DataFrame, days: Column, p: Params) -> DataFrame:
    """Every slot and metric paired with the earlier values it is compared to."""
    target = _of_own("period").over(Window.partitionBy("centre"))
    return (
        _look_backs(slots, days, p)
        .withColumn("target", target)
        .where(f"target IS NOT NULL AND {EARLIER}")
        .select(
            F.col("target").alias("period"), F.col("period").alias("history_period"), *ALERT_METRICS
        )
        .unpivot(["period", "history_period"], ALERT_METRICS, "metric", "history_value")
    )


def iqr_bands(slots: DataFrame, days: Column, p: Params) -> DataFrame:
    """The band of every slot and metric, from its history."""
    by_centre = (
        _look_backs(slots, days, p)
        .groupBy("centre")
        .agg(
            _of_own("period").alias("period"),
            *[_of_own(m).alias(f"value_{m}") for m in ALERT_METRICS],
            *[_stats(m, EARLIER).alias(f"stats_{m}") for m in ALERT_METRICS],
        )
        .where(F.col("period").isNotNull())
    )
    return _per_metric(by_centre, "value", "stats").select(
        "period", "metric", "value", *_band(p)
    )


def _outside() -> Column:
    return (F.col("value") > F.col("up")) | (F.col("value") < F.col("low"))


def _flagged(bands: DataFrame) -> DataFrame:
    return bands.withColumns(
        {
            "is_undefined": F.col("value").isNull(),
            "is_anomaly": F.coalesce(_outside(), F.lit(False)),
        }
    )


def anomaly_flags(bands: DataFrame) -> DataFrame:
    """The newest slot's metrics, with those outside their band flagged."""
    newest = bands.orderBy(F.desc("period")).limit(len(ALERT_METRICS))
    return _flagged(newest)


def anomaly_backtest(slots: DataFrame, p: Params) -> DataFrame:
    """Flags for every slot as the alert run of its own day would set them."""
    return _flagged(iqr_bands(slots, following_days(p), p))


def backtest_grid(
    slots: DataFrame, p: Params, factors: Sequence[float], widths: Sequence[int]
) -> DataFrame:
    """What `anomaly_backtest` would flag for every factor and neighbourhood width.

    Per ``iqr_a, neighbour_slots, metric, event_date``: the ``slots`` of the day, those
    ``with_band`` and those ``flagged``. Slots meet their history of the greatest
    width once; a narrower one is the rings of it that lie closer on the clock.
    """
    per_day = p.slots_per_day
    ring = f"least(pmod(slot - centre, {per_day}), pmod(centre - slot, {per_day}))"
    by_centre = (
        _look_backs(slots, following_days(p), replace(p, neighbour_slots=max(widths)))
        .withColumn("ring", F.expr(ring))
        .groupBy("centre")
        .agg(
            _of_own("period").alias("period"),
            *[_of_own(m).alias(f"value_{m}") for m in ALERT_METRICS],
            *[
                _stats(m, f"{EARLIER} AND ring <= {width}").alias(f"within{width}_{m}")
                for width in widths
                for m in ALERT_METRICS
            ],
        )
        .where(F.col("period").isNotNull())
    )
    names = [f"within{width}" for width in widths]
    each = ", ".join(
        f"struct({width} AS neighbour_slots, {name} AS stats)"
        for width, name in zip(widths, names, strict=True)
    )
    rows = (
        _per_metric(by_centre, "value", *names)
        .select("period", "metric", "value", F.expr(f"inline(array({each}))"))
        .select("*", F.explode(F.array(*(F.lit(float(a)) for a in factors))).alias("iqr_a"))
    )
    low, up = _band(p, F.col("iqr_a"))[-2:]
    return (
        rows.select("period", "metric", "value", "neighbour_slots", "iqr_a", low, up)
        .groupBy("iqr_a", "neighbour_slots", "metric", F.to_date("period").alias("event_date"))
        .agg(
            F.count("*").alias("slots"),
            F.count("low").alias("with_band"),
            F.count_if(_outside()).alias("flagged"),
        )
    )


def alert_messages(bands: DataFrame, last_only: bool = True) -> DataFrame:
    """One message per flagged metric, from `iqr_bands`.

    The newest slot is still filling up when an alert is sent. It decides on
    the flag, but the message compares the two slots before it, in the
    columns ``reported_value`` and ``compared_value``. Likes without views make
    an infinite CTR: the value is NULL, but the text counts with it.
    """
    in_time = Window.partitionBy("metric").orderBy("period")
    likes_of_slot = F.max(F.when(F.col("metric") == "Likes", F.col("value"))).over(
        Window.partitionBy("period")
    )
    endless = (F.col("metric") == "CTR") & F.col("value").isNull() & (likes_of_slot > 0)
    rows = bands.withColumn("_endless", F.coalesce(endless, F.lit(False))).withColumns(
        {
            "reported_value": F.lag("value", 1).over(in_time),
            "compared_value": F.lag("value", 2).over(in_time),
            "_endless_now": F.lag("_endless", 1, False).over(in_time),
            "_endless_before": F.lag("_endless", 2, False).over(in_time),
        }
    )
    if last_only:
        rows = rows.orderBy(F.desc("period")).limit(len(ALERT_METRICS))
    now, before = F.col("reported_value"), F.col("compared_value")
    deviation = F.abs(1 - ratio(now, before))
    endless_now, endless_before = F.col("_endless_now"), F.col("_endless_before")
    percent = (
        F.when((before == 0) & (now > 0), F.lit("inf"))
        .when(endless_now & before.isNotNull(), F.lit("inf"))
        .when(endless_before & now.isNotNull(), F.lit("100.00"))
        .otherwise(F.coalesce(two_places(deviation * 100), F.lit("nan")))
    )
    undefined = F.when(endless_now, F.lit("inf")).otherwise(F.lit("nan"))
    value = F.coalesce(two_places(now), undefined)
    return (
        _flagged(rows)
        .where("is_anomaly")
        .select(
            "period",
            "metric",
            "value",
            "reported_value",
            "compared_value",
            deviation.alias("deviation"),
            F.format_string(ALERT_TEXT, "metric", value, percent).alias("message"),
        )
    )


def chart_bands(slots: DataFrame, days: Column, p: Params) -> DataFrame:
    """The newest slots of each metric with the bands a chart draws behind them.

    The newest slot keeps its own band. Each of the ``backfill_rows`` newest
    slots, as a centre, also gives a band to the newest slot before it in its
    clock neighbourhood, normally the slot just before, from the history
    before that one. Where centres give a band to the same slot, the oldest
    centre's stays. A slot nobody gives a band to has none.

    ``in_chart`` is false for a slot that gets a band across a gap but is
    older than the chart's rows.
    """
    latest = F.expr(f"max(CASE WHEN {EARLIER} THEN slot END)")
    latest_period = F.expr(f"max(CASE WHEN {EARLIER} THEN period END)")
    newest_first = Window.partitionBy("metric").orderBy(F.desc("centre"))
    rows = p.backfill_rows + 1
    by_centre = (
        _look_backs(slots, days, p)
        .withColumn("latest", latest.over(Window.partitionBy("centre")))
        .groupBy("centre")
        .agg(
            _of_own("period").alias("period"),
            F.max("latest").alias("target"),
            latest_period.alias("target_period"),
            *[_of_own(m).alias(f"value_{m}") for m in ALERT_METRICS],
            *[_stats(m, EARLIER).alias(f"own_{m}") for m in ALERT_METRICS],
            *[_stats(m, "slot < latest").alias(f"given_{m}") for m in ALERT_METRICS],
        )
        .where(F.col("period").isNotNull())
    )
    centres = (
        _per_metric(by_centre, "value", "own", "given")
        .withColumn("age", F.row_number().over(newest_first))
        .where(F.col("age") <= rows)
    )
    newest = F.col("age") == 1
    gives = (F.col("age") < rows) & F.col("target").isNotNull()
    itself = F.struct(
        F.col("centre").alias("slot"),
        F.col("period").alias("period"),
        F.col("value").alias("value"),
        F.lit(True).alias("in_chart"),
        F.when(newest, F.col("centre")).alias("centre"),
        F.when(newest, F.col("own")).alias("stats"),
    )
    gift = F.struct(
        F.col("target").alias("slot"),
        F.col("target_period").alias("period"),
        F.lit(None).cast("double").alias("value"),
        F.lit(False).alias("in_chart"),
        F.col("centre").alias("centre"),
        F.col("given").alias("stats"),
    )
    entries = F.when(gives, F.array(itself, gift)).otherwise(F.array(itself))
    return (
        centres.select("metric", F.explode(entries).alias("entry"))
        .select("metric", "entry.*")
        .groupBy("metric", "slot")
        .agg(
            F.max("period").alias("period"),
            F.max("value").alias("value"),
            F.bool_or("in_chart").alias("in_chart"),
            F.min("centre").alias("centre"),
            F.min_by("stats", "centre").alias("stats"),
        )
        .select("period", "metric", "value", "in_chart", "slot", "centre", *_band(p))
    )


def band_backfill(chart: DataFrame) -> DataFrame:
    """The raw bands of `chart_bands`: the slots that were given one.

    ``centre_lead`` tells how many slots later the centre lies: 0 for the
    newest slot, 1 for a slot followed directly by the next.
    """
    return chart.where(F.col("centre").isNotNull()).select(
        "period",
        "metric",
        (F.col("centre") - F.col("slot")).alias("centre_lead"),
        "q25",
        "q75",
        "iqr",
        "low",
        "up",
    )


def smooth_bands(bands: DataFrame, p: Params) -> DataFrame:
    """Centred moving mean of the bounds; it is partial at the edges and skips gaps.

    For drawing only: flags use the raw bounds.
    """
    half = p.smooth_rows // 2
    around = Window.partitionBy("metric").orderBy("period").rowsBetween(-half, half)
    return bands.withColumns({name: F.avg(name).over(around) for name in ("low", "up")})


def band_smoothing(chart: DataFrame, p: Params) -> DataFrame:
    """`chart_bands` with smoothed bounds, one row per charted slot and metric."""
    rows = chart.where("in_chart").select("period", "metric", "value", "low", "up")
    return smooth_bands(rows, p)


def alert_chart_series(chart: DataFrame, p: Params) -> DataFrame:
    """What a metric's chart draws: the last day of values and smoothed bounds."""
    newest_first = Window.partitionBy("metric").orderBy(F.desc("period"))
    name = F.col("metric")
    return (
        band_smoothing(chart, p)
        .withColumn("age", F.row_number().over(newest_first))
        .where(F.col("age") <= p.chart_rows)
        .select(
            "period",
            F.date_format("period", "HH:mm").alias("hm"),
            "metric",
            F.concat(F.upper(F.left(name, F.lit(1))), F.lower(F.expr("substring(metric, 2)"))).alias(
                "title"
            ),
            "value",
            "low",
            "up",
        )
        .orderBy("metric", "period")
    )
