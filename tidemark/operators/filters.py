"""The date windows the jobs read, all relative to ``Params.as_of``."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.functions.calendar import on_days, runs
from tidemark.params import Params


def on_yesterday(frame: DataFrame, p: Params) -> DataFrame:
    return on_days(frame, [(p.yesterday, p.yesterday)])


def in_kpi_days(frame: DataFrame, p: Params) -> DataFrame:
    """The full days before the run, without the run's own day."""
    return on_days(frame, [(p.day(p.kpi_days), p.yesterday)])


def in_report_days(frame: DataFrame, p: Params) -> DataFrame:
    """From ``report_days`` back up to the run's own, still incomplete day."""
    return on_days(frame, [(p.day(p.report_days), p.as_of)])


def in_alert_days(frame: DataFrame, p: Params) -> DataFrame:
    """Today, yesterday and the same two days one and two weeks earlier."""
    return on_days(frame, runs(p.alert_days))
