"""Small hand-written event tables."""

from __future__ import annotations

from datetime import datetime

from tidemark.sources.tables import FEED_ACTIONS, MESSAGE_ACTIONS


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def feed(spark, rows):
    """Rows of (user, time, action[, gender, age, os, country, source])."""
    default = (0, 20, "iOS", "Peru", "ads")
    full = [
        (r[0], at(r[1]), r[2], *r[3:], *default[len(r) - 3 :]) for r in rows
    ]
    return spark.createDataFrame(full, FEED_ACTIONS)


def messages(spark, rows):
    """Rows of (user, receiver, time[, gender, age, os, country, source])."""
    default = (0, 20, "iOS", "Peru", "ads")
    full = [
        (r[0], r[1], at(r[2]), *r[3:], *default[len(r) - 3 :]) for r in rows
    ]
    return spark.createDataFrame(full, MESSAGE_ACTIONS)


def dicts(frame, *order):
    rows = [r.asDict() for r in frame.collect()]
    return sorted(rows, key=lambda r: tuple(str(r[c]) for c in order or frame.columns))
