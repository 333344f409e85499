"""Bands and their back-fill against a direct pandas restatement on random series."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.test_traps import _slots
from tidemark.operators import anomaly
from tidemark.params import Params

P = Params(as_of=date(2024, 1, 30), backfill_rows=20)
DAYS = P.alert_days


def _near(a: datetime, b: datetime) -> bool:
    steps = ((a.hour - b.hour) * 60 + a.minute - b.minute) // 15 % 96
    return min(steps, 96 - steps) <= 3


def _quartiles(sample: pd.Series) -> tuple[float, float]:
    if sample.empty or sample.isna().any():
        return (np.nan, np.nan)
    return tuple(np.percentile(sample, [25, 75]))


def _expected_bands(series: pd.DataFrame) -> dict:
    return {
        row.period: _quartiles(
            series[[p < row.period and _near(p, row.period) for p in series.period]].value
        )
        for row in series.itertuples()
    }


def _expected_backfill(series: pd.DataFrame, rows: int) -> dict:
    bands = {}
    periods = list(series.period)
    everything = _expected_bands(series)
    bands[periods[-1]] = everything[periods[-1]]
    for centre in reversed(periods[-rows:]):
        matched = series[[p < centre and _near(p, centre) for p in series.period]]
        if len(matched):
            bands[matched.period.iloc[-1]] = _quartiles(matched.value.iloc[:-1])
    return bands


@st.composite
def series(draw):
    slots = draw(
        st.lists(
            st.tuples(
                st.integers(0, len(DAYS) - 1),
                st.sampled_from([0, 1, 2, 3, 5, 7, 8, 40, 41, 44, 92, 93, 94, 95]),
            ),
            min_size=2,
            max_size=60,
            unique=True,
        )
    )
    values = draw(
        st.lists(
            st.one_of(st.none(), st.integers(0, 50).map(float)),
            min_size=len(slots),
            max_size=len(slots),
        )
    )
    rows = []
    for (day, slot), value in zip(sorted(slots), values):
        when = datetime.combine(DAYS[day], datetime.min.time()) + timedelta(minutes=15 * slot)
        rows.append((when.isoformat(), value))
    return rows


def _compare(found: dict, expected: dict) -> None:
    assert set(found) == set(expected)
    for period, (q25, q75) in expected.items():
        row = found[period]
        if np.isnan(q25):
            assert row.q25 is None and row.low is None and row.up is None
        else:
            assert row.q25 == pytest.approx(q25) and row.q75 == pytest.approx(q75)
            assert row.low == pytest.approx(q25 - 2 * (q75 - q25))
            assert row.up == pytest.approx(q75 + 2 * (q75 - q25))
            assert row.low <= row.up


@settings(
    max_examples=8,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
@given(rows=series())
def test_bands_and_backfill(spark, rows):
    slots = _slots(spark, rows)
    days = anomaly.loaded_days(DAYS)
    plain = pd.DataFrame(
        {
            "period": [datetime.fromisoformat(t) for t, _ in rows],
            "value": pd.Series([v for _, v in rows], dtype="float64"),
        }
    )
    bands = anomaly.iqr_bands(slots, days, P).where("metric = 'Views'")
    _compare({r.period: r for r in bands.collect()}, _expected_bands(plain))
    chart = anomaly.chart_bands(slots, days, P)
    raw = anomaly.band_backfill(chart).where("metric = 'Views'")
    _compare(
        {r.period: r for r in raw.collect()}, _expected_backfill(plain, P.backfill_rows)
    )
