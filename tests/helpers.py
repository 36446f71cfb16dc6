"""Fixture builders (our own fixtures, see FIXTURES.md part B)."""

from __future__ import annotations

import datetime as dt

from ledgerguard.sources.adapters import prepare_card_frame
from ledgerguard.sources.schemas import TXN_SCHEMA

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def card_frame(spark, rows):
    """rows: (id, card, merchant, mcc, amount, ts, lat, lon, channel[, issue, fraud])."""
    full = []
    for r in rows:
        r = list(r)
        if len(r) == 9:
            r += [T0 - dt.timedelta(days=100), 0]
        full.append(tuple(r))
    return prepare_card_frame(spark.createDataFrame(full, TXN_SCHEMA))


def tiny_card(spark):
    m = dt.timedelta(minutes=1)
    return card_frame(spark, [
        (1, 1, 10, 5411, 20.0, T0, 40.0, -74.0, "CP"),
        (2, 1, 11, 5411, 25.0, T0 + 10 * m, 40.0, -74.0, "CP"),
        (3, 1, 12, 5812, 30.0, T0 + 30 * m, 40.0, -74.0, "CNP"),
        (4, 1, 13, 5999, 500.0, T0 + 120 * m, 34.0, -118.0, "CNP"),
    ])


def by_id(df, key="transaction_id"):
    return {r[key]: r for r in df.collect()}
