"""Rows of two result tables as sorted tuples of plain values."""

from __future__ import annotations

import datetime
import decimal
import math

import numpy as np
import pandas as pd


def plain(x):
    if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, (float, np.floating)) and math.isnan(x)):
        return None
    if isinstance(x, (bool, np.bool_)):
        return bool(x)
    if isinstance(x, (list, tuple, np.ndarray)):
        return tuple(plain(y) for y in x)
    if isinstance(x, dict):
        return tuple(sorted((k, plain(v)) for k, v in x.items()))
    if isinstance(x, (int, float, np.integer, np.floating, decimal.Decimal)):
        return round(float(x), 6) + 0.0
    if isinstance(x, (pd.Timestamp, datetime.datetime)):
        t = pd.Timestamp(x)
        return str(t.tz_convert("UTC").tz_localize(None) if t.tzinfo else t)
    if isinstance(x, datetime.date):
        return str(pd.Timestamp(x))
    return str(x)


def rows(frame: pd.DataFrame) -> tuple[list[str], list[tuple]]:
    names = sorted(frame.columns)
    found = [tuple(plain(x) for x in r) for r in frame[names].itertuples(index=False)]
    return names, sorted(found, key=repr)


def same(left: pd.DataFrame, right: pd.DataFrame) -> None:
    (a, x), (b, y) = rows(left), rows(right)
    assert a == b
    assert len(x) == len(y)
    assert x == y, [p for p in zip(x, y) if p[0] != p[1]][:3]
