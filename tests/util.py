from __future__ import annotations

import datetime as dt
from decimal import Decimal


def norm(v):
    if isinstance(v, (float, Decimal)):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def rows_of(df):
    return [tuple(norm(x) for x in r) for r in df.collect()]
