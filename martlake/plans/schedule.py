"""Run gates for the periodic loads, as plain functions of an explicit run date
(never the date the job happens to be planned on)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

# Days of month on which the slow-changing sources are refreshed.
CATEGORY_REFRESH_DAYS = (1,)
LISTING_REFRESH_DAYS = (1, 15)


def refresh_due(as_of: str | dt.date | dt.datetime, days: Iterable[int]) -> bool:
    """True when the run date ``as_of`` falls on one of the given days of month."""
    if isinstance(as_of, str):
        as_of = dt.date.fromisoformat(as_of[:10])
    return as_of.day in set(days)
