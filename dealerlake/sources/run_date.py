"""Which day a load runs for."""

from __future__ import annotations

from datetime import date, datetime


def resolve_run_date(scheduled: str, requested: str | None = None) -> date:
    """The requested day if one was given, else the scheduled one.

    An ISO date, or a full ISO timestamp of which the date counts. Anything else is a ValueError.
    """
    given = requested or scheduled
    return date.fromisoformat(given) if len(given) == 10 else datetime.fromisoformat(given).date()
