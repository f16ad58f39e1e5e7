"""Date tokens of the command line; control values, not data."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo


def resolve_on_dates(raw: str, tz: str = "America/New_York", now: datetime | None = None) -> list[date]:
    """Sorted distinct dates of a comma list of ``today``, ``tomorrow``, ISO dates and ``dd.mm.yyyy``.

    A ``now`` with a time zone is moved to ``tz``; one without is taken as that zone's. Raises ValueError for an empty list or an unknown token.
    """
    zone = ZoneInfo(tz)
    clock = now or datetime.now(zone)
    today = (clock.astimezone(zone) if clock.tzinfo else clock).date()
    found = set()
    for token in filter(None, (x.strip() for x in raw.split(","))):
        word = token.lower()
        if word in ("today", "tomorrow"):
            found.add(today + timedelta(days=word == "tomorrow"))
            continue
        for form in ("%Y-%m-%d", "%d.%m.%Y"):
            try:
                found.add(datetime.strptime(token, form).date())
                break
            except ValueError:
                continue
        else:
            raise ValueError(f"unknown date: {token!r}")
    if not found:
        raise ValueError("no date given")
    return sorted(found)


def id_list(raw: str | None) -> list[str] | None:
    """Parts of a comma list; none at all is None, which filters nothing."""
    return [x for x in (p.strip() for p in (raw or "").split(",")) if x] or None
