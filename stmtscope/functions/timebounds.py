"""Load-window bounds: local wall-clock times at a fixed UTC offset."""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone

_OFFSET = re.compile(r"([+-])(\d{2}):(\d{2})")
_SLASHED = re.compile(r"\d{1,2}/\d{1,2}/\d{4}( \d{1,2}:\d{2}(:\d{2})?)?")


def parse_offset(offset: str) -> timezone:
    """``+hh:mm`` / ``-hh:mm``; the sign applies to hours and minutes alike."""
    m = _OFFSET.fullmatch(offset)
    if not m or int(m[3]) > 59:
        raise ValueError(f"time zone offset must look like +hh:mm, got {offset!r}")
    minutes = int(m[2]) * 60 + int(m[3])
    return timezone(timedelta(minutes=-minutes if m[1] == "-" else minutes))


def _parse_local(value: str, day_first: bool | None) -> datetime:
    if _SLASHED.fullmatch(value):
        if day_first is None:
            raise ValueError(f"{value!r} is ambiguous: set day_first, or use yyyy-mm-dd")
        day = "%d/%m/%Y" if day_first else "%m/%d/%Y"
        clock = ["", " %H:%M", " %H:%M:%S"][value.count(":")]
        return datetime.strptime(value, day + clock)
    return datetime.fromisoformat(value)


def to_instant(value: str | datetime, offset: str = "+00:00", day_first: bool | None = None) -> datetime:
    """Instant (UTC) of a bound.  A naive time is local at ``offset``; an aware one is
    taken as it is.  A malformed bound raises ``ValueError``."""
    local = _parse_local(value, day_first) if isinstance(value, str) else value
    if local.tzinfo is None:
        local = local.replace(tzinfo=parse_offset(offset))
    return local.astimezone(timezone.utc)
