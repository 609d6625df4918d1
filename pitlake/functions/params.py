"""Checks of caller arguments, done before any plan is built."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timedelta

DateLike = str | date | datetime


def as_date(value: DateLike) -> date:
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    return date.fromisoformat(value)


def as_optional_date(value: DateLike | None) -> date | None:
    return None if value is None else as_date(value)


def date_range(start: DateLike | None, end: DateLike | None) -> tuple[date | None, date | None]:
    first, last = as_optional_date(start), as_optional_date(end)
    if first and last and first > last:
        raise ValueError(f"start {first} is after end {last}")
    return first, last


def required_range(what: str, start: DateLike | None, end: DateLike | None) -> tuple[date, date]:
    """A closed range whose end defaults to its start."""
    if start is None:
        raise ValueError(f"{what} needs a start date")
    first, last = date_range(start, start if end is None else end)
    return first, last


def code_list(codes: str | Iterable[str] | None, what: str = "symbols") -> list[str] | None:
    """None means every code, an empty list means no code at all."""
    if codes is None:
        return None
    listed = [codes] if isinstance(codes, str) else list(codes)
    if any(not isinstance(code, str) or code == "" for code in listed):
        raise ValueError(f"{what} must be non-empty strings")
    return listed


def index_code(code: str | None) -> str | None:
    if code is None:
        return None
    if not isinstance(code, str) or not code.strip():
        raise ValueError("index_code must be a non-empty string")
    return code.strip()


def distinct_index_codes(codes: str | Iterable[str] | None, default: tuple[str, ...]) -> list[str]:
    """Trimmed codes, each once, in the given order."""
    if codes is None:
        return list(default)
    listed = [codes] if isinstance(codes, str) else list(codes)
    if not listed or None in listed:
        raise ValueError("index_codes must be non-empty strings")
    return list(dict.fromkeys(index_code(code) for code in listed))


def adjustment(adjust: str, as_of: DateLike | None) -> tuple[str, date | None]:
    if adjust not in ("none", "qfq", "hfq"):
        raise ValueError("adjust must be 'none', 'qfq' or 'hfq'")
    if as_of is not None and adjust != "qfq":
        raise ValueError("as_of is only meaningful with adjust='qfq'")
    return adjust, as_optional_date(as_of)


def yesterday() -> date:
    """Default end of maintenance and audits: today's data may be half published."""
    return date.today() - timedelta(days=1)
