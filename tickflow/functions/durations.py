"""Duration texts such as ``30 seconds``, as ``window`` and ``withWatermark`` take them."""

from __future__ import annotations

import math
import re

_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}
_PART = re.compile(r"(\d+)\s*([a-z]+?)s?\b")


def micros(duration: str) -> int:
    """Length of a duration in microseconds; months have none and are refused."""
    text = re.sub(r"^interval\b", "", duration.strip().lower()).strip()
    parts = _PART.findall(text)
    if not parts or _PART.sub("", text).strip() or any(u not in _MICROS for _, u in parts):
        raise ValueError(f"not a fixed-length duration: {duration!r}")
    total = sum(int(n) * _MICROS[unit] for n, unit in parts)
    if total <= 0:
        raise ValueError(f"duration must be positive: {duration!r}")
    return total


def check_window(length: str, slide: str) -> None:
    """Refuse a slide beyond the length: its windows would leave trades out."""
    if micros(slide) > micros(length):
        raise ValueError(f"slide {slide!r} is longer than window {length!r}")


def common_pane(length: str, slide: str) -> str:
    """Largest tumbling window from which every (length, slide) window can be put together."""
    return f"{math.gcd(micros(length), micros(slide))} microseconds"
