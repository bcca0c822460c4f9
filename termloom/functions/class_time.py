"""Class-time notation: days with a clock range, with a start and minutes, or with periods of a timetable."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from termloom.functions.dates import DAYS

# First letters of English and Korean weekdays, Monday first.
_ENGLISH = ["mon", "tue", "wed", "thu", "fri", "sat", "sun"]
_KOREAN = "월화수목금토일"

_DAY = r"(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?|[월화수목금토일](?:요일)?)"
_CLOCK = r"(?P<{0}>\d{{1,2}}:\d{{2}})\s*(?P<{0}m>[ap]m)?"
_SLOT = re.compile(
    rf"(?<![\d가-힣a-z])(?P<days>{_DAY}(?:\s*[-~,/&]?\s*{_DAY})*)\s*"
    rf"(?:{_CLOCK.format('s')}\s*(?:[-~–]\s*{_CLOCK.format('e')}|\((?P<least>\d{{2,3}})\))|(?P<periods>\d{{1,2}}(?:\s*,\s*\d{{1,2}})*)\s*(?:교시)?(?![\d:]))",
    re.I,
)


def _day(token: str) -> int:
    return _KOREAN.index(token[0]) if token[0] in _KOREAN else _ENGLISH.index(token[:3].lower())


def _days(run: str) -> list[int]:
    at, out, last = 0, [], None
    for m in re.finditer(_DAY, run, re.I):
        d = _day(m[0])
        if last is not None and re.search(r"[-~]", run[at : m.start()]) and last < d:
            out += range(last + 1, d)
        out.append(d)
        last, at = d, m.end()
    return list(dict.fromkeys(out))


def _minute(clock: str, half: str | None) -> int:
    h, m = map(int, clock.split(":"))
    if half:
        h = h % 12 + (12 if half.lower() == "pm" else 0)
    return 60 * h + m


def parse(text: str | None, periods: dict[str, tuple[str, str]] | None) -> list[dict] | None:
    """Slots of a text, or None where nothing, or not everything with periods, can be told."""
    out = []
    for m in _SLOT.finditer(text or ""):
        if m["s"]:
            start = _minute(m["s"], m["sm"])
            end = _minute(m["e"], m["em"]) if m["e"] else start + int(m["least"])
        else:
            known = [(periods or {}).get(str(int(p))) for p in m["periods"].split(",")]
            if None in known:
                return None
            start, end = min(_minute(k[0], None) for k in known), max(_minute(k[1], None) for k in known)
        if not 0 <= start < end <= 24 * 60:
            return None
        out += [{"day": DAYS[d], "start": f"{start // 60:02}:{start % 60:02}", "end": f"{end // 60:02}:{end % 60:02}"} for d in _days(m["days"])]
    return out or None


def class_slots(text: Column, periods: dict[str, tuple[str, str]] | None = None) -> Column:
    """array<struct<day, start, end>>; periods, a small timetable, travels with the plan. Arrow batches."""

    def go(s: pd.Series) -> pd.Series:
        return s.map(lambda t: parse(t, periods))

    return F.pandas_udf(go, "array<struct<day:string,start:string,end:string>>")(text)
