"""Date math: round down to a unit, then add units."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Units of date math, each in the singular and the plural.
UNITS = {
    "YEAR": "YEAR", "YEARS": "YEAR", "MONTH": "MONTH", "MONTHS": "MONTH", "DAY": "DAY", "DAYS": "DAY", "DATE": "DAY",
    "HOUR": "HOUR", "HOURS": "HOUR", "MINUTE": "MINUTE", "MINUTES": "MINUTE", "SECOND": "SECOND", "SECONDS": "SECOND",
    "MILLI": "MILLISECOND", "MILLIS": "MILLISECOND", "MILLISECOND": "MILLISECOND", "MILLISECONDS": "MILLISECOND",
}
#: The shortest that a unit can be, in seconds.
LEAST_SECONDS = {"YEAR": 365 * 86400, "MONTH": 28 * 86400, "DAY": 86400, "HOUR": 3600, "MINUTE": 60, "SECOND": 1, "MILLISECOND": 0.001}
STEP = re.compile(r"/([A-Z]+)|([+-])(\d+)([A-Z]+)")


def add_units(c: Column, n: Column, unit: str) -> Column:
    parts = {"YEAR": "years", "MONTH": "months", "DAY": "days", "HOUR": "hours", "MINUTE": "mins", "SECOND": "secs"}
    if unit == "MILLISECOND":
        return c + F.make_interval(secs=n / 1000)
    return c + F.make_interval(**{parts[unit]: n})


def _steps(ops: str) -> list[tuple[str, int, str]]:
    """(sign, amount, unit) of every step; anything that is not date math is an error."""
    steps, at = [], 0
    for found in STEP.finditer(ops):
        unit = found.group(1) or found.group(4)
        if found.start() != at or unit not in UNITS:
            break
        steps.append((found.group(2) or "/", int(found.group(3) or 0), UNITS[unit]))
        at = found.end()
    if at != len(ops):
        raise ValueError(f"not date math: {ops[at:]!r} in {ops!r}")
    return steps


def date_math(c: Column, ops: str) -> Column:
    """``/YEAR-10YEARS``: steps applied left to right to a timestamp."""
    for sign, amount, unit in _steps(ops):
        c = F.date_trunc(unit, c) if sign == "/" else add_units(c, F.lit(amount if sign == "+" else -amount), unit)
    return c


def parse_step(gap: str) -> tuple[int, str]:
    """``+2MONTHS`` -> (2, "MONTH")."""
    steps = _steps(gap)
    if len(steps) != 1 or steps[0][0] != "+" or steps[0][1] < 1:
        raise ValueError(f"not one step forward: {gap!r}")
    return steps[0][1:]


def moment(spark: SparkSession, text: str, now: str | None = None) -> datetime:
    """A timestamp, or date math on NOW: the given ``now``, else that of the query."""
    if text.startswith("NOW"):
        start = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
        value = date_math(start, text.removeprefix("NOW"))
    else:
        value = F.lit(text).cast("timestamp")
    found = spark.range(1).select(value).first()[0]
    if found is None:
        raise ValueError(f"not a time: {text!r}")
    return found
