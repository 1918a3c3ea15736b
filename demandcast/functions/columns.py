"""Column expressions used across operators: all built from JVM-side functions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from demandcast.constants import SEASON_OF_MONTH

STEPS = {
    "minute": "INTERVAL 1 MINUTE",
    "hour": "INTERVAL 1 HOUR",
    "day": "INTERVAL 1 DAY",
    "week": "INTERVAL 7 DAYS",
    "month": "INTERVAL 1 MONTH",
}


def col(c: str | Column) -> Column:
    """A column by name; names holding dots or percent signs are quoted."""
    return F.col(f"`{c}`") if isinstance(c, str) else c


def no_nan(c: str | Column) -> Column:
    """NaN means missing at every boundary with numpy; inside the engine missing is NULL."""
    c = col(c)
    return F.when(~F.isnan(c), c)


def parse_number(c: str | Column) -> Column:
    """Text to double, NULL when it is not a plain decimal number."""
    text = F.trim(col(c).cast("string"))
    plain = text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")
    return F.when(plain, text.try_cast("double"))


def parse_time(c: str | Column, fmt: str | None = None) -> Column:
    """Text to timestamp, NULL when it cannot be read."""
    c = col(c)
    return F.try_to_timestamp(c, F.lit(fmt)) if fmt else c.try_cast("timestamp")


def add_step(c: Column, step: str, n: int = 1) -> Column:
    return c + F.expr(STEPS[step]) * F.lit(n)


def floor_time(c: str | Column, step: str) -> Column:
    return F.date_trunc(step, col(c))


def ceil_time(c: str | Column, step: str) -> Column:
    low = floor_time(c, step)
    return F.when(low == col(c), low).otherwise(add_step(low, step))


def cyclic(c: Column, period: float) -> tuple[Column, Column]:
    angle = c * F.lit(2.0 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def season(month: Column) -> Column:
    pairs = [F.lit(x) for kv in SEASON_OF_MONTH.items() for x in kv]
    return F.element_at(F.create_map(*pairs), month)


def title_name(c: str | Column) -> Column:
    """Trim, collapse inner whitespace, capitalise each word."""
    return F.initcap(F.regexp_replace(F.trim(col(c)), r"\s+", " "))


def safe_name(c: str | Column) -> Column:
    """Keep letters, digits, dash and underscore; everything else becomes an underscore."""
    return F.regexp_replace(col(c), r"[^\p{L}\p{N}_-]", "_")


def shorten(c: str | Column, width: int, placeholder: str = "…") -> Column:
    """Cut a label at ``width`` characters on a word boundary, as chart labels do."""
    text = F.regexp_replace(F.trim(col(c)), r"\s+", " ")
    room = max(width - len(placeholder), 0)
    head = F.regexp_replace(F.substring(text, 1, room + 1), r"\s*\S*$", "")
    return F.when(F.length(text) <= width, text).otherwise(F.concat(head, F.lit(placeholder)))


def percent_change(new: Column, base: Column, otherwise: Column | None = None) -> Column:
    """Change in percent against a positive base; ``otherwise`` when there is none."""
    fallback = F.lit(None).cast("double") if otherwise is None else otherwise
    return F.when(base > 0, (new - base) / base * 100.0).otherwise(fallback)


def local_hour_utc(c: str | Column, zone: str) -> Column:
    """Naive local wall-clock time to the UTC instant of its hour.

    A time skipped by the spring change moves forward; a time that occurs twice in autumn is
    ambiguous and gives NULL. It is ambiguous when another instant within the shift distance
    shows the same wall clock.
    """
    c = col(c)
    utc = F.to_utc_timestamp(c, zone)
    hour = F.expr("INTERVAL 1 HOUR")
    twice = (F.from_utc_timestamp(utc + hour, zone) == c) | (F.from_utc_timestamp(utc - hour, zone) == c)
    return F.when(~twice, F.date_trunc("hour", utc))


def local_date(utc: str | Column, zone: str) -> Column:
    return F.to_date(F.from_utc_timestamp(col(utc), zone))


def is_dst(utc: str | Column, zone: str) -> Column:
    """True while the zone runs ahead of the smaller of its January and July offsets of that year."""
    utc = col(utc)

    def offset(at: Column) -> Column:
        return F.unix_seconds(F.from_utc_timestamp(at, zone)) - F.unix_seconds(at)

    january = F.date_trunc("year", utc)
    july = F.timestamp_add("MONTH", F.lit(6), january)
    return offset(utc) > F.least(offset(january), offset(july))
