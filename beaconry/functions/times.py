"""Time expressions. All are built-in column expressions, evaluated in the session zone (UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c: Column | str) -> Column:
    """Text to timestamp; text that is not a time becomes NULL instead of failing the job."""
    return col(c).try_cast("timestamp")


def date_string(c: Column | str) -> Column:
    """The ``yyyy-MM-dd`` partition value of a timestamp."""
    return F.date_format(col(c), "yyyy-MM-dd")


def hour_start(c: Column | str) -> Column:
    return F.date_trunc("hour", col(c))


def day_start(c: Column | str) -> Column:
    """Midnight of a ``yyyy-MM-dd`` string, as a timestamp."""
    return F.to_timestamp(col(c), "yyyy-MM-dd")


def epoch_seconds(c: Column | str) -> Column:
    return F.unix_timestamp(col(c))


def seconds_before(c: Column | str, seconds: int) -> Column:
    return col(c) - F.expr(f"INTERVAL {int(seconds)} SECONDS")


def align_tick(epoch: Column | str, step: int = 5, strict: bool = True) -> Column:
    """Round epoch seconds up to the grid; ``strict`` moves a value on the grid to the next tick."""
    epoch = col(epoch)
    if strict:
        return epoch - F.pmod(epoch, F.lit(step)) + F.lit(step)
    return epoch + F.pmod(-epoch, F.lit(step))


def ceil_tick(ts: Column | str, step: int, shift: Column | int = 0) -> Column:
    """Epoch seconds of the end of the right-closed tile ``(tick - step, tick]`` holding ``ts + shift``.

    Works on whole microseconds, so a row exactly on a tick belongs to that tick.
    """
    shift = F.lit(shift) if isinstance(shift, int) else shift
    micros = F.unix_micros(col(ts)) + shift.cast("long") * F.lit(1_000_000)
    width = F.lit(step * 1_000_000)
    return ((micros + F.pmod(-micros, width)) / F.lit(1_000_000)).cast("long")


def monday_week(ts: Column | str) -> Column:
    """Week of the year where days before the first Monday are week 0."""
    ts = col(ts)
    return F.floor((F.dayofyear(ts) + F.lit(6) - F.weekday(ts)) / F.lit(7)).cast("int")


def calendar_parts(ts: Column | str) -> dict[str, Column]:
    ts = col(ts)
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "hour": F.hour(ts),
        "quarter": F.quarter(ts),
        "week": monday_week(ts),
        "day_name": F.date_format(ts, "EEEE"),
        "month_name": F.date_format(ts, "MMMM"),
        "weekend_flag": F.weekday(ts) >= F.lit(5),
    }
