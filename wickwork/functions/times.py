"""Time functions. India has one fixed offset, so wall-clock parts are integer arithmetic on the instant
in microseconds and never depend on the session's time zone."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

IST = "Asia/Kolkata"
IST_MICROS = 19_800_000_000
SECOND, MINUTE, DAY = 1_000_000, 60_000_000, 86_400_000_000
# The resolutions a vendor serves, in minutes; a daily bar has none.
RESOLUTIONS = {"1": 1, "2": 2, "3": 3, "5": 5, "10": 10, "15": 15, "20": 20, "30": 30, "60": 60, "120": 120, "240": 240, "1D": None}


class NaiveTimestampError(ValueError):
    """A time without a zone where an instant is needed."""


def epoch_to_instant(epoch: Column) -> Column:
    """Epoch seconds, whole or fractional, to an instant."""
    return F.timestamp_seconds(epoch)


def ntz_micros(ts: Column) -> Column:
    """Microseconds from 1970 on the clock of a time without zone."""
    since = ts - F.lit("1970-01-01").cast("timestamp_ntz")
    part = lambda name: F.extract(F.lit(name), since).cast("decimal(20,6)")
    seconds = part("DAY") * 86400 + part("HOUR") * 3600 + part("MINUTE") * 60 + part("SECOND")
    return (seconds * SECOND).cast("long")


def declared(ts: Column, offset_micros: int = 0) -> Column:
    """A time without zone as an instant, its zone declared by its offset from UTC."""
    return F.timestamp_micros(ntz_micros(ts) - offset_micros)


def require_instant(kind: T.DataType, name: str = "ts") -> None:
    if not isinstance(kind, T.TimestampType):
        raise NaiveTimestampError(f"{name} is {kind.simpleString()}; declare its zone first")


def wall_micros(ts: Column) -> Column:
    return F.unix_micros(ts) + IST_MICROS


def ist_day(ts: Column) -> Column:
    """Days since 1970 on the Indian calendar."""
    return F.floor(wall_micros(ts) / DAY).cast("int")


def ist_date(ts: Column) -> Column:
    return F.date_add(F.lit("1970-01-01").cast("date"), ist_day(ts))


def ist_second(ts: Column) -> Column:
    return F.pmod(F.floor(wall_micros(ts) / SECOND), F.lit(60))


def ist_time_micros(ts: Column) -> Column:
    return F.pmod(wall_micros(ts), F.lit(DAY))


def time_micros(t: datetime.time) -> int:
    return (t.hour * 3600 + t.minute * 60 + t.second) * SECOND + t.microsecond


def ist_instant(year: Column, month: Column, day: Column, hour: Column, minute: Column, second: Column) -> Column:
    return F.make_timestamp(year, month, day, hour, minute, second, F.lit(IST))


def iso(ts: Column) -> Column:
    """ISO 8601 with the Indian offset; a fraction only where there is one."""
    wall = wall_micros(ts)
    day = F.date_format(ist_date(ts), "yyyy-MM-dd")
    two = lambda x: F.lpad(x.cast("long").cast("string"), 2, "0")
    of_day = F.pmod(wall, F.lit(DAY))
    micros = F.pmod(wall, F.lit(SECOND))
    clock = F.concat_ws(":", two(F.floor(of_day / (60 * MINUTE))), two(F.floor(of_day / MINUTE) % 60), two(F.floor(of_day / SECOND) % 60))
    fraction = F.when(micros == 0, "").otherwise(F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0")))
    return F.when(ts.isNotNull(), F.concat(day, F.lit("T"), clock, fraction, F.lit("+05:30")))


def api_date(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def parse_date(text: Column) -> Column:
    """Null where the text isn't a date of the form yyyy-MM-dd."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date"))


def resolution_minutes(resolution: Column) -> Column:
    known = F.create_map(*(F.lit(x) for pair in RESOLUTIONS.items() if pair[1] for x in pair))
    return F.try_element_at(known, resolution)


def midpoint(a: Column, b: Column) -> Column:
    return F.date_add(a, F.floor(F.datediff(b, a) / 2).cast("int"))
