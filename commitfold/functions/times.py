"""Time columns. Table times are ISO-8601 UTC strings with milliseconds."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_DAY = 86_400_000_000


def iso_millis(micros: Column) -> Column:
    """Microseconds since the epoch as `yyyy-MM-ddTHH:mm:ss.SSSZ`.

    Built from the day number and the time of day, so the session time zone
    has no say in the result.
    """
    of_day = F.pmod(micros, F.lit(_DAY))
    day = F.date_from_unix_date(((micros - of_day) / F.lit(_DAY)).cast("int"))
    ms = F.floor(of_day / F.lit(1000)).cast("long")

    def part(value: Column, width: int) -> Column:
        return F.lpad(F.floor(value).cast("string"), width, "0")

    return F.concat(
        day.cast("string"),
        F.lit("T"),
        part(ms / 3_600_000, 2),
        F.lit(":"),
        part((ms % 3_600_000) / 60_000, 2),
        F.lit(":"),
        part((ms % 60_000) / 1000, 2),
        F.lit("."),
        part(ms % 1000, 3),
        F.lit("Z"),
    )


def instant(text: Column) -> Column:
    """ISO text as a timestamp; null when it does not parse."""
    return F.try_to_timestamp(text)


def instant_micros(text: Column) -> Column:
    return F.unix_micros(instant(text))


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds between two ISO strings, with fraction."""
    return (instant_micros(end) - instant_micros(start)) / F.lit(1_000_000)


def top_coded(seconds: Column, cap: int = 900) -> Column:
    """Whole seconds truncated toward zero; anything above the cap is cap + 1."""
    whole = seconds.try_cast("int")
    return F.when(whole > cap, F.lit(cap + 1)).otherwise(whole)
