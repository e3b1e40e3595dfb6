"""Date parsing and zone-free epoch arithmetic on timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.text import clean_spaces

# Accepted layouts, tried in order.
ISO_LAYOUTS = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd", "yyyy/MM/dd", "M/d/yyyy", "MMMM d, yyyy"]
# With a fraction of a second, an offset from UTC, or both.
OFFSET_LAYOUTS = ["yyyy-MM-dd HH:mm:ss[.SSSSSS]XXX", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX"]
FRACTION_LAYOUTS = ["yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"]
SHORT_YEAR_LAYOUTS = ["M/d/yy"]
# Two-digit years from here on are of the century before.
SHORT_YEAR_PIVOT = 2069
DAY_FIRST_LAYOUTS = ["d/M/yyyy", "d.M.yyyy", "d-M-yyyy", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd"]


def parse_timestamp(c, layouts=None) -> Column:
    """First layout that fits, as timestamp without zone; NULL when none does."""
    text = clean_spaces(c)
    tries = [F.try_to_timestamp(text, F.lit(layout)) for layout in (layouts or ISO_LAYOUTS)]
    return F.coalesce(*tries).cast("timestamp_ntz")


def parse_lenient(c) -> Column:
    """As ``parse_timestamp``, and also fractions of a second, offsets (read as UTC) and two-digit years."""
    text = clean_spaces(c)
    read = lambda layout: F.try_to_timestamp(text, F.lit(layout))
    offsets = [F.to_utc_timestamp(read(layout), F.current_timezone()).cast("timestamp_ntz") for layout in OFFSET_LAYOUTS]
    years = F.coalesce(*map(read, SHORT_YEAR_LAYOUTS)).cast("timestamp_ntz")
    years = F.when(F.year(years) >= SHORT_YEAR_PIVOT, years - F.make_ym_interval(F.lit(100))).otherwise(years)
    return F.coalesce(parse_timestamp(c), *[read(layout).cast("timestamp_ntz") for layout in FRACTION_LAYOUTS], *offsets, years)


def parse_day_first(c) -> Column:
    """Day before month where both readings are possible."""
    return parse_timestamp(c, DAY_FIRST_LAYOUTS)


def epoch_micros(c) -> Column:
    """Microseconds since 1970 of a zone-free timestamp, independent of the session zone."""
    ts = (F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")
    days = F.datediff(ts, F.lit("1970-01-01").cast("date")).cast("long")
    clock = F.hour(ts) * 3600 + F.minute(ts) * 60
    seconds = F.extract(F.lit("SECOND"), ts)
    return (days * 86400 + clock) * 1_000_000 + (seconds * 1_000_000).cast("long")


def from_epoch_micros(c) -> Column:
    """Inverse of ``epoch_micros``."""
    micros = c.cast("long")
    seconds = (micros / F.lit(1_000_000)).cast("decimal(20,6)")
    base = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return base + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def age_days(later, earlier) -> Column:
    """Whole days between two timestamps, negative ages as 0, NULL kept."""
    days = F.floor((epoch_micros(later) - epoch_micros(earlier)) / F.lit(86_400_000_000))
    return F.when(days < 0, 0).otherwise(days).cast("long")


def age_years(days) -> Column:
    return (F.col(days) if isinstance(days, str) else days) / F.lit(365.25)


def calendar_parts(c, prefix: str) -> dict[str, Column]:
    ts = F.col(c) if isinstance(c, str) else c
    return {f"{prefix}_year": F.year(ts), f"{prefix}_month": F.month(ts), f"{prefix}_quarter": F.quarter(ts)}
