"""Dates and times. Zones are parameters, never the machine's default."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Output patterns.
DAY = "yyyy-MM-dd"
HOUR = "HH"
DAY_HOUR = "yyyy-MM-dd HH:00"
SECOND = "yyyy-MM-dd HH:mm:ss"
MONTH = "yyyy-MM"

MS_PER_DAY = 86_400_000


def local_time(epoch_ms: Column, zone: str = "UTC") -> Column:
    """Epoch milliseconds as wall-clock time in ``zone``.

    Works on zone-free timestamps, so the session's zone has no say.
    """
    utc = F.timestamp_add("MILLISECOND", epoch_ms.cast("bigint"),
                          F.lit("1970-01-01").cast("timestamp_ntz"))
    return utc if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def epoch_ms(ts: Column, zone: str = "UTC") -> Column:
    """Wall-clock time in ``zone`` as epoch milliseconds; finer digits drop.

    The parts of a zone-free interval are summed, because the difference
    functions would go through the session's zone and its clock changes.
    """
    wall = ts.cast("timestamp_ntz")
    utc = wall if zone == "UTC" else F.convert_timezone(F.lit(zone), F.lit("UTC"), wall)
    since = utc - F.lit("1970-01-01").cast("timestamp_ntz")

    def part(unit: str) -> Column:
        return F.extract(F.lit(unit), since).cast("bigint")

    whole = ((part("DAY") * 24 + part("HOUR")) * 60 + part("MINUTE")) * 60_000
    return whole + F.floor(F.extract(F.lit("SECOND"), since) * 1000).cast("bigint")


def format_ms(ms: Column, pattern: str = SECOND, zone: str = "UTC") -> Column:
    """Epoch milliseconds rendered with ``pattern``; fractions of a second drop."""
    return F.date_format(local_time(ms, zone), pattern)


def with_time_parts(df: DataFrame, ms_col: str, zone: str = "UTC",
                    day: str = "dt", hour: str = "hr") -> DataFrame:
    """Add the ``day`` and ``hour`` partition columns of an epoch-ms column."""
    ms = F.col(ms_col).cast("bigint")
    return df.withColumns({day: format_ms(ms, DAY, zone), hour: format_ms(ms, HOUR, zone)})


def with_processing_day(df: DataFrame, now_ms: int | None = None, zone: str = "UTC",
                        day: str = "dt") -> DataFrame:
    """Add the day the job runs, or the day of ``now_ms`` where a run must be repeatable."""
    now = F.unix_millis(F.current_timestamp()) if now_ms is None else F.lit(now_ms)
    return df.withColumn(day, format_ms(now, DAY, zone))


def reformat(text: Column, pattern_in: str | None = None, pattern_out: str = SECOND) -> Column:
    """Parse a datetime string and render it again; unreadable text gives null."""
    parsed = (F.try_to_timestamp(text, F.lit(pattern_in)) if pattern_in
              else F.try_to_timestamp(text))
    return F.date_format(parsed, pattern_out)


def time_of_day(ms_of_day: Column) -> Column:
    """A time of day as a timestamp on 1970-01-02, where time columns are stored."""
    return local_time(F.lit(MS_PER_DAY) + ms_of_day)


def whole_days(later_ms: Column, earlier_ms: Column) -> Column:
    """Full 24-hour days between two instants; not a difference of calendar days."""
    return F.floor((later_ms - earlier_ms) / F.lit(MS_PER_DAY))


def recent(df: DataFrame, ms_col: str, days: int, now_ms: int) -> DataFrame:
    """Rows at most ``days`` whole days old; rows without a time drop out.

    The age test is solved for the column, so it reaches the scan as a plain
    comparison.
    """
    oldest = now_ms - (days + 1) * MS_PER_DAY
    return df.where(F.col(ms_col) > F.lit(oldest))
