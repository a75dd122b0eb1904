"""Calendar and market-session columns.

All timestamps are TIMESTAMP_NTZ. Trades hold UTC wall clock, bars hold market
wall clock; a zone is always an argument and never the session's.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barlake.schemas import HOURLY_INTERVALS, MINUTE_INTERVALS

# Trading hours per feed venue, Europe/Berlin wall clock.
VENUE_HOURS = {
    "DETR": ("07:30", "18:30"),
    "DFRA": ("07:30", "18:30"),
    "DGAT": ("07:30", "18:30"),
    "DEUR": ("07:30", "18:30"),
}
VENUE_ZONE = "Europe/Berlin"

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_zone(ts: Column | str, zone: str, source: str = "UTC") -> Column:
    return F.convert_timezone(F.lit(source), F.lit(zone), col(ts))


def minute_floor(ts: Column | str) -> Column:
    t = col(ts)
    return F.make_timestamp_ntz(
        F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.minute(t), F.lit(0)
    )


def hour_floor(ts: Column | str) -> Column:
    t = col(ts)
    return F.make_timestamp_ntz(
        F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.lit(0), F.lit(0)
    )


def day_start(ts: Column | str) -> Column:
    return F.to_date(col(ts)).cast("timestamp_ntz")


def hhmm(ts: Column | str) -> Column:
    """Hour and minute as text; needs a zoneless timestamp, whose text is session-independent."""
    return F.substring(col(ts).cast("string"), 12, 5)


def minute_of_day(ts: Column | str) -> Column:
    t = col(ts)
    return F.hour(t) * 60 + F.minute(t)


def micros_of_day(ts: Column | str) -> Column:
    t = col(ts)
    return F.timestamp_diff("MICROSECOND", day_start(t), t)


def epoch_micros(ts: Column | str) -> Column:
    return F.timestamp_diff("MICROSECOND", F.expr(EPOCH), col(ts))


def seconds_between(start: Column, end: Column) -> Column:
    return (F.timestamp_diff("MICROSECOND", start, end) / F.lit(1_000_000)).cast("double")


def iso_utc(text: Column | str) -> Column:
    """ISO-8601 text to UTC wall clock; text without a zone is taken as UTC."""
    t = F.trim(col(text))
    zoned = F.when(t.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), t).otherwise(F.concat(t, F.lit("Z")))
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.try_to_timestamp(zoned).cast("timestamp_ntz"))


def try_date(text: Column | str) -> Column:
    """Strict YYYY-MM-DD text to DATE, null when malformed."""
    t = col(text)
    return F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), t.try_cast("date"))


def parse_active_hours(text: Column | str) -> Column:
    """``HH:MM-HH:MM`` (spaces allowed) to a struct of normalised open and close.

    Either field is null when the text is not a valid pair of times.
    """
    t = col(text)
    pattern = r"^\s*(\d{1,2}):(\d{1,2})\s*-\s*(\d{1,2}):(\d{1,2})\s*$"
    part = [F.regexp_extract(t, pattern, i).try_cast("int") for i in range(1, 5)]
    valid = (
        t.rlike(pattern)
        & part[0].between(0, 23) & part[1].between(0, 59)
        & part[2].between(0, 23) & part[3].between(0, 59)
    )
    return F.struct(
        F.when(valid, F.format_string("%02d:%02d", part[0], part[1])).alias("open"),
        F.when(valid, F.format_string("%02d:%02d", part[2], part[3])).alias("close"),
    )


def _clock_micros(clock: Column) -> Column:
    part = F.split(clock, ":")
    return (part[0].cast("bigint") * 60 + part[1].cast("bigint")) * 60_000_000


def within_clock(local: Column, opens: Column, closes: Column) -> Column:
    """Local wall clock inside [open, close], both ends included; overnight when close < open."""
    now, start, end = micros_of_day(local), _clock_micros(opens), _clock_micros(closes)
    return F.when(start <= end, now.between(start, end)).otherwise((now >= start) | (now <= end))


def is_within_hours(ts: Column | str, opens: str, closes: str, zone: str) -> Column:
    return within_clock(to_zone(ts, zone), F.lit(opens), F.lit(closes))


def in_venue_minutes(ts: Column | str, venue: Column | str) -> Column:
    """Minute of the trade is within its venue's hours; unknown venue or null time is kept."""
    clock = hhmm(to_zone(ts, VENUE_ZONE))
    inside = F.lit(None).cast("boolean")
    for code, (start, end) in VENUE_HOURS.items():
        inside = F.when(col(venue) == code, clock.between(start, end)).otherwise(inside)
    return F.coalesce(inside, F.lit(True))


def session_position(ts: Column | str, opens: str, closes: str, zone: str) -> Column:
    """Struct of is_open, seconds_until_open, next_open (UTC), seconds_until_close.

    The window in force is today's if it holds the instant, else yesterday's
    when that one does (overnight session), else today's. Before the open the
    seconds until close still count down to today's close; after it they are 0.
    """
    now = col(ts)
    today = F.to_date(to_zone(now, zone))
    open_minutes, close_minutes = (
        int(c.split(":")[0]) * 60 + int(c.split(":")[1]) for c in (opens, closes)
    )
    overnight = close_minutes < open_minutes

    def instant(day: Column, minutes: int) -> Column:
        local = F.timestamp_add("MINUTE", F.lit(minutes), day.cast("timestamp_ntz"))
        return F.convert_timezone(F.lit(zone), F.lit("UTC"), local)

    def window(day: Column) -> tuple[Column, Column]:
        last = F.date_add(day, 1) if overnight else day
        return instant(day, open_minutes), instant(last, close_minutes)

    open0, close0 = window(today)
    open1, close1 = window(F.date_sub(today, 1))
    use_yesterday = ~now.between(open0, close0) & now.between(open1, close1)
    start = F.when(use_yesterday, open1).otherwise(open0)
    end = F.when(use_yesterday, close1).otherwise(close0)
    is_open = now.between(start, end)
    upcoming = F.when(now < start, start).otherwise(instant(F.date_add(today, 1), open_minutes))
    return F.struct(
        is_open.alias("is_open"),
        F.when(is_open, F.lit(0.0)).otherwise(seconds_between(now, upcoming)).alias("seconds_until_open"),
        F.when(is_open, now).otherwise(upcoming).alias("next_open"),
        F.when(now > end, F.lit(0.0)).otherwise(seconds_between(now, end)).alias("seconds_until_close"),
    )


def business_days_between(start: Column | str, end: Column | str) -> Column:
    """Weekdays in [start, end], less one when start itself is a weekday.

    An end before the start counts zero weekdays, so the result can be -1.
    Closed form: whole weeks hold five weekdays, the rest is at most six days.
    """
    s, e = F.to_date(col(start)), F.to_date(col(end))
    # whole 24 h periods, as timestamps carry a time of day
    span = F.floor(
        F.timestamp_diff("MICROSECOND", col(start).cast("timestamp_ntz"), col(end).cast("timestamp_ntz"))
        / F.lit(86_400_000_000)
    ).cast("int")
    days = F.greatest(span + 1, F.lit(0))
    first = F.weekday(s)
    rest = days % 7
    # weekend days among `rest` consecutive days starting on weekday `first`
    saturday = F.when((first <= 5) & (first + rest > 5), 1).when((first == 6) & (rest > 6), 1).otherwise(0)
    sunday = F.when((first <= 6) & (first + rest > 6), 1).otherwise(0)
    weekdays = F.floor(days / 7).cast("int") * 5 + rest - saturday - sunday
    return (weekdays - F.when(first < 5, 1).otherwise(0)).cast("int")


def reference_day(ts: Column | str) -> Column:
    """The same weekday, or the Friday before a weekend, at 17:00."""
    day = F.to_date(col(ts))
    back = F.greatest(F.weekday(day) - 4, F.lit(0))
    return F.timestamp_add("HOUR", F.lit(17), F.date_sub(day, back).cast("timestamp_ntz"))


def _whole_days(start: Column, end: Column) -> Column:
    micros = F.timestamp_diff("MICROSECOND", start, end)
    return F.floor(micros / F.lit(86_400_000_000))


def clamp_fetch_window(start: Column, end: Column, interval: Column, today: Column) -> Column:
    """Struct of the start and end a vendor request may ask for.

    Hourly bars reach back 729 days, minute bars 7. An hourly span of 729 days
    or more comes back empty (start = end).
    """
    hourly, minutely = interval.isin(HOURLY_INTERVALS), interval.isin(MINUTE_INTERVALS)

    def days_back(days: int, hour: int) -> Column:
        day = F.date_sub(F.to_date(today), days).cast("timestamp_ntz")
        return F.timestamp_add("HOUR", F.lit(hour), day)

    h_start = F.when(_whole_days(start, today) >= 729, days_back(729, 8)).otherwise(start)
    h_end = F.when(_whole_days(end, today) >= 729, today).otherwise(end)
    h_start = F.when(_whole_days(h_start, h_end) >= 729, h_end).otherwise(h_start)
    m_start = F.when(_whole_days(start, today) >= 7, days_back(7, 0)).otherwise(start)
    m_end = F.when(_whole_days(end, today) >= 7, today).otherwise(end)
    return F.struct(
        F.when(hourly, h_start).when(minutely, m_start).otherwise(start).alias("start"),
        F.when(hourly, h_end).when(minutely, m_end).otherwise(end).alias("end"),
    )


def full_history_period(interval: Column) -> Column:
    """Vendor period to ask for when nothing is stored yet."""
    return (
        F.when(interval.isin(HOURLY_INTERVALS), "730d")
        .when(interval.isin(MINUTE_INTERVALS), "7d")
        .otherwise("max")
    )
