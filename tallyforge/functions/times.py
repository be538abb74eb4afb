"""Date and time functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def printed_date(c: Column) -> Column:
    """A date printed as 2012-05-06, with or without a time, or as 06 May 2012; anything else is null."""
    t = F.trim(c)
    iso = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(t, 1, 10)).try_cast("date")
    return F.coalesce(iso, F.when(t.rlike(r"^\d{1,2} [A-Za-z]{3} \d{4}$"), F.try_to_timestamp(t, F.lit("d MMM yyyy"))).cast("date"))


def live_window(start: Column, end: Column) -> tuple[Column, Column]:
    """From 36 hours before the start to 48 hours after the end."""
    ntz = lambda c: c.cast("timestamp_ntz")
    return ntz(start) - F.expr("interval 36 hours"), ntz(end) + F.expr("interval 48 hours")


def event_state(start: Column, end: Column, now: Column) -> Column:
    """dormant, upcoming, live, cooling or archived at a time."""
    ntz = lambda c: c.cast("timestamp_ntz")
    opens, closes = live_window(start, end)
    return (
        F.when(now < ntz(start) - F.expr("interval 14 days"), "dormant").when(now < opens, "upcoming").when(now <= closes, "live")
        .when(now <= ntz(end) + F.expr("interval 30 days"), "cooling").otherwise("archived")
    )


def backoff(attempts: Column, first: int = 900, longest: int = 21_600) -> Column:
    """Seconds to wait after the n-th failure: doubling, capped."""
    return F.least(F.lit(float(longest)), first * F.pow(F.lit(2.0), F.greatest(F.lit(0), attempts - 1)))


def poll_interval(streak: Column, base: int = 3600, longest: int = 604_800) -> Column:
    """Seconds between polls, slower with every unchanged answer."""
    return F.least(F.lit(float(longest)), base * F.pow(F.lit(2.0), F.least(streak, F.lit(12))))


def seconds(ts: Column) -> Column:
    """Seconds since 1970 with fractions, of a time without zone."""
    return F.unix_micros(ts.cast("timestamp")) / 1e6


def date_range(c: Column) -> tuple[Column, Column]:
    """Start and end of a printed range: May 3 - 5, 2019; May 30 - Jun 2, 2019; Dec 30, 2019 - Jan 2, 2020; May 3, 2019. Impossible ones are null."""
    m = r"^([A-Za-z]{3})[a-z]* (\d{1,2})(?:, (\d{4}))?(?:\s*[-–]\s*(?:([A-Za-z]{3})[a-z]* )?(\d{1,2}))?, (\d{4})$"
    part = lambda i: F.regexp_extract(F.trim(c), m, i)
    either = lambda i, j: F.when(part(i) != "", part(i)).otherwise(part(j))
    day = lambda d, mon, y: F.when(part(6) != "", F.try_to_timestamp(F.concat_ws(" ", d, mon, y), F.lit("d MMM yyyy"))).cast("date")
    start, end = day(part(2), part(1), either(3, 6)), day(either(5, 2), either(4, 1), part(6))
    return F.when(start <= end, start), F.when(start <= end, end)


def retry_after(c: Column, now: Column) -> Column:
    """Seconds a Retry-After header asks for, as seconds or as an HTTP date, at least 60; null if unreadable."""
    secs = F.trim(c).try_cast("double")
    date = F.try_to_timestamp(F.regexp_extract(c, r"^\w{3}, (\d{2} \w{3} \d{4} \d{2}:\d{2}:\d{2}) GMT$", 1), F.lit("dd MMM yyyy HH:mm:ss"))
    asked = F.coalesce(secs, (F.unix_seconds(date) - F.unix_seconds(now)).cast("double"))
    return F.when(asked.isNotNull(), F.greatest(F.lit(60.0), asked))
