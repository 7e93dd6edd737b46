"""Posting-date texts to dates; every rule that falls back to today takes `as_of`."""

from datetime import date

from pyspark.sql import Column, functions as F

from marketlens.functions.text import WS, strip, whole_number

EPOCH = date(1970, 1, 1)


def _iso(text: Column) -> Column:
    return F.regexp_extract(text, r"\d{4}-\d{2}-\d{2}", 0)


def _day_of_seconds(seconds: Column) -> Column:
    """UTC day of an epoch second count, whatever the session time zone."""
    days = F.floor(seconds / F.lit(86400)).try_cast("int")
    return F.date_add(F.lit(EPOCH), days)


def within_days(day: Column, as_of: date, days: int) -> Column:
    """day >= as_of - days; 0 days means no limit."""
    if days <= 0:
        return F.lit(True)
    return day >= F.date_sub(F.lit(as_of), days)


def age_in_days(day: Column, as_of: date) -> Column:
    return F.datediff(F.lit(as_of), day)


def board_date(text: Column, as_of: date) -> Column:
    """ISO date anywhere, 'Month DD, YYYY', 'N days ago', yesterday, else today."""
    today = F.lit(as_of)
    lowered = F.lower(text)
    iso = _iso(text)
    trimmed = strip(text)
    spelled = F.when(
        trimmed.rlike(rf"^[A-Za-z]+[{WS}]+\d{{1,2}},[{WS}]+\d{{4}}$"),
        F.to_date(
            F.try_to_timestamp(F.regexp_replace(trimmed, f"[{WS}]+", " "), F.lit("MMMM d, yyyy"))
        ),
    )
    ago = F.regexp_extract(lowered, rf"(\d++)[{WS}]+days?[{WS}]+ago", 1)
    return (
        F.when(F.coalesce(text, F.lit("")) == "", today)
        .when(iso != "", iso.try_cast("date"))
        .when(spelled.isNotNull(), spelled)
        .when(ago != "", F.date_sub(today, whole_number(ago)))
        .when(F.contains(lowered, F.lit("yesterday")), F.date_sub(today, 1))
        .otherwise(today)
    )


def millis_date(text: Column, as_of: date) -> Column:
    """ISO date anywhere, digits as epoch milliseconds, else today."""
    iso = _iso(text)
    millis = F.when(text.rlike(r"^\d+$"), text.try_cast("double"))
    return (
        F.when(iso != "", iso.try_cast("date"))
        .when(millis.isNotNull(), F.coalesce(_day_of_seconds(millis / F.lit(1000)), F.lit(as_of)))
        .otherwise(F.lit(as_of))
    )


def epoch_date(text: Column, as_of: date) -> Column:
    """ISO date anywhere, a number as epoch seconds (above 1e12: milliseconds), else today."""
    iso = _iso(text)
    number = F.when(F.translate(text, ".", "").rlike(r"^\d+$"), text.try_cast("double"))
    seconds = F.when(number > F.lit(1e12), number / F.lit(1000)).otherwise(number)
    return (
        F.when(iso != "", iso.try_cast("date"))
        .when(number.isNotNull(), F.coalesce(_day_of_seconds(seconds), F.lit(as_of)))
        .otherwise(F.lit(as_of))
    )


def prefix_date(text: Column, as_of: date) -> Column:
    """Text before 'T', or the first ten characters, as a date."""
    return (
        F.when(F.contains(text, F.lit("T")), F.substring_index(text, "T", 1).try_cast("date"))
        .when(F.length(text) >= 10, F.left(text, F.lit(10)).try_cast("date"))
        .otherwise(F.lit(as_of))
    )


# Zone names of RFC 822; others are read as UTC.
ZONES = {
    "EST": "-0500", "EDT": "-0400", "CST": "-0600", "CDT": "-0500",
    "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700",
}


def syndication_date(text: Column, as_of: date) -> Column:
    """RFC 822 ('Tue, 10 Feb 2026 08:00:00 GMT') or ISO 8601 time to its UTC day."""
    pattern = r"(\d{1,2}) ([A-Za-z]{3})[a-z]* (\d{4}) (\d{2}:\d{2}(?::\d{2})?) *([+-]\d{4}|[A-Za-z]*)"
    clock = F.regexp_extract(text, pattern, 4)
    zone = F.regexp_extract(text, pattern, 5)
    named = F.create_map(*[F.lit(part) for pair in ZONES.items() for part in pair])
    offset = F.when(zone.rlike(r"^[+-]\d{4}$"), zone).otherwise(
        F.coalesce(F.try_element_at(named, F.upper(zone)), F.lit("+0000"))
    )
    full_clock = F.when(F.length(clock) == 5, F.concat(clock, F.lit(":00"))).otherwise(clock)
    moment = F.concat_ws(
        " ",
        F.regexp_extract(text, pattern, 1),
        F.initcap(F.regexp_extract(text, pattern, 2)),
        F.regexp_extract(text, pattern, 3),
        full_clock,
        offset,
    )
    rfc = F.when(clock != "", F.try_to_timestamp(moment, F.lit("d MMM yyyy HH:mm:ss xx")))
    iso = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(text))
    seconds = F.unix_seconds(F.coalesce(rfc, iso))
    return F.coalesce(_day_of_seconds(seconds), F.lit(as_of))
