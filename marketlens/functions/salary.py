"""Salary text to an annual range."""

from pyspark.sql import Column, functions as F

from marketlens.fixed_values import HOURS_PER_YEAR, MIN_ANNUAL_SALARY, PAY_PERIODS_PER_YEAR
from marketlens.functions.text import computed_once, contains_any

# Markers of hourly and bi-weekly pay.
HOURLY = ["hourly", "per hour", "/hr", "/ hour"]
BIWEEKLY = ["biweekly", "bi-weekly"]


def _plain(text: Column) -> Column:
    return F.translate(text, ",$ ", "")


def _annual(first: Column, second: Column, factor: Column, hourly: Column) -> Column:
    """struct(salary_min, salary_max, malformed) from the two number texts of a range.

    A number text such as "1.2.3" makes the row malformed, as does a value beyond INT.
    """

    def ends(said: Column) -> Column:
        a, b = said["first"].try_cast("double"), said["second"].try_cast("double")
        return F.struct(
            (F.least(a, b) * factor).alias("low"),
            (F.greatest(a, b) * factor).alias("high"),
            (a.isNull() | b.isNull()).alias("unread"),
        )

    def reading(found: Column) -> Column:
        low, high = found["low"].try_cast("int"), found["high"].try_cast("int")
        bad = found["unread"] | low.isNull() | high.isNull()
        usable = ~bad & (hourly | (high >= MIN_ANNUAL_SALARY))
        return F.struct(
            F.when(usable, low).alias("salary_min"),
            F.when(usable, high).alias("salary_max"),
            bad.alias("malformed"),
        )

    nothing = F.struct(
        F.lit(None).cast("int").alias("salary_min"),
        F.lit(None).cast("int").alias("salary_max"),
        F.lit(False).alias("malformed"),
    )
    said = F.struct(first.alias("first"), second.alias("second"))
    return computed_once(
        said,
        lambda t: F.when(t["first"] != "", computed_once(ends(t), reading)).otherwise(nothing),
    )


def board_salary(text: Column) -> Column:
    """Board listing text: range or single number, hourly and bi-weekly made annual.

    Any "not" in the text means no salary.
    """
    lowered = F.lower(text)
    hourly = contains_any(lowered, HOURLY)
    factor = (
        F.when(hourly, F.lit(float(HOURS_PER_YEAR)))
        .when(contains_any(lowered, BIWEEKLY), F.lit(float(PAY_PERIODS_PER_YEAR)))
        .otherwise(F.lit(1.0))
    )
    usable = F.when(~F.contains(lowered, F.lit("not")), _plain(text))
    number = "[0-9.]+"

    def split(words: Column) -> Column:
        """The two ends of a spoken range, or the single number twice."""
        first = F.regexp_extract(words, number, 0)
        last = F.regexp_extract(words, f"({number})$", 1)
        return F.struct(first.alias("first"), last.alias("second"))

    spoken = F.regexp_extract(usable, rf"(?i){number}+(?:to|-|–){number}+", 0)
    single = F.regexp_extract(usable, number, 0)
    words = computed_once(spoken, lambda pair: F.when(pair != "", pair).otherwise(single))
    return computed_once(
        computed_once(words, split), lambda s: _annual(s["first"], s["second"], factor, hourly)
    )


def feed_salary(text: Column) -> Column:
    """Feed text: the first two numbers found, or the only one; hourly made annual."""
    hourly = contains_any(F.lower(text), HOURLY)
    factor = F.when(hourly, F.lit(float(HOURS_PER_YEAR))).otherwise(F.lit(1.0))
    numbers = F.regexp_extract_all(_plain(text), F.lit("[0-9.]+"), F.lit(0))
    return computed_once(
        numbers,
        lambda n: _annual(
            F.get(n, F.lit(0)), F.coalesce(F.get(n, F.lit(1)), F.get(n, F.lit(0))), factor, hourly
        ),
    )


def salary_mid(salary_min: Column, salary_max: Column) -> Column:
    """Stored midpoint: a missing end counts as 0, so it is never NULL."""
    total = F.coalesce(salary_min, F.lit(0)).cast("long") + F.coalesce(salary_max, F.lit(0))
    return F.floor(total / F.lit(2)).cast("int")


def plausible(salary_min: Column, salary_max: Column, mid: Column) -> Column:
    """Keep postings without salary and those whose upper end is an annual amount."""
    return (salary_min.isNull() & salary_max.isNull()) | (
        F.coalesce(salary_max, mid) >= MIN_ANNUAL_SALARY
    )
