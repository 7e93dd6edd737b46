"""Years of experience, seniority and junior rules."""

from pyspark.sql import Column, functions as F

from marketlens.fixed_values import (
    ENTRY_WORDS,
    LEVEL_LIMITS,
    LEVEL_RANK,
    MAX_EXPERIENCE_YEARS,
)
from marketlens.functions.text import WS, computed_once, contains_any, whole_number

_UNIT = rf"[{WS}]*+(?:year|yr)"
# Possessive quantifiers and the digit look-behind keep the search linear in the text length.
_RANGE = rf"(?<![0-9])[0-9]++(?:[{WS}-]*+to[{WS}-]*+|[{WS}]*+-[{WS}-]*+)[0-9]++{_UNIT}"
_SINGLE = [
    rf"(?<![0-9])([0-9]++)\+?+{_UNIT}",
    rf"minimum[{WS}]*+(?:of[{WS}]*+)?+([0-9]++){_UNIT}",
    rf"at least[{WS}]*+([0-9]++){_UNIT}",
]


def _pair(low: Column, high: Column) -> Column:
    return F.struct(low.cast("int").alias("exp_min"), high.cast("int").alias("exp_max"))


def experience_range(lowered: Column) -> Column:
    """struct(exp_min, exp_max) from lower-case text, NULL when nothing is said.

    Only the first hit of each pattern counts; a number above 30 sends the search on to the
    next pattern; a single number n means n to n + 3.
    """

    def span(spoken: Column) -> Column:
        low = whole_number(F.regexp_extract(spoken, r"^([0-9]+)", 1))
        high = whole_number(F.regexp_extract(spoken, rf"([0-9]+){_UNIT}$", 1))
        both = (low <= MAX_EXPERIENCE_YEARS) & (high <= MAX_EXPERIENCE_YEARS)
        return F.when(both, _pair(low, high))

    def onwards(years: Column) -> Column:
        upper = F.least(years + 3, F.lit(MAX_EXPERIENCE_YEARS))
        return F.when(years <= MAX_EXPERIENCE_YEARS, _pair(years, upper))

    said = [computed_once(F.regexp_extract(lowered, _RANGE, 0), span)]
    for pattern in _SINGLE:
        number = F.regexp_extract(lowered, pattern, 1)
        said.append(computed_once(number, lambda n: onwards(whole_number(n))))
    dated = F.when(contains_any(lowered, ["year", "yr"]), F.coalesce(*said))
    entry = F.when(contains_any(lowered, ENTRY_WORDS), _pair(F.lit(0), F.lit(2)))
    return F.coalesce(dated, entry)


def mean_years(exp_min: Column, exp_max: Column, missing: int = 0) -> Column:
    """(min + max) / 2 with `missing` for unknown ends; a missing max falls back to min."""
    low = F.coalesce(exp_min, F.lit(missing))
    high = F.coalesce(exp_max, exp_min, F.lit(missing))
    return (low + high) / F.lit(2.0)


def stated_mean_years(exp_min: Column, exp_max: Column) -> Column:
    """The same mean, NULL when the lower end is unknown."""
    return (exp_min + F.coalesce(exp_max, exp_min)) / F.lit(2.0)


def exp_avg(exp_min: Column, exp_max: Column) -> Column:
    return mean_years(exp_min, exp_max).cast("decimal(4,2)")


def is_junior(exp_min: Column, exp_max: Column) -> Column:
    """At most two years on average; unknown experience is not junior."""
    unknown = exp_min.isNull() & exp_max.isNull()
    return F.when(unknown, F.lit(False)).otherwise(mean_years(exp_min, exp_max) <= 2)


def is_junior_unless_unknown(exp_min: Column, exp_max: Column) -> Column:
    """Dashboard rule: an unknown end counts as 99 years."""
    return mean_years(exp_min, exp_max, missing=99) <= 2


def exp_level(exp_min: Column, exp_max: Column) -> Column:
    """Level by mean years; 0 counts as unset for the upper end, nothing known is mid."""
    low = F.coalesce(exp_min, F.lit(0))
    high = F.coalesce(F.nullif(exp_max, F.lit(0)), F.nullif(exp_min, F.lit(0)), F.lit(0))
    mean = (low + high) / F.lit(2.0)
    level = F.when(exp_min.isNull() & exp_max.isNull(), F.lit("mid"))
    for name, limit in LEVEL_LIMITS:
        level = level.when(mean <= limit, F.lit(name))
    return level.otherwise(F.lit("lead"))


def level_rank(level: Column) -> Column:
    rank = F
    for name, value in LEVEL_RANK.items():
        rank = rank.when(level == name, F.lit(value))
    return rank.otherwise(F.lit(3))
