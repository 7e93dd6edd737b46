"""Location text to city and province."""

from pyspark.sql import Column, functions as F

from marketlens import fixed_values as V
from marketlens.functions.text import computed_once, first_truthy, lookup, strip


def _comma_parts(text: Column) -> Column:
    return F.transform(F.split(text, ","), strip)


def _province_of_part(part: Column, table: dict[str, str]) -> Column:
    """Two letters are a code; a known name maps; else the first two letters; none is ''."""
    named = F.coalesce(lookup(table, F.lower(part)), F.upper(F.left(part, F.lit(2))))
    return F.when(part.isNull(), F.lit("")).when(F.length(part) == 2, F.upper(part)).otherwise(named)


def _city_province(text: Column, table: dict[str, str]) -> Column:
    """First comma part and the province that the second one names."""
    return computed_once(
        _comma_parts(text),
        lambda parts: F.struct(
            F.get(parts, F.lit(0)).alias("city"),
            computed_once(F.get(parts, F.lit(1)), lambda p: _province_of_part(p, table)).alias("province"),
        ),
    )


def board_location(text: Column) -> Column:
    """'City (XX)' or 'City, Province'."""
    pattern = r"^(.+?)\s*\(([A-Z]{2})\)$"
    bracketed = F.struct(
        strip(F.regexp_extract(text, pattern, 1)).alias("city"),
        F.regexp_extract(text, pattern, 2).alias("province"),
    )
    return F.when(text.rlike(pattern), bracketed).otherwise(
        _city_province(text, V.PROVINCE_BY_FULL_NAME)
    )


def feed_location(text: Column) -> Column:
    """'City, Province, Canada' with the country removed first."""
    cleaned = strip(
        F.replace(F.replace(text, F.lit(", Canada"), F.lit("")), F.lit(",Canada"), F.lit(""))
    )
    return _city_province(cleaned, V.PROVINCE_BY_SHORT_TABLE)


def remote_location(text: Column) -> Column:
    """Remote feed: any text with "ca" in it counts as Canadian; province falls back to ON."""
    parts = _comma_parts(text)
    table = V.PROVINCE_BY_REMOTE_PART

    def province(part: Column) -> Column:
        low = F.lower(part)
        return F.coalesce(lookup(table, low), lookup(table, F.left(low, F.lit(2))))

    found = F.filter(
        F.transform(F.slice(parts, 2, F.size(parts)), province), lambda p: p.isNotNull()
    )
    canadian = F.contains(F.lower(text), F.lit("ca"))
    return F.struct(
        F.when(canadian, F.get(parts, F.lit(0))).otherwise(F.lit("Remote")).alias("city"),
        F.when(canadian, F.coalesce(F.get(found, F.lit(0)), F.lit("ON")))
        .otherwise(F.lit("ON"))
        .alias("province"),
    )


def province_of_city(city: Column) -> Column:
    return F.coalesce(lookup(V.PROVINCE_BY_CITY, F.lower(city)), F.lit(""))


def province_of_city_second_rss(city: Column) -> Column:
    known = {c: p for c, p in V.PROVINCE_BY_CITY.items() if c not in V.CITIES_UNKNOWN_TO_SECOND_RSS}
    return F.coalesce(lookup(known, F.lower(city)), F.lit(""))


def province_of_region(name: Column) -> Column:
    return F.coalesce(lookup(V.PROVINCE_BY_REGION, strip(F.lower(name))), F.lit(""))


def province_of_area(area: Column) -> Column:
    """First entry of an area list that names a province."""
    hits = F.filter(F.transform(area, province_of_region), lambda p: p != "")
    return F.coalesce(F.get(hits, F.lit(0)), F.lit(""))


def province_of_state(state: Column) -> Column:
    """State name or code; unknown ones give their first two letters."""
    fallback = F.when(F.length(state) >= 2, F.upper(F.left(state, F.lit(2)))).otherwise(F.lit(""))
    known = lookup(V.PROVINCE_BY_STATE, F.lower(strip(state)))
    return F.when(F.coalesce(state, F.lit("")) == "", F.lit("")).otherwise(
        F.coalesce(known, fallback)
    )


def province_name(code: Column) -> Column:
    return F.coalesce(lookup(V.PROVINCE_NAMES, code), code)


def area_search_location(display: Column, area: Column, default_city: Column) -> Column:
    """City from the display name; province from the city, then the last part of the
    display name, then the area list, then the default city."""
    has_comma = F.contains(display, F.lit(","))
    head = strip(F.substring_index(display, ",", 1))
    named = F.when(has_comma, head).otherwise(F.coalesce(display, default_city))
    last = F.when(has_comma, province_of_region(F.substring_index(display, ",", -1)))

    def place(city: Column) -> Column:
        province = first_truthy(
            province_of_city(strip(city)),
            last,
            province_of_area(area),
            province_of_city(strip(default_city)),
        )
        return F.struct(city.alias("city"), F.coalesce(province, F.lit("")).alias("province"))

    return computed_once(first_truthy(named, default_city), place)
