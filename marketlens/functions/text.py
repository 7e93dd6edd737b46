"""Text helpers shared by the parsers: trimming, truthiness, normalising, ids, HTML."""

from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

# The characters that count as white space when trimming and splitting.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as the inside of a regular-expression class.
WS = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_OTHER_WHITESPACE = WHITESPACE.replace(" ", "")


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def computed_once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with `value` evaluated a single time, however often `use` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def evaluated_apart(value: Column) -> Column:
    """The same value, kept out of its operator's generated method: long rules make that method
    too long for the JIT, and then every row pays."""
    return F.get(F.transform(F.array(F.lit(True)), lambda _: value), F.lit(0))


def whole_number(digits: Column) -> Column:
    """INT of a run of digits, NULL for none or too many (a failing cast is slow, so the
    common empty text is caught first)."""
    return F.when(digits != "", digits.try_cast("int"))


def truthy(text: Column) -> Column:
    """NULL for NULL and for the empty string, else the text."""
    return F.nullif(text, F.lit(""))


def first_truthy(*texts: Column) -> Column:
    return F.coalesce(*[truthy(t) for t in texts])


def contains_any(text: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in words])


def words(text: Column) -> Column:
    """Lower-case words; the empty text has none."""
    return F.filter(F.split(F.lower(text), f"[{WS}]+"), lambda w: w != "")


def lookup(table: dict[str, str], key: Column) -> Column:
    """Value of a small literal table, NULL when the key is missing."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), key)


def normalise(text: Column) -> Column:
    """Lower, trim, keep a-z 0-9 and white space, collapse white space to one blank.

    Trimming comes first, so a blank uncovered by a removed character stays.
    """
    kept = F.regexp_replace(strip(F.lower(text)), f"[^a-z0-9{WS}]+", "")
    blanks = F.translate(kept, _OTHER_WHITESPACE, " " * len(_OTHER_WHITESPACE))
    return F.regexp_replace(blanks, " {2,}", " ")


def short_id(text: Column, digits: int | None = None) -> Column:
    """MD5 of a text in hex; the first `digits` only for showing, as they do not tell rows apart."""
    return F.md5(text) if digits is None else F.left(F.md5(text), F.lit(digits))


def shortened(text: Column, limit: int | None) -> Column:
    """The first `limit` characters, or the whole text."""
    return text if limit is None else F.left(text, F.lit(limit))


def path_id(path: Column) -> Column:
    """Trailing number of a path, else its hash."""
    number = F.regexp_extract(path, r"/(\d+)/?$", 1)
    return F.coalesce(truthy(number), short_id(path))


def split_title_company(title: Column) -> tuple[Column, Column]:
    """'Role - Company' to (role, company); without ' - ' the company is Unknown."""
    parts = F.split(title, " - ")
    has_company = F.contains(title, F.lit(" - "))
    role = strip(F.array_join(F.slice(parts, 1, F.size(parts) - 1), " - "))
    company = strip(F.element_at(parts, -1))
    return (
        F.when(has_company, role).otherwise(title),
        F.when(has_company, company).otherwise(F.lit("Unknown")),
    )


def absolute_url(base: str, path: Column) -> Column:
    """Resolve a link found on a page against the site root."""
    return (
        F.when(path.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), path)
        .when(path.startswith("//"), F.concat(F.lit("https:"), path))
        .when(path.rlike(r"^[/?#]"), F.concat(F.lit(base), path))
        .otherwise(F.concat(F.lit(base + "/"), path))
    )


def strip_tags(text: Column) -> Column:
    return F.regexp_replace(text, "<[^>]+>", " ")


@F.pandas_udf(T.StringType())
def unescape_entities(text: pd.Series) -> pd.Series:
    from html import unescape

    return text.map(unescape, na_action="ignore")


def html_to_text(text: Column, limit: int | None = None) -> Column:
    """Resolve entities, blank out tags; cut only where a limit is asked for."""
    return shortened(strip_tags(unescape_entities(text)), limit)
