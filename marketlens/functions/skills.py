"""Skill words found in a posting."""

import re

from pyspark.sql import Column, functions as F

from marketlens.fixed_values import EXTRACTED_SKILLS

# Fixed value: the entry whose dot is optional, and the part both spellings share.
_DOTTED, _DOTTED_PATTERN, _DOTTED_PART = "node.js", r"node\.?js", "node"


def word_pattern(name: str) -> str:
    """Regular expression for a name between word boundaries, whatever the script around it."""
    return r"(?U)\b" + re.escape(name).replace(r"\ ", " ") + r"\b"


def named_words(lowered: Column, names: list[str]) -> Column:
    """The names found between word boundaries, in the order given.

    The plain substring test is cheap and spares the pattern for all names but a few. The text
    is looked at once per name, so pass a column and not an expression.
    """
    hits = []
    for name in names:
        part, pattern = name, word_pattern(name)
        if name == _DOTTED:
            part, pattern = _DOTTED_PART, rf"(?U)\b{_DOTTED_PATTERN}\b"
        found = F.contains(lowered, F.lit(part)) & lowered.rlike(pattern)
        hits.append(F.when(found, F.lit(name)))
    return F.array_compact(F.array(*hits))


def extracted_skills(lowered: Column, limit: int | None = None) -> Column:
    """Known skills in dictionary order without their dots, all of them or the first `limit`."""
    found = named_words(lowered, EXTRACTED_SKILLS)
    if limit is not None:
        found = F.slice(found, 1, limit)
    return F.transform(found, lambda n: F.replace(n, F.lit("."), F.lit("")))


def clean_skill(skill: Column) -> Column:
    return F.lower(F.trim(skill))


def has_all_skills(skills: Column, wanted: list[str]) -> Column:
    """Containment of a list of skills."""
    return F.size(F.array_except(F.array(*[F.lit(w) for w in wanted]), skills)) == 0


def skills_count(skills: Column) -> Column:
    return F.coalesce(F.array_size(skills), F.lit(0))


def skills_json(skills: Column) -> Column:
    """JSON text of the list with ", " between the entries."""

    def entry(skill: Column) -> Column:
        boxed = F.to_json(F.array(skill))
        return F.substr(boxed, F.lit(2), F.length(boxed) - 2)

    entries = F.transform(skills, entry)
    return F.concat(F.lit("["), F.array_join(entries, ", "), F.lit("]"))
