"""Role category of a title."""

from pyspark.sql import Column, functions as F

from marketlens.fixed_values import ROLE_WORDS
from marketlens.functions.text import contains_any


def classify_role(title: Column) -> Column:
    lowered = F.lower(title)
    role = F
    for name, words in ROLE_WORDS:
        role = role.when(contains_any(lowered, words), F.lit(name))
    return role.otherwise(F.lit("Other"))
