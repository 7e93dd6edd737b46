"""Stored indexes for skill containment and for substring search.

Both are posting lists kept as rows sorted by term, in versioned tables dealt by term: a question
reads the pieces of its own terms, and row-group statistics skip the other terms in them. A list
that is very long is spread over the files of its piece.
"""

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marketlens.operators.versioned import PIECE_ROWS, VersionedTable
from marketlens.session import with_checkpoint_dir

GRAM = 3


def rarest_first(lists: DataFrame, term: str, item: str, wanted: list[str]) -> DataFrame:
    """Items that are in the lists of all wanted terms, starting from the shortest list.

    Lists are only ever filtered by what is left, so the work follows the rarest term.
    """
    sizes = {r[0]: r[1] for r in lists.groupBy(term).count().collect()}  # a row per wanted term
    order = sorted(wanted, key=lambda t: (sizes.get(t, 0), t))
    parts = [lists.where(F.col(term) == t).select(item) for t in order]
    return reduce(lambda left, more: left.join(more, item, "left_semi"), parts).distinct()


class SkillIndex:
    """Skills to the postings that have them."""

    def __init__(self, spark: SparkSession, path: str, piece_rows: int = PIECE_ROWS):
        self.spark = spark
        self.table = VersionedTable(spark, path, key="skill", piece_rows=piece_rows)

    def add(self, features: DataFrame, expected_rows: int = 0) -> int:
        """Index the skills of features that are not indexed yet; the number of entries."""
        rows = features.select(F.explode(F.array_distinct("skills")).alias("skill"), "job_id").where(F.col("skill").isNotNull())
        return self.table.append(rows, order=["skill", "job_id"], expected_rows=expected_rows)

    def lists(self, skills: list[str]) -> DataFrame:
        """(skill, job_id) of the given skills."""
        return self.table.lookup(self.spark.createDataFrame([(s,) for s in skills], "skill string"))

    def has_all(self, skills: list[str]) -> DataFrame:
        """job_id of the postings that have every skill; there must be one at least."""
        wanted = sorted(set(skills))
        if not wanted:
            raise ValueError("name a skill")
        return rarest_first(self.lists(wanted), "skill", "job_id", wanted)


def grams_of(text: Column) -> Column:
    """Distinct runs of three letters of a lower-cased text."""
    low = F.lower(text)
    starts = F.sequence(F.lit(1), F.greatest(F.char_length(low) - (GRAM - 1), F.lit(1)))
    return F.array_distinct(F.transform(starts, lambda k: F.substring(low, k, F.lit(GRAM))))


def pattern_grams(pattern: str) -> list[str]:
    """Runs of three letters that every match of a LIKE pattern has.

    % and _ are wildcards; what follows a backslash is a letter, and ends a run here.
    """
    runs = re.split(r"\\.|[%_]", pattern.lower(), flags=re.DOTALL)
    return sorted({run[k : k + GRAM] for run in runs for k in range(len(run) - GRAM + 1)})


class SubstringIndex:
    """Distinct values of a text column by their runs of three letters, and the postings of a value.

    A pattern's runs pick the values that may match, ILIKE decides, and the values' lists name the
    postings. A pattern that is not ASCII, whose lower case may differ from the engine's, or without
    three letters in a row is held against all distinct values.
    """

    def __init__(self, spark: SparkSession, path: str, column: str, piece_rows: int = PIECE_ROWS):
        self.spark, self.column = spark, column
        self.values = VersionedTable(spark, f"{path}/values", key="value", piece_rows=piece_rows)
        self.grams = VersionedTable(spark, f"{path}/grams", key="gram", piece_rows=piece_rows)
        self.places = VersionedTable(spark, f"{path}/places", key="value", piece_rows=piece_rows)

    def add(self, postings: DataFrame, expected_rows: int = 0) -> None:
        """Index postings that are not indexed yet.

        Values come before their runs and those before their places: a call that dies and is
        repeated leaves no posting out, and repeated entries do no harm.
        """
        with_checkpoint_dir(self.spark)
        # Read for the values, for their runs and for the places, so kept in the shared folder.
        rows = postings.select(F.col(self.column).alias("value"), "job_id").where(F.col("value").isNotNull()).checkpoint()
        distinct = rows.select("value").distinct()
        known = self.values.lookup(distinct) if self.values.exists() else self.spark.createDataFrame([], "value string")
        new = distinct.join(known, "value", "left_anti").checkpoint()
        self.grams.append(new.select(F.explode(grams_of(F.col("value"))).alias("gram"), "value"), order=["gram", "value"], expected_rows=expected_rows)
        self.values.append(new, order=["value"], expected_rows=expected_rows)
        self.places.append(rows, order=["value", "job_id"], expected_rows=expected_rows)

    def matching_values(self, pattern: str) -> DataFrame:
        """Distinct values a LIKE pattern matches, whatever their case."""
        wanted = pattern_grams(pattern) if pattern.isascii() else []
        if not wanted:
            found = self.values.read()
        else:
            keys = self.spark.createDataFrame([(g,) for g in wanted], "gram string")
            found = rarest_first(self.grams.lookup(keys), "gram", "value", wanted)
        return found.where(F.col("value").ilike(pattern)).select("value").distinct()

    def find(self, pattern: str) -> DataFrame:
        """job_id of the postings whose value the pattern matches."""
        return self.places.lookup(self.matching_values(pattern)).select("job_id").distinct()
