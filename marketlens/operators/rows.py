"""Row-picking and joining building blocks."""

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_per_key(df: DataFrame, keys: list[str | Column], order: list[str | Column]) -> DataFrame:
    """Keep the first row of every key.

    The rank filter is pushed below the shuffle (one row per key and map task travels), so a
    key that holds most rows does not end up whole in one task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def postings_with_features(raw: DataFrame, features: DataFrame, how: str = "inner") -> DataFrame:
    """Postings joined to their features on job_id; the key is unique on the feature side."""
    return raw.join(features, "job_id", how)


def unprocessed(raw: DataFrame, features: DataFrame) -> DataFrame:
    """Postings that have no features yet."""
    return raw.join(features.select("job_id"), "job_id", "left_anti")


def not_stored(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of a batch whose job_id is not stored yet."""
    return batch.join(stored.select("job_id"), "job_id", "left_anti")


def existing_job_ids(raw: DataFrame, source: str | None = None) -> DataFrame:
    """Stored keys, optionally of one source, as a DataFrame that stays distributed."""
    rows = raw if source is None else raw.where(F.col("source") == source)
    return rows.select("job_id")


def explode_skills(df: DataFrame, column: str = "skills", name: str = "skill") -> DataFrame:
    """One row per list entry; empty and NULL lists vanish."""
    return df.withColumn(name, F.explode(column))


def with_parts(df: DataFrame, parts: Column) -> DataFrame:
    """Add the fields of a struct as columns.

    Unnesting a one-entry list computes the struct once: neither a second mention of a field
    nor a later filter on one runs its expressions again.
    """
    return df.select("*", F.inline(F.array(parts)))


def newest_first(day: str = "posted_date") -> Column:
    """Descending with unknown dates in front."""
    return F.col(day).desc_nulls_first()
