"""Posting text to features: experience, level, skills, remote flag."""

from pyspark.sql import DataFrame, functions as F

from marketlens.functions import experience as X
from marketlens.functions.remote import remote_type_of_posting
from marketlens.functions.skills import extracted_skills
from marketlens.functions.text import first_truthy
from marketlens.operators.rows import with_parts

FEATURE_COLUMNS = [
    "job_id", "exp_min", "exp_max", "exp_avg", "exp_level", "skills", "is_junior", "is_remote",
]


def with_generated(features: DataFrame) -> DataFrame:
    """Columns the table derives from exp_min and exp_max."""
    low, high = F.col("exp_min"), F.col("exp_max")
    return features.withColumn("exp_avg", X.exp_avg(low, high)).withColumn(
        "is_junior", X.is_junior(low, high)
    )


def extract_features(df: DataFrame, storable_only: bool = False) -> DataFrame:
    """One feature row per posting; a posting without title or description gives none.

    `storable_only` leaves out reversed ranges such as "5-3 years", which the table refuses.
    A projection only: the text is read once and every rule stays in the JVM.
    """
    texts = df.where(F.col("title").isNotNull() & F.col("description").isNotNull()).select(
        "job_id",
        F.col("remote_type").alias("_given"),
        F.concat(F.lower("title"), F.lit(" "), F.lower("description")).alias("_text"),
    )
    # As parts of their own, the years are not searched again by the filter on them, and the
    # filter does not sink to rows that other filters and joins would have dropped.
    dated = with_parts(texts, F.struct(X.experience_range(F.col("_text")).alias("_exp")))
    if storable_only:
        in_order = F.col("_exp.exp_max") >= F.col("_exp.exp_min")
        dated = dated.where(F.coalesce(in_order, F.lit(True)))
    found = dated.select(
        "job_id",
        "_exp",
        first_truthy(F.col("_given"), remote_type_of_posting(F.col("_text"))).alias("_remote"),
        extracted_skills(F.col("_text")).alias("skills"),
    )
    low, high = F.col("_exp.exp_min"), F.col("_exp.exp_max")
    plain = found.select(
        "job_id",
        low.alias("exp_min"),
        high.alias("exp_max"),
        "skills",
        F.coalesce(F.col("_remote").isin("remote", "hybrid"), F.lit(False)).alias("is_remote"),
        X.exp_level(low, high).alias("exp_level"),
    )
    return with_generated(plain).select(*FEATURE_COLUMNS)


def quarantined(features: DataFrame) -> DataFrame:
    """Rows with a reversed range, such as "5-3 years"."""
    return features.where(F.col("exp_max") < F.col("exp_min"))
