"""Standing views: postings with features, recent postings, city figures, exports."""

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from marketlens.functions.dates import age_in_days, within_days
from marketlens.functions.experience import level_rank, stated_mean_years
from marketlens.functions.skills import skills_count, skills_json
from marketlens.operators.rows import newest_first, postings_with_features

FLEXIBLE = ("remote", "hybrid")


def percent_of(condition: Column, digits: int = 1) -> Column:
    """Share of rows, in percent; rows with an unknown condition are left out.

    Averaging 0 and 100 keeps one rounding step, so halves round up exactly.
    """
    return F.round(F.avg(condition.cast("int") * F.lit(100)), digits)


def is_flexible() -> Column:
    return F.coalesce(F.col("remote_type").isin(*FLEXIBLE), F.lit(False))


def jobs_full(raw: DataFrame, features: DataFrame, as_of: date) -> DataFrame:
    joined = postings_with_features(raw, features, "left")
    return joined.select(
        "job_id", "source", "title", "company", "city", "province",
        "salary_min", "salary_max", "salary_mid", "remote_type", "posted_date", "url",
        "exp_min", "exp_max", "exp_avg", "exp_level", "skills", "is_junior", "is_remote",
        "extraction_confidence",
        age_in_days(F.col("posted_date"), as_of).cast("double").alias("days_since_posted"),
    )


def recent_jobs(raw: DataFrame, features: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    return jobs_full(raw, features, as_of).where(within_days(F.col("posted_date"), as_of, days))


def city_stats(raw: DataFrame, features: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    recent = raw.where(within_days(F.col("posted_date"), as_of, days))
    return (
        postings_with_features(recent, features, "left")
        .groupBy("city", "province")
        .agg(
            F.count("*").alias("total_jobs"),
            F.round(F.avg("exp_min"), 1).alias("avg_exp_min"),
            F.round(F.avg("exp_max"), 1).alias("avg_exp_max"),
            percent_of(F.col("is_junior")).alias("junior_pct"),
            F.round(F.avg("salary_mid"), 0).alias("avg_salary"),
            percent_of(is_flexible()).alias("remote_pct"),
            F.max("posted_date").alias("latest_posting"),
            F.count_distinct("source").alias("sources_count"),
        )
    )


def bi_export(raw: DataFrame, features: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    """Rows of the materialised export, newest first; the id breaks ties so that one busy day
    does not sort in one task."""
    recent = raw.where(within_days(F.col("posted_date"), as_of, days))
    return (
        postings_with_features(recent, features, "left")
        .orderBy(newest_first(), "id")
        .select(
            "job_id", "source", F.col("title").alias("role"), "company", "city", "province",
            "posted_date", "salary_min", "salary_max", "salary_mid", "remote_type",
            "exp_min", "exp_max", "exp_avg", "exp_level", "is_junior", "is_remote",
            skills_json(F.col("skills")).alias("skills_json"),
            skills_count(F.col("skills")).alias("skills_count"),
            level_rank(F.col("exp_level")).alias("seniority_order"),
            "url",
        )
    )


def bi_dataset(raw: DataFrame, features: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    """Wide dataset for a BI tool; the mean experience stays unknown without a lower end."""
    recent = raw.where(within_days(F.col("posted_date"), as_of, days))
    return (
        postings_with_features(recent, features, "left")
        .orderBy(newest_first(), "city", "title", "id")
        .select(
            "job_id", "source", F.col("title").alias("role"), "company", "city", "province",
            "posted_date", "scraped_at",
            age_in_days(F.col("posted_date"), as_of).cast("double").alias("days_since_posted"),
            "salary_min", "salary_max", "salary_mid", "remote_type", "is_remote",
            "exp_min", "exp_max",
            stated_mean_years(F.col("exp_min"), F.col("exp_max")).alias("exp_avg"),
            "exp_level", "is_junior",
            skills_json(F.col("skills")).alias("skills_json"),
            skills_count(F.col("skills")).alias("skills_count"),
            level_rank(F.col("exp_level")).alias("seniority_order"),
            "url",
        )
    )


def city_role_stats(raw: DataFrame, features: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    recent = raw.where(within_days(F.col("posted_date"), as_of, days))
    return (
        postings_with_features(recent, features)
        .groupBy("city", "province", F.col("title").alias("role"))
        .agg(
            F.count("*").alias("total_jobs"),
            F.round(F.avg("exp_min"), 1).alias("avg_exp_min"),
            F.round(F.avg("exp_max"), 1).alias("avg_exp_max"),
            percent_of(F.col("is_junior")).alias("junior_pct"),
            F.round(F.avg("salary_mid"), 0).alias("avg_salary"),
            percent_of(is_flexible()).alias("remote_pct"),
            F.max("posted_date").alias("latest_posting"),
        )
    )


def register_views(raw: DataFrame, features: DataFrame, as_of: date) -> None:
    """Temporary views for ad-hoc SQL."""
    raw.createOrReplaceTempView("jobs_raw")
    features.createOrReplaceTempView("jobs_features")
    jobs_full(raw, features, as_of).createOrReplaceTempView("vw_jobs_full")
    recent_jobs(raw, features, as_of).createOrReplaceTempView("vw_recent_jobs")
    city_stats(raw, features, as_of).createOrReplaceTempView("vw_city_stats")
    bi_export(raw, features, as_of).createOrReplaceTempView("mv_powerbi_export")
    city_role_stats(raw, features, as_of).createOrReplaceTempView("mv_city_role_stats")
