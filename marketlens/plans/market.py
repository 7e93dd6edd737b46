"""The market questions: ladders, skill demand, salaries, city and posting scores, trends."""

from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from marketlens import fixed_values as V
from marketlens.functions.dates import within_days
from marketlens.functions.experience import stated_mean_years
from marketlens.functions.skills import clean_skill, skills_json
from marketlens.operators.rows import explode_skills, newest_first, postings_with_features
from marketlens.operators.scoring import bucket, capped, min_max, weighted_score
from marketlens.plans.views import is_flexible, percent_of


def recent_with_features(
    raw: DataFrame, features: DataFrame, as_of: date, days: int, how: str = "inner"
) -> DataFrame:
    return postings_with_features(
        raw.where(within_days(F.col("posted_date"), as_of, days)), features, how
    )


def experience_ladder(
    raw: DataFrame, features: DataFrame, as_of: date,
    days: int = 30, min_jobs: int = 5, limit: int = 50,
) -> DataFrame:
    """Roles and cities by junior share and experience asked for."""
    mid = stated_mean_years(F.col("exp_min"), F.col("exp_max"))
    return (
        recent_with_features(raw, features.where(F.col("exp_min").isNotNull()), as_of, days)
        .groupBy(F.col("title").alias("role"), "city", "province")
        .agg(
            F.round(F.avg("exp_min"), 1).alias("avg_exp_min"),
            F.round(F.avg("exp_max"), 1).alias("avg_exp_max"),
            F.round(F.avg(mid), 1).alias("avg_exp_mid"),
            percent_of(F.col("is_junior")).alias("junior_pct"),
            F.count("*").alias("job_count"),
        )
        .where(F.col("job_count") >= min_jobs)
        .orderBy(F.desc_nulls_first("junior_pct"), F.asc_nulls_last("avg_exp_min"), "role", "city", "province")
        .limit(limit)
    )


def skill_demand(
    raw: DataFrame, features: DataFrame, skills: DataFrame, as_of: date,
    days: int = 30, min_jobs: int = 3, limit: int = 100,
) -> DataFrame:
    """Demand per role and known skill: count, share of the role's counts, and mentions per
    posting of the role ever published."""
    listed = explode_skills(
        recent_with_features(
            raw.select("job_id", "title", "posted_date"), features.select("job_id", "skills"), as_of, days
        )
    ).select(F.col("title").alias("role"), clean_skill(F.col("skill")).alias("skill"))
    demand = (
        listed.groupBy("role", "skill")
        .agg(F.count("*").alias("demand_count"))
        .join(skills.select("skill", "category"), "skill")
        .where(F.col("demand_count") >= min_jobs)
    )
    postings = raw.groupBy(F.col("title").alias("role")).agg(
        F.count_distinct("job_id").alias("role_jobs")
    )
    role_total = F.sum("demand_count").over(Window.partitionBy("role"))
    return (
        demand.withColumn("demand_pct", F.round(F.lit(100.0) * F.col("demand_count") / role_total, 1))
        .join(postings, "role")
        .select(
            "role", "skill", "category", "demand_count", "demand_pct",
            F.round(F.col("demand_count") / F.col("role_jobs"), 2).alias("penetration_rate"),
        )
        .orderBy(F.desc("demand_count"), "role", "skill")
        .limit(limit)
    )


def remote_availability(
    raw: DataFrame, features: DataFrame, as_of: date,
    days: int = 30, min_jobs: int = 5, limit: int = 50,
) -> DataFrame:
    def jobs_of(kind: str) -> Column:
        return F.count_if(F.col("remote_type") == kind)

    return (
        recent_with_features(raw, features.select("job_id"), as_of, days)
        .groupBy("city", "province", F.col("title").alias("role"))
        .agg(
            F.count("*").alias("total_jobs"),
            jobs_of("remote").alias("fully_remote_jobs"),
            jobs_of("hybrid").alias("hybrid_jobs"),
            jobs_of("onsite").alias("onsite_jobs"),
            percent_of(F.coalesce(F.col("remote_type") == "remote", F.lit(False))).alias("remote_pct"),
            percent_of(is_flexible()).alias("flexible_pct"),
        )
        .where(F.col("total_jobs") >= min_jobs)
        .orderBy(F.desc("remote_pct"), F.desc("total_jobs"), "city", "province", "role")
        .limit(limit)
    )


def salary_percentiles(
    raw: DataFrame, features: DataFrame, as_of: date, days: int = 30,
    band: tuple[int, int] = (30000, 250000), min_jobs: int = 3, limit: int = 100,
) -> DataFrame:
    """Mean and quartile salaries per city, role and level.

    Equal amounts are counted first, map-side and spread over the amounts, so that even a group
    holding much of the table reaches the exact percentiles as one row per distinct amount; the
    band bounds their number.
    """
    keys = ["city", "province", "role", "exp_level"]
    inside = F.col("salary_mid").between(*band)
    amounts = (
        recent_with_features(raw.where(inside), features.select("job_id", "exp_level"), as_of, days)
        .groupBy("city", "province", F.col("title").alias("role"), "exp_level", "salary_mid")
        .agg(
            F.count("*").alias("n"),
            *[f(c).alias(f"{name}_{c}") for c in ("salary_min", "salary_max") for name, f in (("sum", F.sum), ("n", F.count))],
        )
    )

    def mean(total: Column, n: Column) -> Column:
        return F.round(F.sum(total) / F.nullif(F.sum(n), F.lit(0)), 0)

    return (
        amounts.groupBy(*keys)
        .agg(
            F.sum("n").alias("job_count"),
            mean(F.col("sum_salary_min"), F.col("n_salary_min")).alias("avg_salary_min"),
            mean(F.col("sum_salary_max"), F.col("n_salary_max")).alias("avg_salary_max"),
            mean(F.col("salary_mid") * F.col("n"), F.col("n")).alias("avg_salary_mid"),
            F.percentile("salary_mid", [0.25, 0.5, 0.75], F.col("n")).alias("_quartiles"),
        )
        .where(F.col("job_count") >= min_jobs)
        .withColumns(
            {
                name: F.bround(F.get("_quartiles", F.lit(i)), 0)
                for i, name in enumerate(("p25_salary", "median_salary", "p75_salary"))
            }
        )
        .drop("_quartiles")
        .orderBy(F.desc_nulls_first("avg_salary_mid"), *keys)
        .limit(limit)
    )


# Weights of the city opportunity score.
CITY_WEIGHTS = {
    "junior_ratio": 0.30, "remote_ratio": 0.25, "norm_jobs": 0.20, "norm_low_exp": 0.15, "norm_salary": 0.10,
}


def city_opportunity(
    raw: DataFrame, features: DataFrame, as_of: date,
    days: int = 30, min_jobs: int = 10, weights: dict[str, float] | None = None,
) -> DataFrame:
    """Cities by a weighted score of junior share, remote share, volume, experience, salary."""
    mid = stated_mean_years(F.col("exp_min"), F.col("exp_max"))
    cities = (
        recent_with_features(raw, features, as_of, days)
        .groupBy("city", "province")
        .agg(
            F.count("*").alias("total_jobs"),
            F.avg(mid).alias("avg_exp"),
            F.avg(F.col("is_junior").cast("int")).alias("junior_ratio"),
            F.avg(is_flexible().cast("int")).alias("remote_ratio"),
            F.avg("salary_mid").alias("avg_salary"),
            percent_of(F.col("is_junior")).alias("junior_pct"),
            percent_of(is_flexible()).alias("remote_pct"),
        )
        .where(F.col("total_jobs") >= min_jobs)
    )
    scaled = min_max(
        cities, {"norm_jobs": "total_jobs", "norm_exp": "avg_exp", "norm_salary": "avg_salary"}
    ).withColumn("norm_low_exp", F.lit(1.0) - F.col("norm_exp"))
    score = weighted_score(weights or CITY_WEIGHTS) * F.lit(100.0)
    return scaled.select(
        "city", "province", "total_jobs",
        F.round("avg_exp", 1).alias("avg_exp_years"),
        "junior_pct",
        "remote_pct",
        F.round("avg_salary", 0).alias("avg_salary_cad"),
        F.round(score, 1).alias("opportunity_score"),
    ).orderBy(F.desc("opportunity_score"), "city", "province")


def skill_pairs(skills: Column) -> Column:
    """All ordered pairs a < b of one posting's distinct skills."""
    names = F.array_sort(F.array_distinct(F.array_compact(skills)))
    return F.flatten(
        F.transform(
            names,
            lambda a, i: F.transform(
                F.slice(names, i + 2, F.size(names)),
                lambda b: F.struct(a.alias("skill_1"), b.alias("skill_2")),
            ),
        )
    )


def skill_cooccurrence(
    raw: DataFrame, features: DataFrame, as_of: date,
    days: int = 30, min_jobs: int = 5, limit: int = 100,
) -> DataFrame:
    """Skill pairs per role, with the share of the first skill's postings (over all roles).

    Pairs are made inside each posting's own list, so nothing is joined to itself. A posting
    listed more than once counts once: its (id, role) pairs are made distinct before they meet
    the features, which also shrinks an id that fills much of the table.
    """
    postings = (
        raw.where(within_days(F.col("posted_date"), as_of, days))
        .select("job_id", F.col("title").alias("role"))
        .distinct()
    )
    skilled = features.where(F.array_size("skills") > 0).select("job_id", "skills")
    listed = postings.join(skilled, "job_id")
    pairs = (
        listed.select("role", F.inline(skill_pairs(F.col("skills"))))
        .groupBy("role", "skill_1", "skill_2")
        .agg(F.count("*").alias("co_occurrence_count"))
        .where(F.col("co_occurrence_count") >= min_jobs)
    )
    totals = (
        skilled.join(postings.select("job_id").distinct(), "job_id", "left_semi")
        .select(F.explode(F.array_distinct("skills")).alias("skill_1"))
        .groupBy("skill_1")
        .agg(F.count("*").alias("skill_jobs"))
    )
    share = F.lit(100.0) * F.col("co_occurrence_count") / F.col("skill_jobs")
    return (
        pairs.join(totals, "skill_1")
        .select(
            "role", "skill_1", "skill_2", "co_occurrence_count",
            F.round(share, 1).alias("co_occurrence_pct"),
        )
        .orderBy(F.desc("co_occurrence_count"), "role", "skill_1", "skill_2")
        .limit(limit)
    )


def weekly_trend(
    events: DataFrame, as_of: date, keys: list[str], day: str = "posted_date",
    days: int = 90, min_jobs: int = 3, limit: int | None = 200,
) -> DataFrame:
    """Rows per week and key, with the change against the previous week that was kept."""
    week = F.date_trunc("week", F.col(day)).cast("date")
    counted = (
        events.where(within_days(F.col(day), as_of, days))
        .groupBy(week.alias("week_start"), *keys)
        .agg(F.count("*").alias("jobs_posted"))
        .where(F.col("jobs_posted") >= min_jobs)
    )
    previous = F.lag("jobs_posted").over(Window.partitionBy(*keys).orderBy("week_start"))
    gain = F.col("jobs_posted") - F.col("prev_week_jobs")
    change = F.lit(100.0) * gain / F.nullif(F.col("prev_week_jobs"), F.lit(0))
    trend = (
        counted.withColumn("prev_week_jobs", previous)
        .withColumn("week_over_week_change_pct", F.round(change, 1))
        .orderBy(F.desc_nulls_first("week_start"), F.desc("jobs_posted"), *keys)
    )
    return trend if limit is None else trend.limit(limit)


def posting_trend(raw: DataFrame, as_of: date, **options) -> DataFrame:
    titled = raw.withColumn("role", F.col("title"))
    return weekly_trend(titled, as_of, ["city", "role"], **options)


def entry_level_finder(
    raw: DataFrame, features: DataFrame, as_of: date,
    days: int = 30, cities: list[str] = V.FINDER_CITIES, limit: int = 100,
) -> DataFrame:
    """Junior postings by a score of experience, remote work, salary and skill count."""
    low, pay = F.col("exp_min"), F.col("salary_min")
    score = (
        F.when(low == 0, 40).when(low <= 1, 30).otherwise(0)
        + F.when(is_flexible(), 20).otherwise(0)
        + F.when(pay >= 50000, 20).otherwise(10)
        + F.when(F.array_size("skills") <= 5, 20).otherwise(10)
    )
    return (
        recent_with_features(
            raw.where(F.col("city").isin(cities)), features.where(F.col("is_junior")), as_of, days
        )
        .select(
            "job_id", "title", "company", "city", "province", "exp_min", "exp_max", "exp_level",
            "salary_min", "salary_max", "remote_type",
            skills_json(F.col("skills")).alias("skills"),
            "posted_date", "url", score.cast("double").alias("entry_level_score"),
        )
        .orderBy(F.desc("entry_level_score"), newest_first(), "job_id", "title", "url")
        .limit(limit)
    )


def skill_gap(
    raw: DataFrame, features: DataFrame, skills: DataFrame, have: list[str], as_of: date,
    days: int = 30, min_jobs: int = 10, limit: int = 20,
) -> DataFrame:
    """Known skills by demand, marking those the user has; missing ones rank by demand."""
    recent = raw.where(within_days(F.col("posted_date"), as_of, days)).select("job_id").distinct()
    total = features.agg(F.count("*").alias("n")).scalar()
    demand = (
        explode_skills(features.select("job_id", "skills"))
        .join(recent, "job_id", "left_semi")
        .select("job_id", clean_skill(F.col("skill")).alias("skill"))
        .join(skills.select("skill", "category"), "skill")
        .groupBy("skill", "category")
        .agg(F.count_distinct("job_id").alias("jobs_requiring"))
        .where(F.col("jobs_requiring") >= min_jobs)
    )
    owned = F.col("skill").isin(have)
    pct = F.round(F.lit(100.0) * F.col("jobs_requiring") / total, 1)
    return (
        demand.withColumn("market_demand_pct", pct)
        .withColumn("skill_status", F.when(owned, "Have").otherwise("Missing"))
        .withColumn(
            "learning_priority", F.when(owned, F.lit(0.0)).otherwise(F.col("market_demand_pct"))
        )
        .orderBy(F.desc("learning_priority"), F.desc("market_demand_pct"), "skill")
        .limit(limit)
    )


# Weights and limits of the difficulty score.
DIFFICULTY_WEIGHTS = {"norm_exp": 0.40, "norm_skills": 0.30, "norm_salary": 0.20, "norm_remote": 0.10}
DIFFICULTY_LIMITS = [(30.0, "Easy"), (60.0, "Medium")]


def job_difficulty(
    raw: DataFrame, features: DataFrame, as_of: date, days: int = 30, limit: int = 100
) -> DataFrame:
    """Postings by difficulty; unknown experience or skills count as hardest."""
    joined = recent_with_features(raw, features, as_of, days)
    mid = stated_mean_years(F.col("exp_min"), F.col("exp_max"))
    parts = joined.select(
        "job_id", "title", "city", "id",
        capped(mid, 10).alias("norm_exp"),
        capped(F.array_size("skills"), 15).alias("norm_skills"),
        capped(F.coalesce(F.col("salary_mid"), F.lit(60000)), 120000).alias("norm_salary"),
        F.when(F.col("remote_type") == "remote", F.lit(0.5)).otherwise(F.lit(0.0)).alias("norm_remote"),
    )
    exact = weighted_score(DIFFICULTY_WEIGHTS) * F.lit(100.0)
    return (
        parts.withColumn("_exact", exact)
        .withColumn("difficulty_score", F.round("_exact", 1))
        .withColumn("difficulty_level", bucket(F.col("_exact"), DIFFICULTY_LIMITS, "Hard"))
        .orderBy("difficulty_score", "job_id", "id")
        .limit(limit)
        .select("job_id", "title", "city", "difficulty_score", "difficulty_level")
    )


def junior_jobs(raw: DataFrame, features: DataFrame) -> DataFrame:
    """Mean experience and number of junior postings per city and role, all time."""
    return (
        postings_with_features(raw, features)
        .groupBy("city", F.col("title").alias("role"))
        .agg(
            F.avg("exp_min").alias("avg_exp"),
            (F.count("*") * F.avg(F.col("is_junior").cast("int"))).alias("junior_jobs"),
        )
        .orderBy(F.desc_nulls_first("junior_jobs"), "city", "role")
    )


def top_skills(features: DataFrame, limit: int = 20) -> DataFrame:
    """Skills as listed, all time."""
    return (
        explode_skills(features.select("skills"))
        .groupBy("skill")
        .agg(F.count("*").alias("demand"))
        .orderBy(F.desc("demand"), "skill")
        .limit(limit)
    )


def city_opportunity_shares(raw: DataFrame, features: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    return (
        recent_with_features(raw, features, as_of, days, "left")
        .groupBy("city", "province")
        .agg(
            F.count("*").alias("total_jobs"),
            percent_of(F.col("is_junior")).alias("junior_pct"),
            percent_of(is_flexible()).alias("remote_pct"),
            F.round(F.avg("salary_mid"), 0).alias("avg_salary"),
        )
        .orderBy(F.desc_nulls_first("junior_pct"), F.desc("remote_pct"), "city", "province")
    )
