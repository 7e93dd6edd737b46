"""Overview figures for the command line, the dashboard and progress checks.

`days` = 0 means all time. `hide_bad_salaries` leaves out postings whose salary is not an
annual amount, as the dashboard does.
"""

from datetime import date

from pyspark.sql import DataFrame, functions as F

from marketlens import fixed_values as V
from marketlens.functions.dates import within_days
from marketlens.functions.experience import is_junior_unless_unknown, mean_years
from marketlens.functions.salary import plausible
from marketlens.functions.skills import clean_skill
from marketlens.operators.rows import explode_skills, newest_first, postings_with_features
from marketlens.plans.views import is_flexible, percent_of


def scope(raw: DataFrame, as_of: date, days: int, hide_bad_salaries: bool = False) -> DataFrame:
    """The postings a report looks at."""
    rows = raw.where(within_days(F.col("posted_date"), as_of, days))
    if hide_bad_salaries:
        rows = rows.where(plausible(F.col("salary_min"), F.col("salary_max"), F.col("salary_mid")))
    return rows


def counted(rows: DataFrame, keys: list[str], name: str = "cnt", limit: int | None = None) -> DataFrame:
    """Rows per key, most first."""
    out = rows.groupBy(*keys).agg(F.count("*").alias(name)).orderBy(F.desc(name), *keys)
    return out if limit is None else out.limit(limit)


def totals(raw: DataFrame, features: DataFrame) -> DataFrame:
    """Postings, postings with features, coverage in percent."""
    marked = raw.select("job_id").join(
        features.select("job_id", F.lit(1).alias("_has")), "job_id", "left"
    )
    return marked.agg(
        F.count("*").alias("total"), F.count("_has").alias("with_features")
    ).withColumn("coverage_pct", _coverage("with_features", "total"))


def _coverage(part: str, whole: str):
    share = F.lit(100.0) * F.col(part) / F.nullif(F.col(whole), F.lit(0))
    return F.coalesce(F.round(share, 1), F.lit(0.0))


def average_salary(raw: DataFrame, at_least: int = 1) -> DataFrame:
    """Mean stored midpoint over postings that reach `at_least`."""
    return raw.where(F.col("salary_mid") >= at_least).agg(
        F.round(F.avg("salary_mid"), 0).alias("avg_sal"), F.count("*").alias("n")
    )


def remote_share(raw: DataFrame, features: DataFrame) -> DataFrame:
    joined = postings_with_features(
        raw.select("job_id", "remote_type"), features.select("job_id", "is_remote"), "left"
    )
    flexible = F.coalesce(F.col("is_remote"), F.lit(False)) | is_flexible()
    return joined.agg(percent_of(flexible).alias("remote_pct"))


def short_ladder(
    raw: DataFrame, features: DataFrame, limit: int, min_jobs: int = 3, unknown_is_senior: bool = False
) -> DataFrame:
    """City and role by junior share; the dashboard counts an unknown end as 99 years."""
    low, high = F.col("exp_min"), F.col("exp_max")
    junior = is_junior_unless_unknown(low, high) if unknown_is_senior else F.col("is_junior")
    stated = features.where(low.isNotNull() | high.isNotNull())
    return (
        postings_with_features(raw.select("job_id", "city", "title"), stated)
        .groupBy("city", "title")
        .agg(
            F.round(F.avg(mean_years(low, high)), 1).alias("avg_exp"),
            percent_of(junior).alias("junior_pct"),
            F.count("*").alias("n"),
        )
        .where(F.col("n") >= min_jobs)
        .orderBy(F.desc_nulls_first("junior_pct"), "avg_exp", "city", "title")
        .limit(limit)
    )


def mentioned_skills(raw: DataFrame | None, features: DataFrame, limit: int) -> DataFrame:
    """Most listed skills; without postings (all time) the features are read alone."""
    listed = features.select("job_id", "skills")
    if raw is not None:
        listed = raw.select("job_id").join(listed, "job_id")
    return counted(
        explode_skills(listed).select(clean_skill(F.col("skill")).alias("sk")), ["sk"], limit=limit
    )


def table_counts(**tables: DataFrame) -> DataFrame:
    """Row count per named table."""
    parts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def filter_provinces(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("province").isNotNull()).select("province").distinct().orderBy("province")


def filter_cities(raw: DataFrame, limit: int = 80) -> DataFrame:
    return counted(raw, ["city"], limit=limit).select("city")


def progress(raw: DataFrame, features: DataFrame, target: int = 5000) -> DataFrame:
    """Collected against the target, coverage, remaining and estimated minutes."""
    counts = raw.agg(
        F.count("*").alias("total_jobs"),
        features.agg(F.count("*").alias("n")).scalar().alias("total_features"),
    )
    # Fixed value: half a second per posting.
    remaining = F.greatest(F.lit(target) - F.col("total_jobs"), F.lit(0))
    return (
        counts.withColumn("progress_pct", F.round(F.lit(100.0) * F.col("total_jobs") / F.lit(target), 1))
        .withColumn("coverage_pct", _coverage("total_features", "total_jobs"))
        .withColumn("remaining", remaining)
        .withColumn("minutes_left", F.col("remaining") * F.lit(0.5) / F.lit(60.0))
    )


def latest_rows(df: DataFrame, by: str, columns: list[str], tie: str, limit: int) -> DataFrame:
    return df.orderBy(F.desc_nulls_first(by), F.desc(tie)).limit(limit).select(*columns)


def recent_additions(raw: DataFrame, limit: int = 10) -> DataFrame:
    return latest_rows(raw, "created_at", ["id", "title", "city", "province"], "id", limit)


def recent_runs(metrics: DataFrame, limit: int = 5) -> DataFrame:
    return latest_rows(metrics, "run_date", ["run_id", "jobs_collected", "jobs_valid"], "run_id", limit)


def bad_salary_postings(
    raw: DataFrame, source: str = "jobbank", threshold: int = V.MIN_ANNUAL_SALARY, limit: int = 0
) -> DataFrame:
    """Postings of one source to read again; those without any salary are included because
    their stored midpoint is 0."""
    low = F.coalesce("salary_max", "salary_mid") < threshold
    found = (
        raw.where((F.col("source") == source) & F.col("url").isNotNull())
        .where(low | F.coalesce(F.col("salary_min") < threshold, F.lit(False)))
        .orderBy(newest_first(), "id")
        .select("job_id", "url", "title", "salary_min", "salary_max")
    )
    return found.limit(limit) if limit > 0 else found


def row_sample(raw: DataFrame, limit: int = 15) -> DataFrame:
    return raw.orderBy("id").limit(limit).select(
        "id", "title", "salary_min", "salary_max", "city", "province"
    )


def skills_per_category(skills: DataFrame) -> DataFrame:
    return counted(skills, ["category"], "skills")


def relevant_skills(skills: DataFrame, role: str) -> DataFrame:
    """Skills that matter for a role, most relevant first."""
    score = F.try_element_at("role_relevance", F.lit(role))
    return (
        skills.select("skill", score.alias("relevance"))
        .where(F.col("relevance").isNotNull())
        .orderBy(F.desc("relevance"), "skill")
    )


def skills_by_category(skills: DataFrame, limit: int = 20) -> DataFrame:
    """First skills by category and name with their number of other spellings (NULL for none)."""
    return (
        skills.select(
            "category", "skill", F.nullif(F.size("aliases"), F.lit(0)).alias("alias_count")
        )
        .orderBy("category", "skill")
        .limit(limit)
    )


def source_requests(log: DataFrame) -> DataFrame:
    """Per source: requests, errors, postings of good requests, success rate in percent."""
    return (
        log.groupBy("source")
        .agg(
            F.count("*").alias("requests"),
            F.count_if(~F.col("success")).alias("errors"),
            F.sum(F.when(F.col("success"), F.col("jobs")).otherwise(0)).alias("jobs"),
        )
        .withColumn(
            "success_rate",
            F.round(F.lit(100.0) * (F.col("requests") - F.col("errors")) / F.col("requests"), 1),
        )
    )


def run_alerts(
    runs: DataFrame, min_jobs: int = V.ALERT_MIN_JOBS, max_errors: int = V.ALERT_MAX_ERRORS,
    min_rate: float = V.ALERT_MIN_SUCCESS_RATE,
) -> DataFrame:
    """Alert flags per run (needs the derived rates)."""
    return runs.withColumns(
        {
            "few_jobs": F.col("jobs_collected") < min_jobs,
            "many_errors": F.col("jobs_failed") > max_errors,
            "low_quality": F.col("validation_rate").cast("double") < min_rate,
        }
    )
