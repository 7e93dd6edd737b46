"""Views and market questions over the derived postings."""

from pyspark.sql import functions as F

from marketlens.catalog.fixture import AS_OF
from marketlens.catalog.registry import (
    POSTINGS,
    POSTINGS_AND_FEATURES,
    percent,
    query,
    rounded,
    skills_text,
)
from marketlens.plans import market, views
from marketlens.skills_seed import skill_rows, skills_master

BOTH = POSTINGS_AND_FEATURES
JOIN = "jobs_raw jr JOIN jobs_features jf USING (job_id)"
LEFT = "jobs_raw jr LEFT JOIN jobs_features jf USING (job_id)"
LAST_30 = "posted_date >= DATE '2026-01-21'"
LAST_90 = "posted_date >= DATE '2025-11-22'"
FLEXIBLE = "coalesce(remote_type IN ('remote', 'hybrid'), FALSE)"
MID = "((exp_min + coalesce(exp_max, exp_min)) / CAST(2 AS DOUBLE))"
MASTER = "skills_master(skill, category) AS (VALUES " + ", ".join(
    f"('{skill}', '{category}')" for skill, category, _, _ in skill_rows()
) + ")"
RANK = """CAST(CASE exp_level WHEN 'entry' THEN 1 WHEN 'junior' THEN 2 WHEN 'mid' THEN 3
  WHEN 'senior' THEN 4 WHEN 'lead' THEN 5 ELSE 3 END AS INT)"""

FULL_COLUMNS = f"""job_id, source, title, company, city, province, salary_min, salary_max, salary_mid,
  remote_type, posted_date, url, exp_min, exp_max, CAST(exp_avg AS DOUBLE) AS exp_avg, exp_level,
  {skills_text()} AS skills, is_junior, is_remote,
  CAST(extraction_confidence AS DOUBLE) AS extraction_confidence,
  CAST(date_diff('day', posted_date, DATE '2026-02-20') AS DOUBLE) AS days_since_posted"""


def _plain(df):
    """Lists as text and decimals as doubles."""
    for name, kind in df.dtypes:
        if kind.startswith("decimal"):
            df = df.withColumn(name, F.col(name).cast("double"))
        if kind == "array<string>":
            df = df.withColumn(name, F.concat(F.lit('["'), F.array_join(name, '", "'), F.lit('"]')))
            df = df.withColumn(name, F.replace(name, F.lit('[""]'), F.lit("[]")))
    return df


@query("v1_jobs_full", f"SELECT {FULL_COLUMNS} FROM {LEFT}", BOTH)
def _(fx):
    return _plain(views.jobs_full(fx.raw, fx.features, AS_OF))


@query("v2_recent_jobs", f"SELECT {FULL_COLUMNS} FROM {LEFT} WHERE {LAST_30}", BOTH)
def _(fx):
    return _plain(views.recent_jobs(fx.raw, fx.features, AS_OF))


CITY_FIGURES = f"""count(*) AS total_jobs, {rounded("avg(exp_min)", 1)} AS avg_exp_min,
  {rounded("avg(exp_max)", 1)} AS avg_exp_max, {percent("is_junior")} AS junior_pct,
  {rounded("avg(salary_mid)", 0)} AS avg_salary, {percent(FLEXIBLE)} AS remote_pct,
  max(posted_date) AS latest_posting"""


@query(
    "v3_city_stats",
    f"""SELECT city, province, {CITY_FIGURES}, count(DISTINCT source) AS sources_count
    FROM {LEFT} WHERE {LAST_30} GROUP BY city, province""",
    BOTH,
)
def _(fx):
    return views.city_stats(fx.raw, fx.features, AS_OF)


@query(
    "v4_bi_export",
    f"""SELECT job_id, source, title AS role, company, city, province, posted_date, salary_min,
      salary_max, salary_mid, remote_type, exp_min, exp_max, CAST(exp_avg AS DOUBLE) AS exp_avg,
      exp_level, is_junior, is_remote, {skills_text()} AS skills_json,
      CAST(coalesce(len(skills), 0) AS INT) AS skills_count, {RANK} AS seniority_order, url
    FROM {LEFT} WHERE {LAST_30}""",
    BOTH,
)
def _(fx):
    return _plain(views.bi_export(fx.raw, fx.features, AS_OF))


@query(
    "v5_city_role_stats",
    f"""SELECT city, province, title AS role, {CITY_FIGURES}
    FROM {JOIN} WHERE {LAST_30} GROUP BY city, province, title""",
    BOTH,
)
def _(fx):
    return views.city_role_stats(fx.raw, fx.features, AS_OF)


@query(
    "q1_experience_ladder",
    f"""SELECT title AS role, city, province, {rounded("avg(exp_min)", 1)} AS avg_exp_min,
      {rounded("avg(exp_max)", 1)} AS avg_exp_max, {rounded(f"avg({MID})", 1)} AS avg_exp_mid,
      {percent("is_junior")} AS junior_pct, count(*) AS job_count
    FROM {JOIN} WHERE {LAST_30} AND exp_min IS NOT NULL
    GROUP BY title, city, province HAVING count(*) >= 5
    ORDER BY junior_pct DESC NULLS FIRST, avg_exp_min ASC NULLS LAST, role NULLS FIRST,
      city NULLS FIRST, province NULLS FIRST LIMIT 50""",
    BOTH,
)
def _(fx):
    return market.experience_ladder(fx.raw, fx.features, AS_OF)


@query(
    "q2_skill_demand",
    f"""WITH {MASTER},
    kept AS (
      SELECT title AS role, sm.skill, category, count(*) AS demand_count
      FROM (SELECT title, posted_date, unnest(skills) AS item FROM {JOIN}) e
      JOIN skills_master sm ON sm.skill = lower(trim(item))
      WHERE {LAST_30} GROUP BY title, sm.skill, category HAVING count(*) >= 3),
    postings AS (SELECT title AS role, count(DISTINCT job_id) AS n FROM jobs_raw GROUP BY title)
    SELECT role, skill, category, demand_count,
      {rounded("100.0 * demand_count / sum(demand_count) OVER (PARTITION BY role)", 1)} AS demand_pct,
      {rounded("demand_count / n", 2)} AS penetration_rate
    FROM kept JOIN postings USING (role)
    ORDER BY demand_count DESC, role NULLS FIRST, skill NULLS FIRST LIMIT 100""",
    BOTH,
)
def _(fx):
    return market.skill_demand(fx.raw, fx.features, skills_master(fx.spark), AS_OF)


@query(
    "q3_remote_availability",
    f"""SELECT city, province, title AS role, count(*) AS total_jobs,
      count(*) FILTER (remote_type = 'remote') AS fully_remote_jobs,
      count(*) FILTER (remote_type = 'hybrid') AS hybrid_jobs,
      count(*) FILTER (remote_type = 'onsite') AS onsite_jobs,
      {percent("coalesce(remote_type = 'remote', FALSE)")} AS remote_pct,
      {percent(FLEXIBLE)} AS flexible_pct
    FROM {JOIN} WHERE {LAST_30} GROUP BY city, province, title HAVING count(*) >= 5
    ORDER BY remote_pct DESC, total_jobs DESC, city NULLS FIRST, province NULLS FIRST,
      role NULLS FIRST LIMIT 50""",
    BOTH,
)
def _(fx):
    return market.remote_availability(fx.raw, fx.features, AS_OF)


@query(
    "q4_salary_percentiles",
    f"""SELECT city, province, title AS role, exp_level, count(*) AS job_count,
      {rounded("avg(salary_min)", 0)} AS avg_salary_min, {rounded("avg(salary_max)", 0)} AS avg_salary_max,
      {rounded("avg(salary_mid)", 0)} AS avg_salary_mid,
      round_even(quantile_cont(CAST(salary_mid AS DOUBLE), 0.25), 0) AS p25_salary,
      round_even(quantile_cont(CAST(salary_mid AS DOUBLE), 0.5), 0) AS median_salary,
      round_even(quantile_cont(CAST(salary_mid AS DOUBLE), 0.75), 0) AS p75_salary
    FROM {JOIN} WHERE {LAST_30} AND salary_mid BETWEEN 30000 AND 250000
    GROUP BY city, province, title, exp_level HAVING count(*) >= 3
    ORDER BY avg_salary_mid DESC NULLS FIRST, city NULLS FIRST, province NULLS FIRST,
      role NULLS FIRST, exp_level NULLS FIRST LIMIT 100""",
    BOTH,
)
def _(fx):
    return market.salary_percentiles(fx.raw, fx.features, AS_OF)


@query(
    "q5_city_opportunity",
    f"""WITH cities AS (
      SELECT city, province, count(*) AS total_jobs, avg({MID}) AS avg_exp,
        avg(CAST(is_junior AS INT)) AS junior_ratio, avg(CAST({FLEXIBLE} AS INT)) AS remote_ratio,
        avg(salary_mid) AS avg_salary, {percent("is_junior")} AS junior_pct,
        {percent(FLEXIBLE)} AS remote_pct
      FROM {JOIN} WHERE {LAST_30} GROUP BY city, province HAVING count(*) >= 10),
    scaled AS (
      SELECT *,
        (total_jobs - min(total_jobs) OVER ()) / CAST(nullif(max(total_jobs) OVER () - min(total_jobs) OVER (), 0) AS DOUBLE) AS norm_jobs,
        1 - (avg_exp - min(avg_exp) OVER ()) / nullif(max(avg_exp) OVER () - min(avg_exp) OVER (), 0) AS norm_low_exp,
        (avg_salary - min(avg_salary) OVER ()) / nullif(max(avg_salary) OVER () - min(avg_salary) OVER (), 0) AS norm_salary
      FROM cities)
    SELECT city, province, total_jobs, {rounded("avg_exp", 1)} AS avg_exp_years, junior_pct, remote_pct,
      {rounded("avg_salary", 0)} AS avg_salary_cad,
      {rounded('''(coalesce(junior_ratio, 0) * 0.30 + coalesce(remote_ratio, 0) * 0.25 + coalesce(norm_jobs, 0) * 0.20
        + coalesce(norm_low_exp, 0) * 0.15 + coalesce(norm_salary, 0) * 0.10) * 100''', 1)} AS opportunity_score
    FROM scaled""",
    BOTH,
)
def _(fx):
    return market.city_opportunity(fx.raw, fx.features, AS_OF)


@query(
    "q6_skill_cooccurrence",
    f"""WITH listed AS (
      SELECT job_id, title AS role, unnest(skills) AS skill FROM {JOIN}
      WHERE {LAST_30} AND len(skills) > 0),
    totals AS (SELECT skill, count(DISTINCT job_id) AS n FROM listed GROUP BY skill)
    SELECT a.role, a.skill AS skill_1, b.skill AS skill_2,
      count(DISTINCT a.job_id) AS co_occurrence_count,
      {rounded("100.0 * count(DISTINCT a.job_id) / any_value(totals.n)", 1)} AS co_occurrence_pct
    FROM listed a JOIN listed b ON a.job_id = b.job_id AND a.skill < b.skill
    JOIN totals ON totals.skill = a.skill
    GROUP BY a.role, a.skill, b.skill HAVING count(DISTINCT a.job_id) >= 5
    ORDER BY co_occurrence_count DESC, a.role NULLS FIRST, skill_1, skill_2 LIMIT 100""",
    BOTH,
)
def _(fx):
    return market.skill_cooccurrence(fx.raw, fx.features, AS_OF)


def _trend_sql(source: str, day: str, keys: str, since: str, tail: str) -> str:
    return f"""WITH counted AS (
      SELECT CAST(date_trunc('week', {day}) AS DATE) AS week_start, {keys}, count(*) AS jobs_posted
      FROM {source} WHERE {since} GROUP BY ALL HAVING count(*) >= 3),
    paired AS (
      SELECT *, lag(jobs_posted) OVER (PARTITION BY {keys} ORDER BY week_start) AS prev_week_jobs
      FROM counted)
    SELECT *, {rounded("100.0 * (jobs_posted - prev_week_jobs) / nullif(prev_week_jobs, 0)", 1)}
      AS week_over_week_change_pct
    FROM paired ORDER BY week_start DESC NULLS FIRST, jobs_posted DESC, {tail}"""


@query(
    "q7_weekly_trend",
    _trend_sql(
        "(SELECT *, title AS role FROM jobs_raw) r", "posted_date", "city, role", LAST_90,
        "city NULLS FIRST, role NULLS FIRST LIMIT 200",
    ),
    POSTINGS,
)
def _(fx):
    return market.posting_trend(fx.raw, AS_OF)


@query(
    "q7_weekly_trend_of_events",
    _trend_sql("events", "ts", "event_type", "TRUE", "event_type"),
)
def _(fx):
    return market.weekly_trend(
        fx.table("events"), AS_OF, ["event_type"], day="ts", days=0, limit=None
    )


@query(
    "q8_entry_level_finder",
    f"""SELECT job_id, title, company, city, province, exp_min, exp_max, exp_level, salary_min,
      salary_max, remote_type, {skills_text()} AS skills, posted_date, url,
      CAST(CASE WHEN exp_min = 0 THEN 40 WHEN exp_min <= 1 THEN 30 ELSE 0 END
        + CASE WHEN {FLEXIBLE} THEN 20 ELSE 0 END
        + CASE WHEN salary_min >= 50000 THEN 20 ELSE 10 END
        + CASE WHEN len(skills) <= 5 THEN 20 ELSE 10 END AS DOUBLE) AS entry_level_score
    FROM {JOIN} WHERE {LAST_30} AND is_junior
      AND city IN ('Toronto', 'Saskatoon', 'Regina', 'Calgary', 'Edmonton', 'Winnipeg', 'Vancouver')
    ORDER BY entry_level_score DESC, posted_date DESC NULLS FIRST, job_id, title, url LIMIT 100""",
    BOTH,
)
def _(fx):
    return market.entry_level_finder(fx.raw, fx.features, AS_OF)


@query(
    "q9_skill_gap",
    f"""WITH {MASTER},
    demand AS (
      SELECT sm.skill, category, count(DISTINCT job_id) AS jobs_requiring,
        {rounded("100.0 * count(DISTINCT job_id) / (SELECT count(*) FROM jobs_features)", 1)} AS market_demand_pct
      FROM (SELECT job_id, unnest(skills) AS item FROM jobs_features) e
      JOIN skills_master sm ON sm.skill = lower(trim(item))
      WHERE job_id IN (SELECT job_id FROM jobs_raw WHERE {LAST_30})
      GROUP BY sm.skill, category)
    SELECT *, CASE WHEN skill IN ('python', 'sql', 'excel') THEN 'Have' ELSE 'Missing' END AS skill_status,
      CASE WHEN skill IN ('python', 'sql', 'excel') THEN 0.0::DOUBLE ELSE market_demand_pct END AS learning_priority
    FROM demand WHERE jobs_requiring >= 10
    ORDER BY learning_priority DESC, market_demand_pct DESC, skill LIMIT 20""",
    BOTH,
)
def _(fx):
    have = ["python", "sql", "excel"]
    return market.skill_gap(fx.raw, fx.features, skills_master(fx.spark), have, AS_OF)


@query(
    "q10_job_difficulty",
    f"""WITH parts AS (
      SELECT job_id, id, title, city,
        least({MID} / 10.0, 1.0::DOUBLE) AS norm_exp,
        least(len(skills) / 15.0::DOUBLE, 1.0::DOUBLE) AS norm_skills,
        least(coalesce(salary_mid, 60000) / 120000.0::DOUBLE, 1.0::DOUBLE) AS norm_salary,
        CASE WHEN remote_type = 'remote' THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS norm_remote
      FROM {JOIN} WHERE {LAST_30}),
    scored AS (
      SELECT *, (norm_exp * 0.40::DOUBLE + norm_skills * 0.30::DOUBLE + norm_salary * 0.20::DOUBLE
        + norm_remote * 0.10::DOUBLE) * 100.0::DOUBLE AS exact FROM parts)
    SELECT job_id, title, city, round(exact, 1) AS difficulty_score,
      CASE WHEN exact < 30 THEN 'Easy' WHEN exact < 60 THEN 'Medium' ELSE 'Hard' END AS difficulty_level
    FROM scored ORDER BY difficulty_score, job_id, id LIMIT 100""",
    BOTH,
)
def _(fx):
    return market.job_difficulty(fx.raw, fx.features, AS_OF)


@query(
    "q11_bi_dataset",
    f"""SELECT job_id, source, title AS role, company, city, province, posted_date,
      strftime(scraped_at, '%Y-%m-%d %H:%M:%S') AS scraped_at,
      CAST(date_diff('day', posted_date, DATE '2026-02-20') AS DOUBLE) AS days_since_posted,
      salary_min, salary_max, salary_mid, remote_type, is_remote, exp_min, exp_max, {MID} AS exp_avg,
      exp_level, is_junior, {skills_text()} AS skills_json,
      CAST(coalesce(len(skills), 0) AS INT) AS skills_count, {RANK} AS seniority_order, url
    FROM {LEFT} WHERE {LAST_30}""",
    BOTH,
)
def _(fx):
    rows = views.bi_dataset(fx.raw, fx.features, AS_OF)
    return rows.withColumn("scraped_at", F.date_format("scraped_at", "yyyy-MM-dd HH:mm:ss"))


@query(
    "q12_junior_jobs",
    f"""SELECT city, title AS role, avg(exp_min) AS avg_exp,
      count(*) * avg(CAST(is_junior AS INT)) AS junior_jobs
    FROM {JOIN} GROUP BY city, title""",
    BOTH,
)
def _(fx):
    return market.junior_jobs(fx.raw, fx.features)


@query(
    "q13_top_skills",
    """SELECT skill, count(*) AS demand FROM (SELECT unnest(skills) AS skill FROM jobs_features) e
    GROUP BY skill ORDER BY demand DESC, skill LIMIT 20""",
    BOTH,
)
def _(fx):
    return market.top_skills(fx.features)


@query(
    "q14_city_opportunity_shares",
    f"""SELECT city, province, count(*) AS total_jobs, {percent("is_junior")} AS junior_pct,
      {percent(FLEXIBLE)} AS remote_pct, {rounded("avg(salary_mid)", 0)} AS avg_salary
    FROM {LEFT} WHERE {LAST_30} GROUP BY city, province""",
    BOTH,
)
def _(fx):
    return market.city_opportunity_shares(fx.raw, fx.features, AS_OF)
