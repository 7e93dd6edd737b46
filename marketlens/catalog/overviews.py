"""Overview, search and progress queries over the derived postings."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from marketlens.catalog.fixture import AS_OF
from marketlens.catalog.registry import POSTINGS, POSTINGS_AND_FEATURES, percent, query, rounded
from marketlens.catalog.reports import FLEXIBLE, JOIN, LAST_30, LAST_90, LEFT
from marketlens.operators import quality, store
from marketlens.plans import overview, search, views

BOTH = POSTINGS_AND_FEATURES
PLAUSIBLE = """((salary_min IS NULL AND salary_max IS NULL)
  OR coalesce(salary_max, salary_mid) >= 10000)"""
SHOWN = f"{LAST_90} AND {PLAUSIBLE}"
REMOTE = f"(coalesce(is_remote, FALSE) OR {FLEXIBLE})"
FULL_MID = "((coalesce(exp_min, 0) + coalesce(exp_max, exp_min, 0)) / CAST(2 AS DOUBLE))"
LATE_JUNIOR = "((coalesce(exp_min, 99) + coalesce(exp_max, exp_min, 99)) / 2.0 <= 2)"
DAYS = 90


def _analysed(fx):
    return overview.scope(fx.raw, AS_OF, DAYS)


def _shown(fx):
    return overview.scope(fx.raw, AS_OF, DAYS, hide_bad_salaries=True)


def _top(keys: str, where: str, limit: int | None = None) -> str:
    order = ", ".join(f"{k.strip()} NULLS FIRST" for k in keys.split(","))
    top = "" if limit is None else f" ORDER BY cnt DESC, {order} LIMIT {limit}"
    return f"SELECT {keys}, count(*) AS cnt FROM jobs_raw WHERE {where} GROUP BY {keys}{top}"


def _totals_sql(where: str) -> str:
    return f"""SELECT count(*) AS total, count(jf.job_id) AS with_features,
      {rounded("100.0 * count(jf.job_id) / count(*)", 1)} AS coverage_pct
    FROM jobs_raw jr LEFT JOIN jobs_features jf ON jr.job_id = jf.job_id WHERE {where}"""


def _skills_sql(where: str, limit: int) -> str:
    return f"""SELECT lower(trim(item)) AS sk, count(*) AS cnt
    FROM (SELECT unnest(skills) AS item FROM {JOIN} WHERE {where}) e
    GROUP BY sk ORDER BY cnt DESC, sk LIMIT {limit}"""


def _ladder_sql(where: str, junior: str, limit: int) -> str:
    return f"""SELECT city, title, {rounded(f"avg({FULL_MID})", 1)} AS avg_exp,
      {percent(junior)} AS junior_pct, count(*) AS n
    FROM {JOIN} WHERE (exp_min IS NOT NULL OR exp_max IS NOT NULL) AND {where}
    GROUP BY city, title HAVING count(*) >= 3
    ORDER BY junior_pct DESC NULLS FIRST, avg_exp, city NULLS FIRST, title NULLS FIRST LIMIT {limit}"""


# Command-line overview.


@query("q15_overview_totals", _totals_sql(LAST_90), BOTH)
def _(fx):
    return overview.totals(_analysed(fx), fx.features)


@query("q16a_by_source", _top("source", LAST_90), POSTINGS)
def _(fx):
    return overview.counted(_analysed(fx), ["source"])


@query("q16b_top_cities", _top("city, province", LAST_90, 10), POSTINGS)
def _(fx):
    return overview.counted(_analysed(fx), ["city", "province"], limit=10)


@query("q16c_top_roles", _top("title", LAST_90, 15), POSTINGS)
def _(fx):
    return overview.counted(_analysed(fx), ["title"], limit=15)


@query(
    "q16d_average_salary",
    f"""SELECT {rounded("avg(salary_mid)", 0)} AS avg_sal, count(*) AS n FROM jobs_raw
    WHERE salary_mid > 0 AND {LAST_90}""",
    POSTINGS,
)
def _(fx):
    return overview.average_salary(_analysed(fx))


@query("q16e_remote_share", f"SELECT {percent(REMOTE)} AS remote_pct FROM {LEFT} WHERE {LAST_90}", BOTH)
def _(fx):
    return overview.remote_share(_analysed(fx), fx.features)


@query("q16f_top_skills", _skills_sql(LAST_90, 15), BOTH)
def _(fx):
    return overview.mentioned_skills(_analysed(fx), fx.features, 15)


@query(
    "q16f_top_skills_all_time",
    """SELECT lower(trim(item)) AS sk, count(*) AS cnt
    FROM (SELECT unnest(skills) AS item FROM jobs_features) e
    GROUP BY sk ORDER BY cnt DESC, sk LIMIT 15""",
    BOTH,
)
def _(fx):
    return overview.mentioned_skills(None, fx.features, 15)


@query("q17_short_ladder", _ladder_sql(LAST_90, "is_junior", 10), BOTH)
def _(fx):
    return overview.short_ladder(_analysed(fx), fx.features, limit=10)


# Dashboard overview: the same figures without implausible salaries.


@query("q18a_totals", _totals_sql(SHOWN), BOTH)
def _(fx):
    return overview.totals(_shown(fx), fx.features)


@query("q18b_by_source", _top("source", SHOWN), POSTINGS)
def _(fx):
    return overview.counted(_shown(fx), ["source"])


@query("q18c_top_cities", _top("city, province", SHOWN, 12), POSTINGS)
def _(fx):
    return overview.counted(_shown(fx), ["city", "province"], limit=12)


@query("q18d_top_roles", _top("title", SHOWN, 12), POSTINGS)
def _(fx):
    return overview.counted(_shown(fx), ["title"], limit=12)


@query("q18e_top_skills", _skills_sql(SHOWN, 12), BOTH)
def _(fx):
    return overview.mentioned_skills(_shown(fx), fx.features, 12)


@query(
    "q18f_average_salary",
    f"""SELECT {rounded("avg(salary_mid)", 0)} AS avg_sal, count(*) AS n FROM jobs_raw
    WHERE salary_mid >= 10000 AND {LAST_90}""",
    POSTINGS,
)
def _(fx):
    return overview.average_salary(_analysed(fx), at_least=10000)


@query("q18g_remote_share", f"SELECT {percent(REMOTE)} AS remote_pct FROM {LEFT} WHERE {SHOWN}", BOTH)
def _(fx):
    return overview.remote_share(_shown(fx), fx.features)


@query("q18h_short_ladder", _ladder_sql(SHOWN, LATE_JUNIOR, 15), BOTH)
def _(fx):
    return overview.short_ladder(_shown(fx), fx.features, limit=15, unknown_is_senior=True)


# Table checks.


@query(
    "q19_null_critical_fields",
    """SELECT count(*) AS null_jobs
    FROM jobs_raw jr LEFT JOIN jobs_features jf ON jr.job_id = jf.job_id
    WHERE jr.title IS NULL OR jr.city IS NULL OR jf.job_id IS NULL""",
    BOTH,
)
def _(fx):
    return quality.null_critical_fields(fx.raw, fx.features)


@query(
    "q20_date_span",
    """SELECT min(posted_date) AS earliest, max(posted_date) AS latest,
      CAST(date_diff('day', min(posted_date), DATE '2026-02-20') AS INT) AS days_span FROM jobs_raw""",
    POSTINGS,
)
def _(fx):
    return quality.date_span_report(fx.raw, AS_OF)


@query(
    "q21_extraction_rate",
    f"""SELECT count(*) AS total_jobs, count(*) FILTER (len(skills) > 0) AS jobs_with_skills,
      {rounded("100.0 * count(*) FILTER (len(skills) > 0) / count(*)", 1)} AS extraction_rate
    FROM jobs_features""",
    BOTH,
)
def _(fx):
    return quality.extraction_rate(fx.features)


@query(
    "q22_source_distribution",
    "SELECT source, count(*) AS count FROM jobs_raw GROUP BY source",
    POSTINGS,
)
def _(fx):
    return quality.source_distribution(fx.raw)


# Search.


@query(
    "q23a_filter_provinces",
    "SELECT DISTINCT province FROM jobs_raw WHERE province IS NOT NULL",
    POSTINGS,
)
def _(fx):
    return overview.filter_provinces(fx.raw)


@query(
    "q23b_filter_cities",
    """SELECT city FROM (SELECT city, count(*) AS n FROM jobs_raw GROUP BY city
    ORDER BY n DESC, city LIMIT 80) c""",
    POSTINGS,
)
def _(fx):
    return overview.filter_cities(fx.raw)


LISTED = "title, company, city, province, source, posted_date, url"
NEWEST = "ORDER BY posted_date DESC NULLS FIRST, id"


@query(
    "q24_filter_search",
    f"""SELECT {LISTED}, salary_min, salary_max FROM jobs_raw
    WHERE title ILIKE '%senior%' AND title ILIKE '%data%' AND province = 'ON' AND city = 'Toronto'
      AND lower(coalesce(remote_type, '')) IN ('remote', 'hybrid')
      AND coalesce(salary_max, salary_mid) >= 20000 AND coalesce(salary_min, salary_mid) <= 150000
      AND {LAST_90} AND {PLAUSIBLE} {NEWEST} LIMIT 200""",
    POSTINGS,
)
def _(fx):
    spec = search.FilterSpec(
        keywords=" Senior  data ", province="ON", city="Toronto", remote_type="remote_or_hybrid",
        salary_min=20000, salary_max=150000, posted_days=90,
    )
    return search.filter_search(fx.raw, spec, AS_OF)


@query(
    "q24_filter_search_open",
    f"""SELECT {LISTED}, salary_min, salary_max FROM jobs_raw
    WHERE lower(coalesce(remote_type, '')) = 'onsite' AND coalesce(salary_min, salary_mid) <= 60000
      AND {PLAUSIBLE} {NEWEST} LIMIT 200""",
    POSTINGS,
)
def _(fx):
    spec = search.FilterSpec(remote_type="Onsite", salary_max=60000)
    return search.filter_search(fx.raw, spec, AS_OF)


@query(
    "q25_phrase_search",
    f"""SELECT {LISTED} FROM jobs_raw
    WHERE title ILIKE '%data%analyst%' AND city ILIKE '%toronto%' AND {PLAUSIBLE} {NEWEST} LIMIT 100""",
    POSTINGS,
)
def _(fx):
    return search.phrase_search(fx.raw, "Find me data%analyst in toronto")


ASKED = [
    "show me data engineer in Toronto", "jobs in Toronto in Canada", "get jobs qa_ in reg", "analyst in Ottawa within last 5 days",
    "job in in Ottawa", "Find me show me lead % in mont", "web developer in " + 60 * "x", "data in o in t",
]


@query(
    "q25_asked_phrases",
    f"""SELECT phrase, {LISTED} FROM (SELECT *, row_number() OVER (PARTITION BY phrase {NEWEST}) AS place FROM (
      SELECT 0 AS phrase, * FROM jobs_raw WHERE title ILIKE '%data engineer%' AND city ILIKE '%Toronto%'
      UNION ALL SELECT 2, * FROM jobs_raw WHERE title ILIKE '%qa_%' AND city ILIKE '%reg%'
      UNION ALL SELECT 5, * FROM jobs_raw WHERE title ILIKE '%lead %%' AND city ILIKE '%mont%'
      UNION ALL SELECT 7, * FROM jobs_raw WHERE title ILIKE '%data%' AND city ILIKE '%o in t%') u WHERE {PLAUSIBLE}) r
    WHERE place <= 100""",
    POSTINGS,
)
def _(fx):
    """Every phrase with what it finds; those that the rule does not answer find nothing."""
    found = [(n, search.phrase_search(fx.raw, phrase)) for n, phrase in enumerate(ASKED)]
    parts = [df.select(F.lit(n).alias("phrase"), *search.LISTED) for n, df in found if df is not None]
    return reduce(DataFrame.unionByName, parts)


@query(
    "q31a_role_city_recent",
    f"""SELECT {LISTED} FROM jobs_raw
    WHERE title ILIKE '%Data Analyst%' AND city ILIKE '%Toronto%' AND posted_date >= DATE '2026-02-15'
    ORDER BY posted_date DESC NULLS LAST, id LIMIT 100""",
    POSTINGS,
)
def _(fx):
    return search.role_city_recent(fx.raw, "Data Analyst", "Toronto", 5, AS_OF)


@query(
    "q31b_remote_keyword",
    f"""SELECT {LISTED} FROM jobs_raw
    WHERE (remote_type IN ('remote', 'hybrid') OR title ILIKE '%remote%') AND title ILIKE '%Data%'
    ORDER BY posted_date DESC NULLS LAST, id LIMIT 100""",
    POSTINGS,
)
def _(fx):
    return search.remote_keyword(fx.raw, "Data")


@query(
    "p7_guarded_sql",
    """SELECT source, city, count(*) AS n FROM jobs_raw GROUP BY source, city
    ORDER BY n DESC, source, city LIMIT 100""",
    POSTINGS,
)
def _(fx):
    fx.raw.createOrReplaceTempView("jobs_raw")
    text = "select source, city, count(*) AS n FROM jobs_raw GROUP BY source, city ORDER BY n DESC, source, city; x"
    return search.guarded_sql(fx.spark, text)


@query(
    "p7_guarded_sql_on_view",
    f"""SELECT city, province, count(*) AS total_jobs FROM {LEFT} WHERE {LAST_30}
    GROUP BY city, province ORDER BY total_jobs DESC, city NULLS FIRST, province NULLS FIRST LIMIT 7""",
    BOTH,
)
def _(fx):
    views.register_views(fx.raw, fx.features, AS_OF)
    return search.guarded_sql(
        fx.spark, "SELECT city, province, total_jobs FROM vw_city_stats ORDER BY total_jobs DESC, city, province LIMIT 7"
    )


# Statistics and progress.


@query(
    "q26a_table_counts",
    """SELECT 'jobs_raw' AS table_name, (SELECT count(*) FROM jobs_raw) AS rows
    UNION ALL SELECT 'jobs_features', (SELECT count(*) FROM jobs_features)
    UNION ALL SELECT 'scraper_metrics', (SELECT count(*) FROM scraper_metrics)""",
    (*BOTH, "scraper_metrics"),
)
def _(fx):
    return overview.table_counts(
        jobs_raw=fx.raw, jobs_features=fx.features, scraper_metrics=fx.metrics
    )


@query("q26b_jobs_by_source", _top("source", "TRUE"), POSTINGS)
def _(fx):
    return overview.counted(fx.raw, ["source"])


@query("q26c_top_cities", _top("city", "TRUE", 10), POSTINGS)
def _(fx):
    return overview.counted(fx.raw, ["city"], limit=10)


@query(
    "q27a_progress",
    f"""WITH counts AS (
      SELECT (SELECT count(*) FROM jobs_raw) AS total_jobs, (SELECT count(*) FROM jobs_features) AS total_features)
    SELECT total_jobs, total_features, {rounded("100.0 * total_jobs / 50000", 1)} AS progress_pct,
      {rounded("100.0 * total_features / total_jobs", 1)} AS coverage_pct,
      greatest(50000 - total_jobs, 0) AS remaining,
      greatest(50000 - total_jobs, 0) * 0.5::DOUBLE / 60.0::DOUBLE AS minutes_left
    FROM counts""",
    BOTH,
)
def _(fx):
    return overview.progress(fx.raw, fx.features, target=50000)


@query("q27b_top_cities", _top("city", "TRUE", 15), POSTINGS)
def _(fx):
    return overview.counted(fx.raw, ["city"], limit=15)


@query(
    "q27c_recent_additions",
    """SELECT id, title, city, province FROM jobs_raw
    ORDER BY created_at DESC NULLS FIRST, id DESC LIMIT 10""",
    POSTINGS,
)
def _(fx):
    return overview.recent_additions(fx.raw)


@query(
    "q27d_recent_runs",
    """SELECT run_id, jobs_collected, jobs_valid FROM scraper_metrics
    ORDER BY run_date DESC NULLS FIRST, run_id DESC LIMIT 5""",
    ("scraper_metrics",),
)
def _(fx):
    return overview.recent_runs(fx.metrics)


@query(
    "q28_bad_salary_postings",
    f"""SELECT job_id, url, title, salary_min, salary_max FROM jobs_raw
    WHERE source = 'jobbank' AND url IS NOT NULL
      AND (coalesce(salary_max, salary_mid) < 10000 OR (salary_min IS NOT NULL AND salary_min < 10000))""",
    POSTINGS,
)
def _(fx):
    return overview.bad_salary_postings(fx.raw)


@query(
    "q28_bad_salary_postings_limited",
    f"""SELECT job_id, url, title, salary_min, salary_max FROM jobs_raw
    WHERE source = 'jobbank' AND url IS NOT NULL
      AND (coalesce(salary_max, salary_mid) < 10000 OR (salary_min IS NOT NULL AND salary_min < 10000))
    {NEWEST} LIMIT 50""",
    POSTINGS,
)
def _(fx):
    return overview.bad_salary_postings(fx.raw, limit=50)


@query(
    "q30_row_sample",
    "SELECT id, title, salary_min, salary_max, city, province FROM jobs_raw ORDER BY id LIMIT 15",
    POSTINGS,
)
def _(fx):
    return overview.row_sample(fx.raw)


# Skill dimension, on the one derived from parts.


def _dimension(fx):
    scores = F.when(
        F.col("p_size") % 3 == 0,
        F.create_map(F.lit("data_analyst"), F.col("p_size") / F.lit(64.0)),
    ).otherwise(F.create_map(F.lit("devops"), F.lit(0.5)))
    return fx.part_skills.withColumn("role_relevance", scores)


@query(
    "q29a_skills_per_category",
    "SELECT category, count(*) AS skills FROM part_skills GROUP BY category",
    ("part_skills",),
)
def _(fx):
    return overview.skills_per_category(_dimension(fx))


@query(
    "q29b_relevant_skills",
    "SELECT skill, p_size / 64.0::DOUBLE AS relevance FROM part_skills WHERE p_size % 3 = 0",
    ("part_skills",),
)
def _(fx):
    return overview.relevant_skills(_dimension(fx), "data_analyst")


@query(
    "q29c_skills_by_category",
    """SELECT category, skill, CAST(nullif(len(aliases), 0) AS INT) AS alias_count FROM part_skills
    ORDER BY category, skill LIMIT 20""",
    ("part_skills",),
)
def _(fx):
    return overview.skills_by_category(_dimension(fx))


# Run metrics.


RATES = f"""SELECT run_id, jobs_collected, jobs_failed,
  CAST(CASE WHEN jobs_collected > 0 THEN collection_time_ms // jobs_collected ELSE 0 END AS INT) AS avg_collection_time_ms,
  CASE WHEN jobs_collected > 0 THEN {rounded("100.0 * jobs_valid / jobs_collected", 2)} ELSE 0 END AS validation_rate,
  CASE WHEN jobs_collected + jobs_failed > 0
    THEN {rounded("100.0 * jobs_collected / (jobs_collected + jobs_failed)", 2)} ELSE 0 END AS success_rate
FROM scraper_metrics"""


def _rates(fx):
    rated = store.with_run_rates(fx.metrics)
    return rated.withColumns(
        {n: F.col(n).cast("double") for n in ("validation_rate", "success_rate")}
    )


@query("s15_run_rates", RATES, ("scraper_metrics",))
def _(fx):
    return _rates(fx).select(
        "run_id", "jobs_collected", "jobs_failed", "avg_collection_time_ms", "validation_rate", "success_rate"
    )


@query(
    "x8_run_alerts",
    f"""SELECT run_id, jobs_collected < 1800 AS few_jobs, jobs_failed > 20 AS many_errors,
      validation_rate < 90 AS low_quality FROM ({RATES}) r""",
    ("scraper_metrics",),
)
def _(fx):
    return overview.run_alerts(_rates(fx), max_errors=20).select(
        "run_id", "few_jobs", "many_errors", "low_quality"
    )


@query(
    "x7_source_requests",
    f"""SELECT event_type AS source, count(*) AS requests,
      count(*) FILTER (event_id % 5 = 0) AS errors,
      CAST(sum(CASE WHEN event_id % 5 = 0 THEN 0 ELSE user_id END) AS BIGINT) AS jobs,
      {rounded("100.0 * count(*) FILTER (event_id % 5 <> 0) / count(*)", 1)} AS success_rate
    FROM events GROUP BY event_type""",
)
def _(fx):
    log = fx.table("events").select(
        F.col("event_type").alias("source"),
        (F.col("event_id") % 5 != 0).alias("success"),
        F.col("user_id").alias("jobs"),
    )
    return overview.source_requests(log)
