"""Posting-shaped tables derived from the driver's tables, in SQL both engines read.

Every order becomes a posting and every part a skill by arithmetic on its key, so the derived
tables grow with the data. The same text runs on Spark and DuckDB; a dialect class spells the few
expressions in which the engines differ.
"""

from dataclasses import dataclass
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

AS_OF = date(2026, 2, 20)


def _pick(key: str, values: list[str]) -> str:
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {key} {cases} END"


SOURCES = ["jobbank", "adzuna", "jsearch", "rapidapi", "remoteok", "indeed", "workopolis"]
PREFIXES = ["", "Senior ", "Junior ", "Lead "]
ROLES = [
    "Data Analyst", "Data Scientist", "Data Engineer", "Software Engineer", "DevOps Engineer",
    "Security Analyst", "Web Developer", "Mobile Developer", "QA Engineer",
    "Database Administrator", "Business Analyst", "IT Support",
]
CITIES = ["Toronto", "Vancouver", "Calgary", "Ottawa", "Edmonton", "Montreal", "Winnipeg", "Regina"]
PROVINCES = ["ON", "BC", "AB", "ON", "AB", "QC", "MB", "SK"]
TENURES = [
    "We need 3-5 years of practice.", "About 3 to 5 yrs required.", "5+ years in industry.",
    "29 years in business.", "A junior developer seat.", "Join an international team.",
    "500-503 years of history.", "Founded 40 years ago, minimum 5 years needed.",
    "No stated tenure.", "Between 5-3 years.",
]
STACKS = [
    "", " Uses python, sql and excel.", " We use c++ daily.", " Now c++11 and sql.",
    " With node.js, nodejs.",
    " aws azure gcp docker kubernetes terraform git jenkins ci/cd pandas numpy spark",
    " react angular vue typescript", " power bi, tableau", " github actions and git",
    " Remote first, hybrid office.", " On-site java.",
]
ROTATION = [
    "python", "sql", "aws", "docker", "react", "tableau", "power bi", "spark", "nodejs", "excel", "git",
]

class Spark:
    """Spark's spelling of the marked expressions."""

    @staticmethod
    def idiv(a: str, b: str) -> str:
        return f"({a} div {b})"

    @staticmethod
    def minus(day: str, days: str) -> str:
        return f"date_sub({day}, CAST({days} AS INT))"

    @staticmethod
    def rotate(values: list[str], start: str, count: str) -> str:
        items = ", ".join(f"'{v}'" for v in values)
        return f"slice(array({items}), CAST({start} + 1 AS INT), CAST({count} AS INT))"


class Duck:
    """DuckDB's spelling."""

    @staticmethod
    def idiv(a: str, b: str) -> str:
        return f"({a} // {b})"

    @staticmethod
    def minus(day: str, days: str) -> str:
        return f"CAST({day} - CAST({days} AS INT) AS DATE)"

    @staticmethod
    def rotate(values: list[str], start: str, count: str) -> str:
        items = ", ".join(f"'{v}'" for v in values)
        return f"list_slice([{items}], CAST({start} + 1 AS INT), CAST({start} + {count} AS INT))"


def jobs_raw_sql(d: type, orders: str) -> str:
    block_12, block_48 = d.idiv("o_orderkey", "12"), d.idiv("o_orderkey", "48")
    return f"""
SELECT k AS id, source,
  CASE WHEN k % 151 = 0 THEN CAST(k AS VARCHAR(20))
       ELSE concat(source, '_', CAST(CASE WHEN k % 140 = 7 THEN k - 7 ELSE k END AS VARCHAR(20))) END AS job_id,
  CASE WHEN k % 139 = 0 THEN 'QA' ELSE concat(prefix, role) END AS title,
  CASE WHEN k % 211 = 0 THEN NULL WHEN k % 53 = 0 THEN 'Unknown'
       ELSE concat('Company ', CAST(c % 25 AS VARCHAR(20))) END AS company,
  CASE WHEN k % 131 = 0 THEN 'X1' ELSE city END AS city,
  CASE WHEN k % 97 = 0 THEN NULL WHEN k % 89 = 0 THEN 'ZZ' ELSE province END AS province,
  CASE WHEN k % 163 = 0 THEN NULL WHEN k % 157 = 0 THEN 'Act now, guaranteed income'
       ELSE concat(tenure, stack) END AS description,
  salary_min, salary_max,
  CAST({d.idiv("(coalesce(salary_min, 0) + coalesce(salary_max, 0))", "2")} AS INT) AS salary_mid,
  {_pick("k % 6", ["remote", "hybrid", "onsite"])} AS remote_type,
  CASE WHEN k % 113 = 0 THEN NULL WHEN k % 149 = 0 THEN DATE '2026-02-23'
       ELSE {d.minus("DATE '2026-02-20'", "(k * 7) % 120")} END AS posted_date,
  o_orderdate AS scraped_at, o_orderdate AS created_at,
  CASE WHEN k % 137 = 0 THEN 'ftp://bad'
       ELSE concat('https://jobs.example.com/', CAST(k AS VARCHAR(20))) END AS url
FROM (
  SELECT o_orderkey AS k, o_custkey AS c, o_orderdate,
    {_pick("o_orderkey % 7", SOURCES)} AS source,
    {_pick(block_12 + " % 4", PREFIXES)} AS prefix,
    {_pick("o_orderkey % 12", ROLES)} AS role,
    {_pick(block_48 + " % 8", CITIES)} AS city,
    {_pick(block_48 + " % 8", PROVINCES)} AS province,
    {_pick("o_orderkey % 10", TENURES)} AS tenure,
    {_pick("o_orderkey % 11", STACKS)} AS stack,
    CAST(CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 61 = 0 THEN 25
         ELSE 40000 + (o_orderkey * 37) % 60000 END AS INT) AS salary_min,
    CAST(CASE WHEN o_orderkey % 4 = 0 OR o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 61 = 0 THEN 35
         ELSE 55000 + (o_orderkey * 53) % 90000 END AS INT) AS salary_max
  FROM {orders}
) AS keyed
"""


def jobs_features_sql(d: type, jobs_raw: str) -> str:
    return f"""
SELECT job_id, exp_min, exp_max,
  CAST(mean_years AS DECIMAL(4, 2)) AS exp_avg,
  CASE WHEN exp_min IS NULL AND exp_max IS NULL THEN 'mid' WHEN mean_years <= 1 THEN 'entry'
       WHEN mean_years <= 3 THEN 'junior' WHEN mean_years <= 5 THEN 'mid'
       WHEN mean_years <= 8 THEN 'senior' ELSE 'lead' END AS exp_level,
  skills,
  CASE WHEN exp_min IS NULL AND exp_max IS NULL THEN FALSE ELSE mean_years <= 2 END AS is_junior,
  is_remote, CAST(0.8 AS DECIMAL(3, 2)) AS extraction_confidence
FROM (
  SELECT job_id, exp_min, exp_max, skills, is_remote,
    (coalesce(exp_min, 0) + coalesce(exp_max, exp_min, 0)) / CAST(2 AS DOUBLE) AS mean_years
  FROM (
    SELECT job_id,
      CAST(CASE WHEN id % 8 = 0 THEN NULL ELSE id % 7 END AS INT) AS exp_min,
      CAST(CASE WHEN id % 8 = 0 OR id % 10 = 0 THEN NULL ELSE id % 7 + id % 4 END AS INT) AS exp_max,
      CASE WHEN id % 101 = 0 THEN NULL
           ELSE {d.rotate(ROTATION * 2, "id % 11", "id % 6")} END AS skills,
      coalesce(remote_type IN ('remote', 'hybrid'), FALSE) AS is_remote
    FROM {jobs_raw} WHERE id % 5 <> 0
  ) AS drawn
) AS averaged
"""


# One run per day and event type; errors never collect, and some runs are empty on both sides.
def scraper_metrics_sql(d: type, events: str) -> str:
    return f"""
SELECT concat(CAST(day AS VARCHAR(10)), '_', event_type) AS run_id, run_date,
  CAST(CASE WHEN event_type = 'error' THEN 0 ELSE n - n_third END AS INT) AS jobs_collected,
  CAST(CASE WHEN event_type = 'error' AND dom % 7 = 0 THEN 0 ELSE n_third END AS INT) AS jobs_failed,
  CAST(CASE WHEN event_type = 'error' THEN 0 ELSE n_valid END AS INT) AS jobs_valid,
  CAST(n_third AS INT) AS jobs_duplicates,
  CAST(n * 1000 + dom AS INT) AS collection_time_ms,
  CASE WHEN event_type = 'error' THEN 'failed' ELSE 'completed' END AS status
FROM (
  SELECT CAST(ts AS DATE) AS day, event_type, CAST(day(CAST(ts AS DATE)) AS INT) AS dom,
    max(ts) AS run_date, count(*) AS n,
    sum(CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END) AS n_third,
    sum(CASE WHEN event_id % 3 <> 0 AND event_id % 4 <> 0 THEN 1 ELSE 0 END) AS n_valid
  FROM {events} GROUP BY CAST(ts AS DATE), event_type, day(CAST(ts AS DATE))
) AS per_run
"""


# A skill dimension that grows with the data: one skill per part.
def part_skills_sql(d: type, part: str) -> str:
    return f"""
SELECT concat(p_name, ' ', CAST(p_partkey AS VARCHAR(20))) AS skill, p_type AS category,
  {d.rotate(['py', 'js'], "0", "p_partkey % 3")} AS aliases,
  p_size, p_partkey
FROM {part}
"""


def duck_with(*names: str) -> str:
    """WITH clause that defines the named tables for DuckDB."""
    texts = {
        "jobs_raw": lambda: jobs_raw_sql(Duck, "orders"),
        "jobs_features": lambda: jobs_features_sql(Duck, "jobs_raw"),
        "scraper_metrics": lambda: scraper_metrics_sql(Duck, "events"),
        "part_skills": lambda: part_skills_sql(Duck, "part"),
    }
    return "WITH " + ", ".join(f"{name} AS ({texts[name]()})" for name in names)


@dataclass(frozen=True)
class Fixture:
    """The derived tables of one scale-factor folder, on Spark."""

    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def raw(self) -> DataFrame:
        return self.spark.sql(jobs_raw_sql(Spark, "{orders}"), orders=self.table("orders"))

    @cached_property
    def features(self) -> DataFrame:
        return self.spark.sql(jobs_features_sql(Spark, "{raw}"), raw=self.raw)

    @cached_property
    def metrics(self) -> DataFrame:
        return self.spark.sql(scraper_metrics_sql(Spark, "{events}"), events=self.table("events"))

    @cached_property
    def part_skills(self) -> DataFrame:
        return self.spark.sql(part_skills_sql(Spark, "{part}"), part=self.table("part"))
