"""Daily partial states of the city report, kept so that a new day does not read the old ones.

A state holds, per day, city and province, what the report's figures are merged from: counts, sums
of whole numbers and the set of sources. The stored table has a piece per day; bringing it up to
date computes the days that changed, and drops those that have left the range.
"""

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marketlens.functions.dates import within_days
from marketlens.operators.rows import postings_with_features
from marketlens.operators.versioned import VersionedTable

# Figures that are means: their names, and what is added up for them.
MEANS = {"exp_min": "exp_min", "exp_max": "exp_max", "junior": "CAST(is_junior AS INT) * 100", "salary": "salary_mid"}


def daily_states(raw: DataFrame, features: DataFrame, flexible: Column) -> DataFrame:
    """A row per day, city and province with mergeable parts of the report."""
    sums = [F.sum(F.expr(value).cast("long")).alias(f"{name}_sum") for name, value in MEANS.items()]
    known = [F.count(F.expr(value)).alias(f"{name}_n") for name, value in MEANS.items()]
    return (
        postings_with_features(raw, features, "left")
        .groupBy("posted_date", "city", "province")
        .agg(
            F.count("*").alias("n"), *sums, *known, F.sum(flexible.cast("long") * 100).alias("flexible_sum"),
            F.array_sort(F.collect_set("source")).alias("sources"),
        )
    )


def merged_states(states: DataFrame) -> DataFrame:
    """The city report of all days of some states."""

    def mean(name: str, digits: int, count: str | None = None) -> Column:
        return F.round(F.sum(f"{name}_sum") / F.sum(count or f"{name}_n"), digits)

    # Sources are a handful of names, so their sets stay small when they meet.
    return states.groupBy("city", "province").agg(
        F.sum("n").alias("total_jobs"),
        mean("exp_min", 1).alias("avg_exp_min"), mean("exp_max", 1).alias("avg_exp_max"),
        mean("junior", 1).alias("junior_pct"), mean("salary", 0).alias("avg_salary"),
        mean("flexible", 1, "n").alias("remote_pct"),
        F.max("posted_date").alias("latest_posting"),
        F.size(F.array_distinct(F.flatten(F.collect_list("sources")))).cast("long").alias("sources_count"),
    )


def day_name(day: Column) -> Column:
    return day.cast("string")


def states_table(spark: SparkSession, path: str) -> VersionedTable:
    return VersionedTable(spark, path, place=day_name(F.col("posted_date")))


def roll_states(
    raw: VersionedTable, features: VersionedTable, path: str, as_of: date, flexible: Column, days: int = 30
) -> list[str]:
    """Bring the stored states up to `as_of`; the days that were computed.

    Computed are the days of postings that are new or changed, or whose features are, since the last
    time, and days that the range has gained. Days that it has lost are dropped. A posting keeps its
    date.
    """
    spark = raw.spark
    table = states_table(spark, path)
    before = table.manifest()
    begin = as_of - timedelta(days)
    facts = {"raw": raw.manifest()["version"], "features": features.manifest()["version"], "begin": begin.isoformat()}
    rows = raw.read(facts["raw"]).where(within_days(F.col("posted_date"), as_of, days))
    if before["facts"]:
        was = date.fromisoformat(before["facts"]["begin"])
        keys = features.changed_since(before["facts"]["features"], facts["features"]).select("job_id")
        fresh = raw.changed_since(before["facts"]["raw"], facts["raw"]).select("posted_date")
        touched = fresh.unionByName(raw.lookup(keys, ["job_id", "posted_date"]).select("posted_date")).distinct()
        due = {r[0] for r in touched.where(F.col("posted_date") >= F.lit(begin)).collect()}  # a row per day
        due |= {begin + timedelta(n) for n in range(max((was - begin).days, 0))}
        rows = rows.where(F.col("posted_date").isin(sorted(due)))
    else:
        due = {r[0] for r in rows.select("posted_date").distinct().collect()}
    lost = [name for name in before["pieces"] if name < begin.isoformat()]
    states = daily_states(rows, features.read(facts["features"]), flexible)
    names = sorted(day.isoformat() for day in due)
    if names or lost:
        table.replace_pieces(states, [*names, *lost], facts)
    elif before["facts"] != facts:
        table.record(facts)
    return names
