"""Posting quality rules: issues per row, valid/invalid split, table checks."""

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from marketlens import fixed_values as V
from marketlens.functions.dates import age_in_days
from marketlens.functions.text import WS, evaluated_apart, strip

# Fields a posting must fill, here and at collection time.
REQUIRED = ["source", "job_id", "title", "company", "city", "province", "posted_date", "url"]


@dataclass(frozen=True)
class Limits:
    """Adjustable limits of the rules."""

    max_age_days: int = V.MAX_POSTING_AGE_DAYS
    min_salary: int = V.MIN_ANNUAL_SALARY
    max_salary: int = V.MAX_ANNUAL_SALARY


DEFAULT_LIMITS = Limits()
# The narrower limits of the design notes.
NARROW_LIMITS = Limits(max_age_days=30, min_salary=30000, max_salary=250000)


def _shown(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("None"))


def _empty(name: str) -> Column:
    if name == "posted_date":  # a date is never an empty text, and writing it out is slow
        return F.col(name).isNull()
    return F.coalesce(F.col(name), F.lit("")) == ""


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def has_required_fields() -> Column:
    return _all([~_empty(name) for name in REQUIRED])


def valid_province(code: Column) -> Column:
    """Empty codes pass; that is the required-field rule's business."""
    return (F.coalesce(code, F.lit("")) == "") | code.isin(V.PROVINCE_CODES)


def valid_city(city: Column) -> Column:
    spelled = city.rlike(rf"^[A-Za-zÀ-ÿ][A-Za-zÀ-ÿ{WS}\-'.]+$")
    return F.coalesce((F.length(city) >= 2) & (city.isin(V.KNOWN_CITIES) | spelled), F.lit(False))


def valid_salary_range(low: Column, high: Column, limits: Limits = DEFAULT_LIMITS) -> Column:
    one_end = F.coalesce(low, high).between(limits.min_salary, limits.max_salary)
    both_ends = (
        (low <= high)
        & (low >= 0)
        & high.between(limits.min_salary, limits.max_salary)
        & ((low == 0) | (high <= low.cast("long") * 100))
    )
    return (
        F.when(low.isNull() & high.isNull(), F.lit(True))
        .when(low.isNull() | high.isNull(), one_end)
        .otherwise(both_ends)
    )


def recent_enough(day: Column, as_of: date, max_age: int = V.MAX_POSTING_AGE_DAYS) -> Column:
    """Known, not in the future, at most `max_age` days old; accepts dates and ISO texts."""
    age = age_in_days(day.try_cast("date"), as_of)
    return F.coalesce(age.between(0, max_age), F.lit(False))


def valid_url(url: Column) -> Column:
    pattern = r"https?://[a-zA-Z0-9\-\.]+\.[a-zA-Z]{2,}"
    return F.coalesce(url.rlike(r"^https?://") & url.rlike(pattern), F.lit(False))


def valid_title_length(title: Column) -> Column:
    return F.length(title).between(*V.TITLE_LENGTH)


def valid_company(company: Column) -> Column:
    good = (
        ~F.lower(company).isin(V.PLACEHOLDER_COMPANIES)
        & (F.length(company) >= 2)
        & ~company.rlike(r"^\p{Nd}+$")
    )
    return F.coalesce(good, F.lit(False))


def is_spam() -> Column:
    text = F.lower(F.concat_ws(" ", *[_shown(F.col(c)) for c in ("title", "company", "description")]))
    return text.rlike("|".join(V.SPAM_PATTERNS))


def id_matches_source() -> Column:
    prefix = F.concat(_shown(F.col("source")), F.lit("_"))
    return F.coalesce(F.startswith(F.col("job_id"), prefix), F.lit(False))


def _rules(as_of: date, strict: bool, limits: Limits) -> list[tuple[Column, Column]]:
    """(broken, message) of every rule, in rule order."""
    c = F.col

    def rule(good: Column, *parts: Column | str) -> tuple[Column, Column]:
        text = [F.lit(p) if isinstance(p, str) else p for p in parts]
        return ~F.coalesce(good, F.lit(True)), F.concat(*text)

    low, high, title = c("salary_min"), c("salary_max"), c("title")
    rules = [
        rule(has_required_fields(), "Missing required fields"),
        rule(valid_province(c("province")), "Invalid province code: ", _shown(c("province"))),
        rule(valid_city(c("city")), "Invalid city name: ", _shown(c("city"))),
        rule(
            valid_salary_range(low, high, limits),
            "Invalid salary range: ", _shown(low), " - ", _shown(high),
        ),
        rule(
            recent_enough(c("posted_date"), as_of, limits.max_age_days),
            "Suspicious posted date: ", F.coalesce(c("posted_date").cast("string"), F.lit("")),
        ),
        rule(valid_url(c("url")), "Invalid URL: ", _shown(c("url"))),
        rule(valid_title_length(title), "Invalid title length: ", F.length(title).cast("string")),
        rule(valid_company(c("company")), "Invalid company name: ", _shown(c("company"))),
    ]
    if strict:
        rules.append(rule(~is_spam(), "Detected spam patterns"))
    rules.append(
        rule(
            id_matches_source(),
            "Job ID doesn't match source: ", _shown(c("job_id")), " vs ", _shown(c("source")),
        )
    )
    return rules


def validate(
    df: DataFrame, as_of: date, strict: bool = False, limits: Limits = DEFAULT_LIMITS
) -> DataFrame:
    """Add `validation_issues` (messages of all broken rules, in rule order) and `is_valid`.

    A plain projection, no shuffle; filtering on `is_valid` alone builds no message.
    """
    rules = _rules(as_of, strict, limits)
    messages = [F.when(broken, message) for broken, message in rules]
    return df.withColumns(
        {
            "validation_issues": F.array_compact(F.array(*messages)),
            "is_valid": evaluated_apart(_all([~broken for broken, _ in rules])),
        }
    )


def split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows without the rule columns, invalid rows with their issues."""
    valid = checked.where("is_valid").drop("is_valid", "validation_issues")
    return valid, checked.where(~F.col("is_valid")).drop("is_valid")


def collected_ok() -> Column:
    """Check at collection time: description may be empty but not missing."""
    return has_required_fields() & F.col("description").isNotNull() & id_matches_source()


def title_has_role_word(title: Column, roles: list[str]) -> Column:
    """Title shares a word with any of the role names; no role names means no limit."""
    wanted = sorted({w for r in roles for w in r.lower().split()})
    if not wanted:
        return F.lit(True)
    tokens = F.split(F.lower(strip(title)), f"[{WS}]+")
    return F.arrays_overlap(tokens, F.array(*[F.lit(w) for w in wanted]))


def null_critical_fields(raw: DataFrame, features: DataFrame) -> DataFrame:
    """Postings without title, city or features."""
    has = features.select("job_id", F.lit(True).alias("_has"))
    joined = raw.select("job_id", "title", "city").join(has, "job_id", "left")
    broken = F.col("title").isNull() | F.col("city").isNull() | F.col("_has").isNull()
    return joined.where(broken).agg(F.count("*").alias("null_jobs"))


def date_span(raw: DataFrame) -> DataFrame:
    span = raw.agg(F.min("posted_date").alias("earliest"), F.max("posted_date").alias("latest"))
    return span


def date_span_report(raw: DataFrame, as_of: date) -> DataFrame:
    return date_span(raw).withColumn("days_span", age_in_days(F.col("earliest"), as_of))


def extraction_rate(features: DataFrame) -> DataFrame:
    with_skills = F.sum(F.when(F.array_size("skills") > 0, 1).otherwise(0))
    return features.agg(
        F.count("*").alias("total_jobs"), with_skills.alias("jobs_with_skills")
    ).withColumn(
        "extraction_rate",
        F.round(F.lit(100.0) * F.col("jobs_with_skills") / F.nullif(F.col("total_jobs"), F.lit(0)), 1),
    )


def source_distribution(raw: DataFrame) -> DataFrame:
    return (
        raw.groupBy("source")
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "source")
    )
