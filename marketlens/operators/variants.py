"""Alternative rule sets: scored quality, looser feature rules, dictionary skills."""

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from marketlens import fixed_values as V
from marketlens.functions.dates import age_in_days
from marketlens.functions.skills import named_words
from marketlens.functions.text import contains_any, whole_number

# Fields of the scored rules.
SCORED_REQUIRED = ["source", "job_id", "title", "city", "url"]
SCORED_OPTIONAL = ["company", "province", "description", "salary_min", "salary_max", "posted_date"]


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def _filled(name: str) -> Column:
    """Present and neither empty nor 0."""
    return ~_text(name).isin("", "0")


def _message(broken: Column, *parts: Column | str) -> Column:
    texts = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    return F.when(broken, F.concat(*texts))


def _dollars(amount: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(amount, 0))


def score_quality(
    df: DataFrame, as_of: date, max_age: int = 30, band: tuple[int, int] = (30000, 250000)
) -> DataFrame:
    """Add `errors`, `warnings`, `is_valid` and `quality_score` (0 to 100)."""
    low, high = F.col("salary_min"), F.col("salary_max")
    title, day = F.length(_text("title")), F.col("posted_date").try_cast("date")
    age = age_in_days(day, as_of)
    paid = _filled("salary_min") | _filled("salary_max")
    errors = [
        *[_message(~_filled(n), f"Missing required field: {n}") for n in SCORED_REQUIRED],
        _message(title < 3, "Title too short: ", title, " chars"),
        _message(F.length(_text("city")) <= 2, "Invalid or unknown city: ", _text("city")),
        _message(
            _filled("province") & ~F.upper("province").isin(V.PROVINCE_CODES),
            "Invalid province code: ", _text("province"),
        ),
        _message(age < 0, "Future date: ", _text("posted_date")),
        _message(age > max_age, "Job too old: ", age, " days"),
        _message(_filled("posted_date") & day.isNull(), "Invalid date format: ", _text("posted_date")),
        _message(paid & ~low.between(*band), "Unrealistic salary_min: ", _dollars(low)),
        _message(paid & ~high.between(*band), "Unrealistic salary_max: ", _dollars(high)),
        _message(
            _filled("salary_min") & _filled("salary_max") & (low > high),
            "salary_min > salary_max: ", _dollars(low), " > ", _dollars(high),
        ),
        _message(
            _filled("url") & ~F.startswith(F.col("url"), F.lit("http")),
            "Invalid URL format: ", _text("url"),
        ),
    ]
    words = F.length(_text("description"))
    prefix = F.concat(_text("source"), F.lit("_"))
    warnings = [
        _message(title > 200, "Title very long: ", title, " chars"),
        _message(words.between(1, 49), "Description too short: ", words, " chars"),
        _message(
            ~F.startswith(_text("job_id"), prefix),
            "Job ID doesn't match source prefix: ", _text("job_id"),
        ),
        _message(
            _filled("remote_type") & ~F.col("remote_type").isin("remote", "hybrid", "onsite"),
            "Unknown remote type: ", _text("remote_type"),
        ),
    ]
    filled = sum((_filled(n).cast("int") for n in SCORED_OPTIONAL), F.lit(0))
    score = (
        F.lit(100.0) - F.size("errors") * 10 - F.size("warnings") * 2
        + filled / F.lit(float(len(SCORED_OPTIONAL))) * F.lit(10.0)
    )
    return (
        df.withColumn("errors", F.array_compact(F.array(*errors)))
        .withColumn("warnings", F.array_compact(F.array(*warnings)))
        .withColumn("is_valid", F.size("errors") == 0)
        .withColumn("quality_score", F.greatest(F.lit(0.0), F.least(F.lit(100.0), score)))
    )


def quality_statistics(scored: DataFrame) -> DataFrame:
    """One row: totals, validation rate, mean score of valid rows, message counts."""
    n = F.count("*")
    return scored.agg(
        n.alias("total_jobs"),
        F.count_if("is_valid").alias("valid_jobs"),
        F.count_if(~F.col("is_valid")).alias("invalid_jobs"),
        F.coalesce(F.count_if("is_valid") * F.lit(100.0) / F.nullif(n, F.lit(0)), F.lit(0.0)).alias("validation_rate"),
        F.coalesce(F.avg(F.when(F.col("is_valid"), F.col("quality_score"))), F.lit(0.0)).alias("avg_quality_score"),
        F.coalesce(F.sum(F.size("errors")), F.lit(0)).alias("total_errors"),
        F.coalesce(F.sum(F.size("warnings")), F.lit(0)).alias("total_warnings"),
    )


def top_errors(scored: DataFrame, limit: int = 5) -> DataFrame:
    """Most frequent error types (the text before the colon)."""
    return (
        scored.select(F.explode("errors").alias("error"))
        .groupBy(F.substring_index("error", ":", 1).alias("error_type"))
        .agg(F.count("*").alias("occurrences"))
        .orderBy(F.desc("occurrences"), "error_type")
        .limit(limit)
    )


# Word lists of the looser feature rules.
OPEN_ENTRY_WORDS = [
    "entry level", "junior", "graduate", "intern", "co-op",
    "fresh grad", "new grad", "no experience", "0 years",
]
OPEN_SENIOR_WORDS = [
    "senior", "lead", "principal", "staff", "expert",
    "architect", "head of", "director", "manager",
]
OPEN_REMOTE_WORDS = [
    "remote", "work from home", "wfh", "telecommute", "distributed",
    "virtual", "anywhere", "home-based",
]
OPEN_HYBRID_WORDS = ["hybrid", "flexible", "partial remote", "mix of"]

_UNIT = r"\s*+(?:year|yr)"
_OPEN_RANGE = rf"(?<![0-9])([0-9]++)\s*+(?:to|-|–)\s*+([0-9]++){_UNIT}"
_OPEN_SINGLE = [
    rf"(?<![0-9])([0-9]++)\+{_UNIT}",
    rf"minimum\s++(?:of\s++)?+([0-9]++){_UNIT}",
    rf"at\s++least\s++([0-9]++){_UNIT}",
    r"(?<![0-9])([0-9]++)\s*+(?:years?|yrs?)\s++(?:of\s++)?+experience",
]


def open_experience(text: Column) -> Column:
    """struct(exp_min, exp_max): entry words first, then patterns; single numbers stay open."""

    def pair(low: Column, high: Column) -> Column:
        return F.struct(low.alias("exp_min"), high.alias("exp_max"))

    low = whole_number(F.regexp_extract(text, _OPEN_RANGE, 1))
    high = whole_number(F.regexp_extract(text, _OPEN_RANGE, 2))
    out = [
        F.when(contains_any(text, OPEN_ENTRY_WORDS), pair(F.lit(0), F.lit(1))),
        F.when(low.isNotNull(), pair(low, high)),
    ]
    for pattern in _OPEN_SINGLE:
        years = whole_number(F.regexp_extract(text, pattern, 1))
        out.append(F.when(years.isNotNull(), pair(years, F.lit(None).cast("int"))))
    return F.coalesce(*out)


def open_level(exp_min: Column, title: Column) -> Column:
    """Level from title words, else from the lower end."""
    return (
        F.when(contains_any(title, OPEN_SENIOR_WORDS), "senior")
        .when(contains_any(title, OPEN_ENTRY_WORDS), "entry")
        .when(exp_min == 0, "entry")
        .when(exp_min <= 2, "junior")
        .when(exp_min <= 5, "mid")
        .when(exp_min <= 8, "senior")
        .when(exp_min > 8, "lead")
        .otherwise("mid")
    )


def extract_open_features(df: DataFrame) -> DataFrame:
    """Features by the looser rules; missing texts count as empty."""
    lowered = df.select(
        "job_id",
        F.lower(_text("title")).alias("_title"),
        F.concat(F.lower(_text("description")), F.lit(" "), F.lower(_text("title"))).alias("_text"),
    )
    text = F.col("_text")
    arrangement = (
        F.when(contains_any(text, OPEN_REMOTE_WORDS), "remote")
        .when(contains_any(text, OPEN_HYBRID_WORDS), "hybrid")
        .otherwise("onsite")
    )
    return (
        lowered.withColumn("_exp", open_experience(text))
        .select(
            "job_id", "_exp.exp_min", "_exp.exp_max",
            open_level(F.col("_exp.exp_min"), F.col("_title")).alias("exp_level"),
            arrangement.alias("remote_type"),
        )
        .withColumn("is_remote", F.col("remote_type") != "onsite")
    )


def dictionary_skills(lowered: Column, names: list[str]) -> Column:
    """Names of a skill list found between word boundaries, sorted.

    Entries may contain each other ("spring", "spring boot"), so each is looked up by itself.
    """
    return named_words(lowered, sorted({n.lower() for n in names}))
