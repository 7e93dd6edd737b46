"""Table schemas."""

from pyspark.sql import types as T

_TEXT, _INT, _LONG, _DATE = T.StringType(), T.IntegerType(), T.LongType(), T.DateType()
_TIME, _FLAG = T.TimestampNTZType(), T.BooleanType()
_TEXTS = T.ArrayType(_TEXT)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# One posting as every feed delivers it.
POSTING = _struct(
    source=_TEXT, job_id=_TEXT, title=_TEXT, company=_TEXT, city=_TEXT, province=_TEXT,
    description=_TEXT, salary_min=_INT, salary_max=_INT, remote_type=_TEXT,
    posted_date=_DATE, url=_TEXT,
)

JOBS_RAW = _struct(
    id=_LONG, source=_TEXT, job_id=_TEXT, title=_TEXT, company=_TEXT, city=_TEXT, province=_TEXT,
    description=_TEXT, salary_min=_INT, salary_max=_INT, salary_mid=_INT, remote_type=_TEXT,
    posted_date=_DATE, scraped_at=_TIME, url=_TEXT, created_at=_TIME, updated_at=_TIME,
)

JOBS_FEATURES = _struct(
    job_id=_TEXT, exp_min=_INT, exp_max=_INT, exp_avg=T.DecimalType(4, 2), exp_level=_TEXT,
    skills=_TEXTS, is_junior=_FLAG, is_remote=_FLAG, extracted_at=_TIME,
    extraction_confidence=T.DecimalType(3, 2),
)

SKILLS_MASTER = _struct(
    skill=_TEXT, category=_TEXT, aliases=_TEXTS,
    role_relevance=T.MapType(_TEXT, T.DoubleType()),
)

SCRAPER_METRICS = _struct(
    run_id=_TEXT, run_date=_TIME, jobs_collected=_INT, jobs_failed=_INT, jobs_valid=_INT,
    jobs_duplicates=_INT, sources_used=_TEXTS, jobs_by_source=T.MapType(_TEXT, _INT),
    collection_time_ms=_INT, processing_time_ms=_INT, total_time_ms=_INT,
    errors=_TEXTS, warnings=_TEXTS, status=_TEXT,
)
