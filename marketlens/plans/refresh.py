"""The processing run: unprocessed postings to stored features and a fresh export."""

import logging
from dataclasses import dataclass
from datetime import date, timedelta

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from marketlens.operators.dedupe import deduplicate
from marketlens.operators.features import extract_features
from marketlens.operators.quality import split, validate
from marketlens.operators.rows import unprocessed
from marketlens.operators.store import append_features, export_table, in_months, month_of, months_to_refresh, ORDER, write_export
from marketlens.operators.versioned import VersionedTable
from marketlens.plans.views import bi_export
from marketlens.schemas import JOBS_FEATURES, JOBS_RAW
from marketlens.session import with_checkpoint_dir

log = logging.getLogger(__name__)


def to_process(raw: DataFrame, features: DataFrame, limit: int = 0) -> DataFrame:
    """Postings without features in id order of storage, missing descriptions made empty."""
    waiting = unprocessed(raw, features)
    if limit > 0:
        waiting = waiting.orderBy("id").limit(limit)
    return waiting.withColumn("description", F.coalesce("description", F.lit("")))


# What the rules and the de-duplication look at; the long text is not among it.
JUDGED = [
    "id", "source", "job_id", "title", "company", "city", "province", "salary_min", "salary_max",
    "posted_date", "url", "description",
]


def surviving(raw: DataFrame, features: DataFrame, as_of: date, limit: int = 0) -> DataFrame:
    """Valid, first-seen postings without features.

    Only the columns a caller goes on to use are read, so `id` alone leaves the texts on disk.
    """
    valid, _ = split(validate(to_process(raw, features, limit).select(*JUDGED), as_of))
    return deduplicate(valid, ["id"])


def processed_features(raw: DataFrame, features: DataFrame, as_of: date, limit: int = 0) -> DataFrame:
    """Features of the surviving postings; invalid and duplicate ones get none, so a later run
    looks at them again.

    The survivors are found on the short columns. Their ids then pick the texts: a daily run
    has few of them, so the ids are broadcast by size and no text is shuffled.
    """
    kept = surviving(raw, features, as_of, limit).select("id")
    texts = raw.select(
        "id", "job_id", "title", "remote_type", F.coalesce("description", F.lit("")).alias("description")
    )
    return extract_features(texts.join(kept, "id", "left_semi"), storable_only=True)


def process_report(raw: DataFrame, features: DataFrame, as_of: date) -> DataFrame:
    """Counts per step: found, valid, invalid, unique, extracted."""
    checked = validate(to_process(raw, features), as_of)
    kept = surviving(raw, features, as_of)
    stored = processed_features(raw, features, as_of)
    return checked.agg(
        F.count("*").alias("found"),
        F.count_if("is_valid").alias("valid"),
        F.count_if(~F.col("is_valid")).alias("invalid"),
        kept.agg(F.count("*").alias("n")).scalar().alias("unique_jobs"),
        stored.agg(F.count("*").alias("n")).scalar().alias("stored"),
    )


@dataclass(frozen=True)
class Tables:
    """Folders of the stored tables; `waiting` holds the postings that have no features yet."""

    raw: str
    features: str
    export: str
    metrics: str
    waiting: str | None = None


def waiting_postings(raw: VersionedTable, features: VersionedTable, waiting: VersionedTable, version: int) -> DataFrame:
    """Postings without features: those left by the last run, and what the raw table got since.

    Equal to the anti-join of the whole tables, but a run reads what is new and what waits.
    """
    fresh = raw.changed_since(waiting.manifest()["facts"].get("raw", 0), version)
    left = waiting.read().join(fresh.select("job_id"), "job_id", "left_anti")
    rows = left.select(*JOBS_RAW.names).unionByName(fresh.select(*JOBS_RAW.names))
    return rows.join(features.stored_keys(rows), "job_id", "left_anti").select(*JOBS_RAW.names)


def refresh_export(spark: SparkSession, tables: Tables, as_of: date, days: int = 30) -> list[str] | None:
    """Bring the stored export up to date; the rewritten months, None for a whole build.

    Months that neither gained nor lost anything keep their files. The rows are those of `bi_export`.
    """
    raw, features = VersionedTable(spark, tables.raw, JOBS_RAW), VersionedTable(spark, tables.features, JOBS_FEATURES)
    export = export_table(spark, tables.export)
    begin = as_of - timedelta(days)
    facts = {"raw": raw.manifest()["version"], "features": features.manifest()["version"], "begin": begin.isoformat()}
    rows = bi_export(raw.read(facts["raw"]), features.read(facts["features"]), as_of, days)
    before = export.manifest()["facts"]
    if not before:
        write_export(rows, tables.export, facts)
        return None
    months = months_to_refresh(raw, features, before, begin)
    if not months:
        export.record(facts)
        return months
    day = F.col("posted_date")
    export.replace_pieces(rows.where(in_months(day, months)).withColumn("posted_month", month_of(day)), months, facts, ORDER)
    return months


def process(spark: SparkSession, tables: Tables, as_of: date, limit: int = 0) -> int:
    """Run the steps against the stored tables; returns the number of feature rows stored.

    With a `waiting` table the run reads new and waiting postings only. A run that dies after its
    features are stored finds them by key the next time.
    """
    spark = with_checkpoint_dir(spark)
    raw, features = VersionedTable(spark, tables.raw, JOBS_RAW), VersionedTable(spark, tables.features, JOBS_FEATURES)
    version = raw.manifest()["version"]
    if tables.waiting:
        waiting = VersionedTable(spark, tables.waiting, JOBS_RAW)
        candidates = waiting_postings(raw, features, waiting, version).checkpoint()
        new = processed_features(candidates, spark.createDataFrame([], JOBS_FEATURES), as_of, limit)
    else:
        new = processed_features(raw.read(version), features.read(), as_of, limit)
    new = new.withColumns(
        {
            "extracted_at": F.current_timestamp().cast("timestamp_ntz"),
            "extraction_confidence": F.lit("0.80").cast("decimal(3,2)"),
        }
    ).select(*JOBS_FEATURES.names)
    if tables.waiting:
        new = new.checkpoint()
    stored = append_features(new, tables.features)
    if tables.waiting:
        left = candidates.join(new.select("job_id"), "job_id", "left_anti").select(*JOBS_RAW.names)
        waiting.replace_pieces(left, waiting.manifest()["pieces"], {"raw": version}, ORDER)
    try:
        refresh_export(spark, tables, as_of)
    except (PySparkException, Py4JJavaError) as error:  # a stale export does not fail the run
        log.warning("could not refresh the export: %s", error)
    tidy(spark, tables)
    return stored


def tidy(spark: SparkSession, tables: Tables) -> None:
    """Rewrite pieces of postings and features that have become slow to read.

    The rows stay the same, so tables that were up to date with the version before are so with the
    one after.
    """
    users = [export_table(spark, tables.export)] + ([VersionedTable(spark, tables.waiting, JOBS_RAW)] if tables.waiting else [])
    for path, name, schema, order in ((tables.raw, "raw", JOBS_RAW, ORDER), (tables.features, "features", JOBS_FEATURES, [])):
        table = VersionedTable(spark, path, schema)
        before = table.manifest()["version"]
        if table.compact(order=order):
            for user in users:
                if user.manifest()["facts"].get(name) == before:
                    user.record({name: before + 1})
