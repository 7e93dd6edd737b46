"""Writing postings, features, exports and run metrics.

Postings and features are versioned tables by job_id: a change reads the pieces its keys fall into,
writes what is new and switches to the next version. The export is one by month.
"""

from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from marketlens.functions.salary import salary_mid
from marketlens.operators.rows import first_per_key, not_stored
from marketlens.operators.versioned import VersionedTable
from marketlens.schemas import JOBS_RAW, SCRAPER_METRICS
from marketlens.session import with_checkpoint_dir

#: Narrow date ranges per row group let recency filters skip most of a file.
ORDER = ["posted_date"]


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table with its fixed schema, in its newest version; empty while nothing has been written."""
    table = VersionedTable(spark, path, schema)
    if table.exists():
        return table.read()
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def ordered_salaries(df: DataFrame) -> DataFrame:
    """Swap the ends of a reversed salary range."""
    low, high = F.col("salary_min"), F.col("salary_max")
    both = low.isNotNull() & high.isNotNull()
    return df.withColumns(
        {
            "salary_min": F.when(both, F.least(low, high)).otherwise(low),
            "salary_max": F.when(both, F.greatest(low, high)).otherwise(high),
        }
    )


def acceptable(low: Column) -> Column:
    """What the postings table's NOT NULL and CHECK rules accept, the salary's ends in order."""
    return (
        F.col("source").isNotNull()
        & F.col("job_id").isNotNull()
        & F.col("title").isNotNull()
        & F.col("city").isNotNull()
        & F.coalesce(low >= 0, F.lit(True))
    )


def storable_postings(batch: DataFrame, order: list[str]) -> DataFrame:
    """Acceptable rows of a batch, salary ends in order, first per job_id."""
    # Of rows as they come; the ends are put in order for the first rows only.
    low, high = F.col("salary_min"), F.col("salary_max")
    known = low.isNotNull() & high.isNotNull()
    good = first_per_key(batch.where(acceptable(F.when(known, F.least(low, high)).otherwise(low))), ["job_id"], order)
    return ordered_salaries(good).withColumn("salary_mid", salary_mid(low, high))


def new_postings(batch: DataFrame, stored: DataFrame, order: list[str]) -> DataFrame:
    """Rows of a batch to insert: acceptable, not stored yet, first per job_id."""
    return not_stored(storable_postings(batch, order), stored)


def insert_postings(
    batch: DataFrame, path: str, order: list[str], metrics_path: str, source: str,
    run_id: str, run_date: datetime,
) -> int:
    """Add the new postings of a batch, write the run's metrics, return the insert count.

    The stored keys are looked up in the pieces that the batch's keys fall into. The table remembers
    a run's count in the version that holds its rows, so a run that is repeated, whether it died
    before or after that version, adds nothing twice and reports the same counts.
    """
    spark = with_checkpoint_dir(batch.sparkSession)
    table = VersionedTable(spark, path, JOBS_RAW)
    inserted = table.manifest()["runs"].get(run_id)
    if inserted is None:
        # The keys' look-up reads their column alone, and both sides meet by the key that the rows
        # were dealt by to find the first of each: whole rows travel once.
        incoming = storable_postings(batch, order)
        incoming = incoming.select(*[n for n in JOBS_RAW.names if n in incoming.columns])
        new = not_stored(incoming, table.stored_keys(batch))
        inserted = table.append(new, run=run_id, order=ORDER)
    totals = batch.agg(F.count("*").alias("total"))
    record_run(run_metrics(totals, source, inserted, run_id, run_date), metrics_path, run_id)
    return inserted


def run_metrics(
    totals: DataFrame, source: str, inserted: int, run_id: str, run_date: datetime, errors: int = 0
) -> DataFrame:
    """The metrics row of one insert run from its one-row `total`.

    Rows the table's checks refuse count as duplicates, as a refused insert does.
    """
    total, failed = F.col("total").cast("int"), F.lit(errors).cast("int")
    n = F.lit(inserted).cast("int")
    return totals.select(
        F.lit(run_id).alias("run_id"),
        F.lit(run_date).cast("timestamp_ntz").alias("run_date"),
        total.alias("jobs_collected"),
        failed.alias("jobs_failed"),
        n.alias("jobs_valid"),
        (total - failed - n).alias("jobs_duplicates"),
        F.array(F.lit(source)).alias("sources_used"),
        F.create_map(F.lit(source), total).alias("jobs_by_source"),
        *[F.lit(None).cast("int").alias(c) for c in ("collection_time_ms", "processing_time_ms", "total_time_ms")],
        F.array().cast("array<string>").alias("errors"),
        F.array().cast("array<string>").alias("warnings"),
        F.when(n > 0, "completed").otherwise("failed").alias("status"),
    )


def record_run(metrics: DataFrame, path: str, run_id: str) -> None:
    """Write the row into the run's own folder: repeating a run replaces its row."""
    metrics.write.mode("overwrite").parquet(f"{path}/run={run_id}")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, SCRAPER_METRICS)


def with_run_rates(metrics: DataFrame) -> DataFrame:
    """Derived columns of the metrics table; empty runs give 0."""
    collected, failed = F.col("jobs_collected"), F.col("jobs_failed")
    tried = collected + failed

    def percent(part: Column, whole: Column) -> Column:
        rate = part.cast("decimal(20,0)") * 100 / F.nullif(whole, F.lit(0))
        return F.when(whole > 0, F.round(rate, 2)).otherwise(F.lit(0)).cast("decimal(5,2)")

    average = F.floor(F.col("collection_time_ms") / F.nullif(collected, F.lit(0))).cast("int")
    return metrics.withColumns(
        {
            "avg_collection_time_ms": F.when(collected > 0, average).otherwise(F.lit(0)),
            "validation_rate": percent(F.col("jobs_valid"), collected),
            "success_rate": percent(collected, tried),
        }
    )


def merged_features(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Stored rows with the new non-null values on top, plus the new rows."""
    old, fresh = stored.alias("old"), new.alias("new")
    values = [c for c in stored.columns if c != "job_id"]
    taken = [
        F.coalesce(F.col(f"new.{c}"), F.col(f"old.{c}")).alias(c) if c in new.columns else F.col(f"old.{c}")
        for c in values
    ]
    return old.join(fresh, "job_id", "full_outer").select("job_id", *taken)


def append_features(new: DataFrame, path: str) -> int:
    """Insert features of postings known to have none; returns their number."""
    return VersionedTable(new.sparkSession, path).append(new)


def upsert_features(new: DataFrame, path: str, schema: T.StructType) -> int:
    """Insert or update features (one row per job_id); the number of rows that changed.

    Rows of the touched pieces are read, changed rows are written beside them; rows that stay as
    they are write nothing, so running the same upsert again changes nothing.
    """
    spark = with_checkpoint_dir(new.sparkSession)
    # Read twice below, so kept in the shared folder instead of being computed twice.
    incoming = new.checkpoint()
    table = VersionedTable(spark, path, schema)
    stored = table.lookup(incoming)
    return table.replace_rows(merged_features(stored, incoming).select(*schema.names).subtract(stored))


def patched_postings(raw: DataFrame, updates: DataFrame, order: str) -> DataFrame:
    """Postings with re-read descriptions and salaries.

    A posting's patches are applied one by one in their `order`: a non-empty description and known
    salary ends replace the posting's, unless the ends would then be reversed or negative, in which
    case that patch alone is refused. The middle of the salary follows its ends. A posting's patches
    are gathered in one row: re-reads of one page, few by nature.
    """
    patch = F.struct(F.col(order).alias("place"), "description", F.col("salary_min").alias("low"), F.col("salary_max").alias("high"))
    patches = updates.groupBy("job_id").agg(F.array_sort(F.collect_list(patch)).alias("_patches"))
    joined = raw.join(patches, "job_id", "left")
    begin = F.struct(F.col("description"), F.col("salary_min").alias("low"), F.col("salary_max").alias("high"))

    def applied(so_far: Column, patch: Column) -> Column:
        low, high = F.coalesce(patch["low"], so_far["low"]), F.coalesce(patch["high"], so_far["high"])
        fits = F.coalesce(high >= low, F.lit(True)) & F.coalesce(low >= 0, F.lit(True))
        text = F.coalesce(F.nullif(patch["description"], F.lit("")), so_far["description"])
        return F.when(fits, F.struct(text.alias("description"), low.alias("low"), high.alias("high"))).otherwise(so_far)

    final = F.when(F.col("_patches").isNull(), begin).otherwise(F.aggregate("_patches", begin, applied))
    joined = joined.withColumn("_final", final)
    changed = {
        "description": F.col("_final.description"), "salary_min": F.col("_final.low"), "salary_max": F.col("_final.high"),
    }
    if "salary_mid" in raw.columns:
        patched = F.col("_patches").isNotNull()
        changed["salary_mid"] = F.when(patched, salary_mid(F.col("_final.low"), F.col("_final.high"))).otherwise(F.col("salary_mid"))
    return joined.withColumns(changed).select(*raw.columns)


def patch_postings(updates: DataFrame, path: str, order: str, at: datetime | None = None) -> DataFrame:
    """Patch stored postings in place; (job_id, found, changed) of every patched id.

    The rules are those of `patched_postings`. Only the pieces the ids fall into are read, and only
    postings that come out different are written, whole, as a delta. All patches of a call become
    one version: a call that dies changes nothing, a call that is repeated finds nothing to change.
    `at` sets updated_at of the changed postings.
    """
    spark = with_checkpoint_dir(updates.sparkSession)
    incoming = updates.checkpoint()
    table = VersionedTable(spark, path, JOBS_RAW)
    stored = table.lookup(incoming).checkpoint()
    changed = patched_postings(stored, incoming, order).subtract(stored).checkpoint()
    table.replace_rows(changed if at is None else changed.withColumn("updated_at", F.lit(at).cast("timestamp_ntz")))
    ids = incoming.select("job_id").distinct()
    flags = [df.select("job_id", F.lit(True).alias(name)) for df, name in ((stored, "found"), (changed, "changed"))]
    report = ids.join(flags[0], "job_id", "left").join(flags[1], "job_id", "left")
    return report.select("job_id", *[F.coalesce(name, F.lit(False)).alias(name) for name in ("found", "changed")])


def month_of(day: Column) -> Column:
    return F.date_format(F.trunc(day, "month"), "yyyy-MM")


def export_table(spark: SparkSession, path: str) -> VersionedTable:
    """The stored export: a piece per month, so that a range of dates reads its months only."""
    return VersionedTable(spark, path, place=F.col("posted_month"))


def write_export(export: DataFrame, path: str, facts: dict | None = None) -> None:
    """Replace the whole export; readers see the old one until the new one is complete."""
    table = export_table(export.sparkSession, path)
    rows = export.withColumn("posted_month", month_of(F.col("posted_date")))
    table.replace_pieces(rows, table.manifest()["pieces"], facts, ORDER)


def months_between(begin: date, end: date) -> list[str]:
    """Months that days of [begin, end) are in."""
    return sorted({f"{begin + timedelta(n):%Y-%m}" for n in range((end - begin).days)})


def in_months(day: Column, months: list[str]) -> Column:
    """The day is in one of the months, as ranges that reach the scan."""
    out = F.lit(False)
    for month in months:
        first = date.fromisoformat(f"{month}-01")
        out = out | ((day >= F.lit(first)) & (day < F.lit((first + timedelta(31)).replace(day=1))))
    return out


def months_to_refresh(raw: VersionedTable, features: VersionedTable, facts: dict, begin: date) -> list[str]:
    """Months of the export that no longer hold what they should.

    Those are the months of postings that are new or changed, or whose features are, since the
    versions named in `facts`, and the months that the range has lost or gained at its beginning.
    A posting keeps its date.
    """
    keys = features.changed_since(facts["features"]).select("job_id")
    days = raw.changed_since(facts["raw"]).select("posted_date").unionByName(raw.lookup(keys, ["job_id", "posted_date"]).select("posted_date"))
    was = date.fromisoformat(facts["begin"])
    recent = days.where(F.col("posted_date") >= F.lit(min(was, begin))).select(month_of(F.col("posted_date"))).distinct()
    return sorted({r[0] for r in recent.collect()} | set(months_between(min(was, begin), max(was, begin))))  # a row per month


def clustered_table(spark: SparkSession, path: str) -> VersionedTable:
    """Postings once more, a piece per month, each by city and day; unknown dates are a piece too."""
    return VersionedTable(spark, path, JOBS_RAW, place=F.coalesce(month_of(F.col("posted_date")), F.lit("unknown")))


def refresh_clustered(raw: VersionedTable, path: str) -> list[str]:
    """Bring the clustered copy up to date with the stored postings; the rewritten months.

    Those are the months of postings that are new or changed since the last time. A posting keeps
    its date.
    """
    table = clustered_table(raw.spark, path)
    version = raw.manifest()["version"]
    fresh = raw.changed_since(table.manifest()["facts"].get("raw", 0), version)
    name = F.coalesce(month_of(F.col("posted_date")), F.lit("unknown"))
    months = sorted(r[0] for r in fresh.select(name).distinct().collect())  # a row per month
    if months:
        table.replace_pieces(raw.read(version).where(name.isin(months)), months, {"raw": version}, ["city", "posted_date"])
    return months


def clustered_since(table: VersionedTable, as_of: date, days: int) -> DataFrame:
    """Postings of the last days, from their months only; 0 days stand for no bound.

    A filter on the city skips row groups inside the files, which hold a city's postings together.
    """
    if days <= 0:
        return table.read()
    begin = as_of - timedelta(days)
    rows = table.read(pieces=lambda name: name != "unknown" and name >= f"{begin:%Y-%m}")
    return rows.where(F.col("posted_date") >= F.lit(begin))
