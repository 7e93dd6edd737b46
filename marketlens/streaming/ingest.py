"""Daily ingest as a file stream: each new batch of landed postings is stored, processed and
counted once."""

from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from marketlens.operators.store import insert_postings
from marketlens.plans.refresh import Tables, process
from marketlens.schemas import JOBS_RAW, POSTING


def landed_postings(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of posting rows in JSON lines; `id` is their arrival order."""
    schema = T.StructType([JOBS_RAW["id"], *POSTING.fields])
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(folder)


def without_repeats(postings: DataFrame, arrived: str, horizon: str, keys: list[str] = ["job_id"]) -> DataFrame:
    """Leave out rows whose keys a row within the horizon had: the bounded option.

    State is kept for the horizon only, so it follows the rate of arrival and not the history. Rows
    that arrive later than the watermark allows are dropped; a key that comes back after its state
    has gone is let through. `insert_postings` needs no such bound, as it asks the stored table.
    """
    return postings.withWatermark(arrived, horizon).dropDuplicatesWithinWatermark(keys)


def ingest(
    postings: DataFrame, tables: Tables, checkpoint: str, as_of: date, source: str = "landing"
) -> StreamingQuery:
    """Store what has landed since the last run, then stop.

    A batch that is run again after a failure inserts nothing twice and is counted as the first
    time: the stored table knows the runs it has taken in.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        stamped = batch.withColumns(
            {
                "scraped_at": F.lit(now).cast("timestamp_ntz"),
                "created_at": F.lit(now).cast("timestamp_ntz"),
                "updated_at": F.lit(now).cast("timestamp_ntz"),
            }
        )
        insert_postings(
            stamped, tables.raw, ["id"], tables.metrics, source, f"batch-{batch_id}", now
        )
        process(batch.sparkSession, tables, as_of)

    return (
        postings.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
