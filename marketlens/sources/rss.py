"""RSS feeds to the posting schema.

Input rows hold the searched `city` and one item: title, link, summary, published, source_title.
"""

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marketlens.functions import location
from marketlens.functions.dates import syndication_date
from marketlens.functions.text import short_id, shortened, split_title_company, strip, truthy
from marketlens.operators.rows import with_parts
from marketlens.schemas import POSTING

# The source element carries a url attribute and its text.
ITEM = (
    "title string, link string, description string, pubDate string, updated string,"
    " source struct<_VALUE:string,_url:string>"
)


def _item_columns() -> list[Column]:
    return [
        F.col("title"),
        F.col("link"),
        F.col("description").alias("summary"),
        F.coalesce("pubDate", "updated").alias("published"),
        F.col("source._VALUE").alias("source_title"),
    ]


def read_items(spark: SparkSession, path: str, city: str) -> DataFrame:
    """Items of landed feed files of one searched city."""
    items = spark.read.format("xml").option("rowTag", "item").schema(ITEM).load(path)
    return items.select(F.lit(city).alias("city"), *_item_columns())


def parse_items(landed: DataFrame) -> DataFrame:
    """Items from a landed table of (city, item XML text)."""
    parsed = with_parts(landed.select("city", "item"), F.from_xml("item", ITEM))
    return parsed.select("city", *_item_columns())


def _normalised(
    items: DataFrame, source: str, title: Column, company: Column, province: Column, as_of: date,
    description_limit: int | None,
) -> DataFrame:
    values = {
        "source": F.lit(source),
        "job_id": F.concat(F.lit(f"{source}_"), short_id(F.col("link"))),
        "title": title,
        "company": company,
        "city": F.col("city"),
        "province": province,
        "description": F.coalesce(shortened(F.col("summary"), description_limit), F.lit("")),
        "posted_date": syndication_date(F.col("published"), as_of),
        "url": F.col("link"),
    }
    kept = items.where(truthy(F.col("title")).isNotNull() & truthy(F.col("link")).isNotNull())
    return kept.select(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in POSTING.fields]
    )


def indeed(items: DataFrame, as_of: date, description_limit: int | None = None) -> DataFrame:
    """The company is the last ' - ' part of the title."""
    trimmed = items.withColumn("title", strip(F.col("title")))
    role, company = split_title_company(F.col("title"))
    province = location.province_of_city(F.col("city"))
    return _normalised(trimmed, "indeed", role, company, province, as_of, description_limit)


def workopolis(items: DataFrame, as_of: date, description_limit: int | None = None) -> DataFrame:
    """The company is the item's source."""
    trimmed = items.withColumn("title", strip(F.col("title")))
    company = F.coalesce("source_title", F.lit("Unknown"))
    province = location.province_of_city_second_rss(F.col("city"))
    return _normalised(trimmed, "workopolis", F.col("title"), company, province, as_of, description_limit)
