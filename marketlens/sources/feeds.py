"""JSON posting feeds to the posting schema.

Input is a landed table with the searched `city` and the response text `payload`. Every feed is
parsed with a fixed schema, exploded to items and mapped with column expressions; an item that
lacks what its feed requires gives no row.
"""

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marketlens.functions import dates, location, remote, salary
from marketlens.functions.text import first_truthy, html_to_text, short_id, shortened, strip, truthy
from marketlens.operators.quality import title_has_role_word
from marketlens.operators.rows import with_parts
from marketlens.schemas import POSTING

ADZUNA_ITEM = (
    "struct<id:string,title:string,company:struct<display_name:string>,"
    "location:struct<display_name:string,area:array<string>>,salary_min:double,salary_max:double,"
    "created:string,description:string,redirect_url:string,link:string>"
)
JSEARCH_ITEM = (
    "struct<job_id:string,id:string,job_title:string,title:string,position:string,"
    "employer_name:string,company_name:string,company:string,employer:string,location:string,"
    "job_city:string,city:string,job_state:string,state:string,job_employment_type:string,"
    "job_posted_at_datetime_utc:string,job_posted_at:string,job_min_salary:double,"
    "job_max_salary:double,job_apply_link:string,link:string,job_description:string,"
    "description:string>"
)
RAPIDAPI_ITEM = (
    "struct<id:string,jobId:string,job_id:string,title:string,jobTitle:string,position:string,"
    "company:string,companyName:string,employer:string,location:string,jobLocation:string,"
    "description:string,jobDescription:string,salary:string,salaryRange:string,url:string,"
    "jobUrl:string,link:string,postedAt:string,datePosted:string,posted_date:string>"
)
REMOTEOK_ITEM = (
    "struct<id:string,position:string,title:string,company:string,location:string,"
    "description:string,date:string,url:string,slug:string>"
)


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Landed responses: one JSON object {"city": ..., "payload": "<response text>"} per line."""
    return spark.read.schema("city string, payload string").json(path)


def _items(landed: DataFrame, item: str, lists: list[str]) -> DataFrame:
    """One row per item of the first list the response has."""
    body = F.from_json("payload", ", ".join(f"{name} array<{item}>" for name in lists))
    return (
        landed.select("city", body.alias("body"))
        .select("city", F.explode(F.coalesce(*[F.col(f"body.{n}") for n in lists])).alias("item"))
        .where(F.col("item").isNotNull())
    )


def _posting(df: DataFrame, **columns: Column) -> DataFrame:
    """Project to the posting schema in its types."""
    return df.select(
        *[columns[f.name].cast(f.dataType).alias(f.name) for f in POSTING.fields]
    )


def _amount(value: Column) -> Column:
    return F.round(value, 0).try_cast("int")


def _ordered(low: Column, high: Column) -> tuple[Column, Column]:
    both = low.isNotNull() & high.isNotNull()
    return (
        _amount(F.when(both, F.least(low, high)).otherwise(low)),
        _amount(F.when(both, F.greatest(low, high)).otherwise(high)),
    )


def _prefixed(source: str, native: Column) -> Column:
    return F.concat(F.lit(f"{source}_"), native)


def adzuna(landed: DataFrame, as_of: date, description_limit: int | None = None) -> DataFrame:
    df = _items(landed, ADZUNA_ITEM, ["results"]).select("city", "item.*")
    place = location.area_search_location(
        F.col("location.display_name"), F.col("location.area"), F.col("city")
    )
    derived = F.struct(
        strip(F.col("title")).alias("job_name"),
        place.alias("place"),
        first_truthy(F.col("redirect_url"), F.col("link")).alias("target"),
    )
    df = with_parts(df, derived)
    native = F.coalesce(truthy(F.col("id")), short_id(F.col("target")))
    low, high = _ordered(F.col("salary_min"), F.col("salary_max"))
    search = F.concat(
        F.lit("https://www.adzuna.ca/jobs/ca?q="), F.replace("job_name", F.lit(" "), F.lit("+"))
    )
    description = F.coalesce("description", F.lit(""))
    return _posting(
        df.where((F.col("job_name") != "") & native.isNotNull()),
        source=F.lit("adzuna"),
        job_id=_prefixed("adzuna", native),
        title=F.col("job_name"),
        company=F.coalesce("company.display_name", F.lit("Unknown")),
        city=F.col("place.city"),
        province=F.col("place.province"),
        description=shortened(description, description_limit),
        salary_min=low,
        salary_max=high,
        remote_type=remote.maybe_remote_type(description),
        posted_date=F.when(truthy(F.col("created")).isNull(), F.lit(as_of)).otherwise(
            dates.prefix_date(F.col("created"), as_of)
        ),
        url=F.coalesce("target", search),
    )


def jsearch(landed: DataFrame, as_of: date, description_limit: int | None = None) -> DataFrame:
    df = _items(landed, JSEARCH_ITEM, ["data", "jobs", "results"]).select(
        F.col("city").alias("searched"), "item.*"
    )
    c = F.col
    nested = first_truthy(c("employer_name"), c("company_name"), c("company"))
    named = F.coalesce(
        F.get_json_object(nested, "$.name"), F.get_json_object(nested, "$.title"), F.lit("Unknown")
    )
    state = F.coalesce(
        first_truthy(c("job_state"), c("state"), F.get_json_object(c("location"), "$.state")), F.lit("")
    )
    native = F.coalesce(
        truthy(c("job_id")), c("id"), short_id(F.coalesce(c("job_apply_link"), c("link"), F.lit("")))
    )
    firm = F.when(nested.startswith("{"), named).otherwise(
        F.coalesce(nested, truthy(c("employer")), F.lit("Unknown"))
    )
    derived = F.struct(
        native.alias("native"),
        first_truthy(c("job_title"), c("title"), c("position")).alias("job_name"),
        firm.alias("firm"),
        F.coalesce(first_truthy(c("job_description"), c("description")), F.lit("")).alias("text"),
    )
    df = with_parts(df, derived)
    low, high = _ordered(c("job_min_salary"), c("job_max_salary"))
    search = F.lit("https://www.google.com/search?q=")
    return _posting(
        df.where(c("job_name").isNotNull()),
        source=F.lit("jsearch"),
        job_id=_prefixed("jsearch", c("native")),
        title=c("job_name"),
        company=c("firm"),
        city=first_truthy(
            c("job_city"), c("city"), F.get_json_object(c("location"), "$.city"), c("searched")
        ),
        province=location.province_of_state(state),
        description=shortened(c("text"), description_limit),
        salary_min=low,
        salary_max=high,
        remote_type=remote.maybe_remote_type(
            F.concat_ws(" ", c("text"), F.coalesce("job_employment_type", F.lit("")))
        ),
        posted_date=dates.epoch_date(
            first_truthy(c("job_posted_at_datetime_utc"), c("job_posted_at")), as_of
        ),
        url=F.coalesce(
            first_truthy(c("job_apply_link"), c("link")),
            F.when(truthy(c("job_id")).isNotNull(), F.concat(search, F.lit("jobs+"), c("native"))),
            F.concat(search, c("job_name"), F.lit("+"), c("firm"), F.lit("+jobs")),
        ),
    )


def rapidapi(landed: DataFrame, as_of: date, description_limit: int | None = None) -> DataFrame:
    df = _items(landed, RAPIDAPI_ITEM, ["data", "jobs"]).select(
        F.col("city").alias("searched"), "item.*"
    )
    c = F.col
    place_text = first_truthy(
        c("location"), c("jobLocation"), F.concat(c("searched"), F.lit(", Canada"))
    )
    derived = F.struct(
        first_truthy(c("id"), c("jobId"), c("job_id")).alias("native"),
        first_truthy(c("title"), c("jobTitle"), c("position")).alias("job_name"),
        location.feed_location(place_text).alias("place"),
        F.coalesce(first_truthy(c("description"), c("jobDescription")), F.lit("")).alias("text"),
        salary.feed_salary(first_truthy(c("salary"), c("salaryRange"))).alias("pay"),
    )
    df = with_parts(df, derived)
    return _posting(
        df.where(c("native").isNotNull() & c("job_name").isNotNull() & ~c("pay.malformed")),
        source=F.lit("rapidapi"),
        job_id=_prefixed("rapidapi", c("native")),
        title=c("job_name"),
        company=F.coalesce(
            first_truthy(c("company"), c("companyName"), c("employer")), F.lit("Unknown")
        ),
        city=c("place.city"),
        province=c("place.province"),
        description=shortened(c("text"), description_limit),
        salary_min=c("pay.salary_min"),
        salary_max=c("pay.salary_max"),
        remote_type=remote.always_remote_type(c("text"), c("job_name")),
        posted_date=dates.millis_date(
            first_truthy(c("postedAt"), c("datePosted"), c("posted_date")), as_of
        ),
        url=F.coalesce(first_truthy(c("url"), c("jobUrl"), c("link")), F.lit("")),
    )


def remoteok(
    landed: DataFrame, as_of: date, roles: list[str] = (), description_limit: int | None = None
) -> DataFrame:
    """The response is a list whose first entry describes the feed; `roles` filters titles."""
    entries = F.from_json("payload", f"array<{REMOTEOK_ITEM}>")
    c = F.col
    df = (
        landed.select(F.posexplode(entries).alias("pos", "item"))
        .where((c("pos") > 0) & c("item").isNotNull())
        .select("item.*")
    )
    derived = F.struct(
        strip(F.coalesce(first_truthy(c("position"), c("title")), F.lit(""))).alias("job_name"),
        location.remote_location(strip(F.coalesce("location", F.lit("")))).alias("place"),
        truthy(strip(c("url"))).alias("target"),
    )
    df = with_parts(df, derived)
    page = F.concat(F.lit("https://remoteok.com/remote-jobs/"), F.coalesce("slug", "id"))
    iso = F.regexp_extract("date", r"\d{4}-\d{2}-\d{2}", 0)
    return _posting(
        df.where((c("job_name") != "") & truthy(c("id")).isNotNull()).where(
            title_has_role_word(c("job_name"), list(roles))
        ),
        source=F.lit("remoteok"),
        job_id=_prefixed("remoteok", c("id")),
        title=c("job_name"),
        company=F.coalesce(truthy(strip(c("company"))), F.lit("Unknown")),
        city=c("place.city"),
        province=c("place.province"),
        description=F.coalesce(html_to_text(c("description"), description_limit), F.lit("")),
        salary_min=F.lit(None),
        salary_max=F.lit(None),
        remote_type=F.lit("remote"),
        posted_date=F.when(iso != "", iso.try_cast("date")).otherwise(F.lit(as_of)),
        url=F.coalesce("target", page),
    )


def union_feeds(*postings: DataFrame) -> DataFrame:
    """All feeds as one table of the posting schema."""
    out = postings[0]
    for more in postings[1:]:
        out = out.unionByName(more)
    return out
