"""Feeds, pages, stores and the ingest stream, over payloads derived from the postings."""

import uuid
from datetime import date, datetime

from pyspark.sql import functions as F

from marketlens.catalog.fixture import AS_OF, duck_with
from marketlens.catalog.overviews import LISTED, NEWEST, PLAUSIBLE
from marketlens.catalog.parsers import CITY, CODE, LONG, _column, _text
from marketlens.catalog.registry import ORACLES, POSTINGS, POSTINGS_AND_FEATURES, QUERIES, query
from marketlens.catalog.rules import CONTENT, ID_OK, REQUIRED_OK, _features, _first, _flat, _issues
from marketlens.operators import quality, rolling, search_index, store
from marketlens.operators.rows import first_per_key
from marketlens.operators.versioned import VersionedTable
from marketlens.plans import refresh, search
from marketlens.plans.refresh import Tables
from marketlens.plans.views import bi_export, is_flexible
from marketlens.schemas import JOBS_FEATURES, JOBS_RAW, POSTING
from marketlens.session import shared_folder
from marketlens.sources import feeds, html, rss
from marketlens.streaming import ingest

DAY = "DATE '2026-02-20'"
NUL = "NULL"


def _payload(fx, item: str, wrap: str, city: str = "'Calgary'"):
    """Landed table with one response per order, written as JSON text from named SQL values."""
    keyed = fx.raw.withColumn("k", F.col("id"))
    return keyed.select(
        _column(city).alias("city"), _column(wrap.format(item=item)).alias("payload")
    )


def _maybe_remote(t: str) -> str:
    words = " OR ".join(f"contains({t}, '{w}')" for w in ("remote", "work from home", "wfh", "distributed"))
    return f"CASE WHEN ({words}) AND contains({t}, 'hybrid') THEN 'hybrid' WHEN {words} THEN 'remote' END"


POSTING_SQL = """SELECT CAST('{source}' AS VARCHAR) AS source, '{source}_' || {native} AS job_id, {title} AS title,
  {company} AS company, {city} AS city, {province} AS province, {description} AS description,
  CAST({low} AS INT) AS salary_min, CAST({high} AS INT) AS salary_max, CAST({remote} AS VARCHAR) AS remote_type,
  CAST({posted} AS DATE) AS posted_date, {url} AS url
FROM (SELECT *, id AS k FROM jobs_raw) r"""

KNOWN = "city <> 'X1'"
TRUE_CODE = CODE.replace("k % 8", "(k // 48) % 8")
SWAPPED = {
    "low": "CASE WHEN salary_min > salary_max THEN salary_max ELSE salary_min END",
    "high": "CASE WHEN salary_min > salary_max THEN salary_min ELSE salary_max END",
}

ADZUNA_ITEM = f"""named_struct(
  'id', CASE WHEN k % 10 <> 0 THEN {_text("k")} END,
  'title', concat(' ', title, ' '),
  'company', named_struct('display_name', company),
  'location', named_struct('display_name', CASE k % 3 WHEN 0 THEN concat(city, ', ', {LONG}) WHEN 1 THEN city END,
    'area', CASE WHEN k % 3 = 1 THEN array('Canada', {LONG}) END),
  'salary_min', salary_min, 'salary_max', salary_max,
  'created', concat(CAST(posted_date AS STRING), 'T08:00:00Z'),
  'description', description,
  'redirect_url', CASE WHEN k % 10 = 0 OR k % 4 = 0 THEN url END)"""


@query(
    "s3_adzuna",
    POSTING_SQL.format(
        source="adzuna",
        native="CASE WHEN k % 10 <> 0 THEN CAST(k AS VARCHAR) ELSE md5(url) END",
        title="title", company="coalesce(company, 'Unknown')",
        city="CASE WHEN k % 3 = 2 THEN 'Calgary' ELSE city END",
        province=f"CASE WHEN k % 3 = 2 THEN 'AB' WHEN {KNOWN} THEN {TRUE_CODE} ELSE {CODE} END",
        description="coalesce(description, '')", remote=_maybe_remote("lower(description)"),
        posted=f"coalesce(posted_date, {DAY})",
        url="""CASE WHEN k % 10 = 0 OR k % 4 = 0 THEN url
          ELSE 'https://www.adzuna.ca/jobs/ca?q=' || replace(title, ' ', '+') END""",
        **SWAPPED,
    ),
    POSTINGS,
)
def _(fx):
    landed = _payload(fx, ADZUNA_ITEM, "to_json(named_struct('results', array({item})))")
    return feeds.adzuna(landed, AS_OF)


JSEARCH_ITEM = f"""named_struct(
  'job_id', CASE WHEN k % 5 <> 0 THEN {_text("k")} END,
  'job_title', CASE WHEN k % 2 = 0 THEN title ELSE '' END, 'position', CASE WHEN k % 2 = 1 THEN title END,
  'employer_name', CASE WHEN k % 3 = 0 THEN company END,
  'company', CASE WHEN k % 3 = 1 THEN named_struct('name', company) END,
  'job_city', CASE WHEN k % 4 <> 0 THEN city END,
  'job_state', CASE k % 3 WHEN 0 THEN {LONG} WHEN 1 THEN {CODE} ELSE 'Yukon' END,
  'job_posted_at_datetime_utc', CASE WHEN k % 2 = 0 THEN concat(CAST(posted_date AS STRING), 'T00:00:00.000Z') END,
  'job_posted_at', CASE WHEN k % 6 = 1 THEN '1769000000' END,
  'job_description', description, 'job_employment_type', CASE WHEN k % 9 = 0 THEN 'REMOTE' ELSE 'FULLTIME' END,
  'job_apply_link', CASE WHEN k % 7 <> 0 THEN url END,
  'job_min_salary', salary_min, 'job_max_salary', salary_max)"""
JSEARCH_NATIVE = """CASE WHEN k % 5 <> 0 THEN CAST(k AS VARCHAR)
  ELSE md5(CASE WHEN k % 7 <> 0 THEN url ELSE '' END) END"""
JSEARCH_FIRM = "CASE WHEN k % 3 = 2 THEN 'Unknown' ELSE coalesce(company, 'Unknown') END"


@query(
    "s4_jsearch",
    POSTING_SQL.format(
        source="jsearch", native=JSEARCH_NATIVE, title="title", company=JSEARCH_FIRM,
        city="CASE WHEN k % 4 <> 0 THEN city ELSE 'Calgary' END",
        province=f"CASE WHEN k % 3 = 2 THEN 'YU' ELSE {CODE} END",
        description="coalesce(description, '')",
        remote=_maybe_remote("lower(coalesce(description, '') || CASE WHEN k % 9 = 0 THEN ' remote' ELSE '' END)"),
        posted=f"CASE WHEN k % 2 = 0 THEN coalesce(posted_date, {DAY}) WHEN k % 6 = 1 THEN DATE '2026-01-21' ELSE {DAY} END",
        url=f"""CASE WHEN k % 7 <> 0 THEN url
          WHEN k % 5 <> 0 THEN 'https://www.google.com/search?q=jobs+' || k
          ELSE 'https://www.google.com/search?q=' || title || '+' || {JSEARCH_FIRM} || '+jobs' END""",
        **SWAPPED,
    ),
    POSTINGS,
)
def _(fx):
    landed = _payload(fx, JSEARCH_ITEM, "to_json(named_struct('data', array({item})))")
    return feeds.jsearch(landed, AS_OF)


RAPIDAPI_ITEM = f"""named_struct(
  'jobId', {_text("k")}, 'jobTitle', title, 'companyName', company,
  'location', CASE WHEN k % 3 <> 0 THEN concat(city, ', ', {LONG}, ', Canada') END,
  'jobDescription', description,
  'salary', concat('$', {_text("salary_min")}, ' - $', {_text("salary_max")}),
  'link', url, 'datePosted', CAST(posted_date AS STRING))"""
RAPIDAPI_TEXT = "lower(coalesce(description, '') || ' ' || title)"


@query(
    "s5_rapidapi",
    POSTING_SQL.format(
        source="rapidapi", native="k", title="title", company="coalesce(company, 'Unknown')",
        city="CASE WHEN k % 3 = 0 THEN 'Calgary' ELSE city END",
        province=f"CASE WHEN k % 3 = 0 THEN '' ELSE {CODE} END",
        description="coalesce(description, '')",
        low="CASE WHEN salary_max >= 10000 AND salary_min IS NOT NULL THEN least(salary_min, salary_max) END",
        high="CASE WHEN salary_max >= 10000 AND salary_min IS NOT NULL THEN greatest(salary_min, salary_max) END",
        remote=f"""CASE WHEN contains({RAPIDAPI_TEXT}, 'remote') AND contains({RAPIDAPI_TEXT}, 'hybrid') THEN 'hybrid'
          WHEN contains({RAPIDAPI_TEXT}, 'remote') THEN 'remote' ELSE 'onsite' END""",
        posted=f"coalesce(posted_date, {DAY})", url="url",
    ),
    POSTINGS,
)
def _(fx):
    landed = _payload(fx, RAPIDAPI_ITEM, "to_json(named_struct('jobs', array({item})))")
    return feeds.rapidapi(landed, AS_OF)


REMOTEOK_ITEM = f"""array(
  named_struct('id', 'legal', 'position', 'metadata', 'company', '', 'location', '', 'description', '',
    'date', '', 'url', '', 'slug', ''),
  named_struct('id', {_text("k")}, 'position', concat(title, ' '), 'company', company,
    'location', CASE k % 3 WHEN 0 THEN 'Victoria, BC, Canada' WHEN 1 THEN 'Chicago, IL' END,
    'description', concat('<p>', description, '</p>&lt;br&gt;R&amp;D'), 'date', concat(CAST(posted_date AS STRING), 'T00:00'),
    'url', CASE WHEN k % 2 = 0 THEN url END, 'slug', CASE WHEN k % 5 <> 0 THEN concat('job-', {_text("k")}) END))"""


@query(
    "s6_remoteok",
    POSTING_SQL.format(
        source="remoteok", native="k", title="title", company="coalesce(company, 'Unknown')",
        city="CASE k % 3 WHEN 0 THEN 'Victoria' WHEN 1 THEN 'Chicago' ELSE 'Remote' END",
        province="CASE k % 3 WHEN 0 THEN 'BC' ELSE 'ON' END",
        description="coalesce(' ' || description || '  R&D', '')", low=NUL, high=NUL, remote="'remote'",
        posted=f"coalesce(posted_date, {DAY})",
        url="""CASE WHEN k % 2 = 0 THEN url WHEN k % 5 <> 0 THEN 'https://remoteok.com/remote-jobs/job-' || k
          ELSE 'https://remoteok.com/remote-jobs/' || k END""",
    )
    + " WHERE regexp_matches(lower(title), '(^| )(data|analyst)( |$)')",
    POSTINGS,
)
def _(fx):
    landed = _payload(fx, REMOTEOK_ITEM, "to_json({item})")
    return feeds.remoteok(landed, AS_OF, roles=["data analyst"])


RSS_ITEM = """concat('<item><title>', title, ' - R&amp;D - ', coalesce(company, ''), '</title><link>', url,
  '</link><description>', coalesce(description, ''), '</description><pubDate>', {day}, '</pubDate>',
  '<source url="https://x.test">', coalesce(company, 'Unknown'), '</source></item>')"""


def _rss_items(fx):
    day = "coalesce(date_format(posted_date, 'E, dd MMM yyyy'), '') || ' 08:00:00 GMT'"
    landed = fx.raw.withColumn("k", F.col("id")).select(
        _column(CITY).alias("city"), F.expr(RSS_ITEM.format(day=day)).alias("item")
    )
    return rss.parse_items(landed)


RSS_COMMON = dict(
    native="md5(url)", city=CITY, low=NUL, high=NUL, remote=NUL, url="url",
    description="coalesce(description, '')", posted=f"coalesce(posted_date, {DAY})",
)


@query(
    "s7_indeed",
    POSTING_SQL.format(
        source="indeed", title="CASE WHEN company IS NULL THEN title ELSE title || ' - R&D' END",
        company="coalesce(company, 'R&D -')", province=CODE, **RSS_COMMON,
    ),
    POSTINGS,
)
def _(fx):
    return rss.indeed(_rss_items(fx), AS_OF)


@query(
    "s8_workopolis",
    POSTING_SQL.format(
        source="workopolis", title="CASE WHEN company IS NULL THEN title || ' - R&D -' ELSE title || ' - R&D - ' || company END",
        company="coalesce(company, 'Unknown')", province=CODE, **RSS_COMMON,
    ),
    POSTINGS,
)
def _(fx):
    return rss.workopolis(_rss_items(fx), AS_OF)


LISTING_PAGE = f"""concat('<html><body><nav>Salary guide</nav><!-- <article class="action-buttons"> -->',
  '<article id="a" class="x action-buttons"><a href="/jobsearch/jobposting/', {_text("k")}, '?source=x" class="resultJobItem">',
  '<h3 class="title"><span class="flag">New</span><span class="noctitle"> ', title, ' </span></h3><ul><li class="date">',
  CASE WHEN k % 2 = 0 THEN 'February 08, 2026' ELSE 'Posted 3 days ago' END, '</li><li class="business">Smith &amp; ',
  coalesce(company, 'Sons'), '</li><li class="location"><span class="fas" aria-hidden="true">*</span>',
  '<span class="wb-inv">Location</span> ', {CITY}, ' (', {CODE}, ')</li>',
  CASE WHEN k % 3 = 0 THEN '<li class="salary">Salary: $60,000.00 to $80,000.00 annually</li>'
    WHEN k % 3 = 1 THEN '<li class="salary">$25.50 hourly</li>' ELSE '' END,
  '</ul></a></article><article class="action-buttons"><a class="resultJobItem">no link</a></article>',
  '<article class="other"><a href="/1" class="resultJobItem"><span class="noctitle">x</span></a></article></body></html>')"""


@query(
    "s9_jobbank_listing",
    POSTING_SQL.format(
        source="jobbank", native="md5('/jobsearch/jobposting/' || k || '?source=x')",
        title="title", company="'Smith & ' || coalesce(company, 'Sons')", city=CITY, province=CODE,
        description="''", remote=NUL,
        low="CASE k % 3 WHEN 0 THEN 60000 WHEN 1 THEN 53040 END",
        high="CASE k % 3 WHEN 0 THEN 80000 WHEN 1 THEN 53040 END",
        posted="CASE WHEN k % 2 = 0 THEN DATE '2026-02-08' ELSE DATE '2026-02-17' END",
        url="'https://www.jobbank.gc.ca/jobsearch/jobposting/' || k || '?source=x'",
    ),
    POSTINGS,
)
def _(fx):
    pages = fx.raw.withColumn("k", F.col("id")).select(
        F.lit("Calgary").alias("city"), _column(LISTING_PAGE).alias("html")
    )
    return html.jobbank_listing(pages, AS_OF)


DETAIL_PAGE = f"""concat('<html><head><style>p{{}}</style></head><body><div class="job-posting-detail">short</div>',
  '<div id="job-description"><p>', coalesce(description, ''), '</p><script>var x = "$1";</script><p>',
  repeat('Long text. ', 10), '</p></div><dl><dt>Wage</dt><dd>$', {_text("25 + k % 10")}, '.00 per hour</dd></dl></body></html>')"""


@query(
    "s10_jobbank_detail",
    """SELECT 'https://www.jobbank.gc.ca/' || k AS url,
      coalesce(description || chr(10), '') || rtrim(repeat('Long text. ', 10)) AS description,
      CAST((25 + k % 10) * 2080 AS INT) AS salary_min, CAST((25 + k % 10) * 2080 AS INT) AS salary_max
    FROM (SELECT id AS k, trim(description) AS description FROM jobs_raw) r""",
    POSTINGS,
)
def _(fx):
    pages = fx.raw.withColumn("k", F.col("id")).select(
        F.concat(F.lit("https://www.jobbank.gc.ca/"), F.col("k").cast("string")).alias("url"),
        _column(DETAIL_PAGE).alias("html"),
    )
    return html.jobbank_detail(pages)


@query("s10_detail_of_pages")
def _(fx):
    return html.jobbank_detail(fx.table("pages"), site=None)


# All feeds together, with the check made when collecting.
FEEDS = ("s3_adzuna", "s4_jsearch", "s5_rapidapi", "s6_remoteok", "s7_indeed", "s8_workopolis", "s9_jobbank_listing")


def _every_feed(fx):
    parts = [QUERIES[name](fx.spark, fx.folder) for name in FEEDS]
    return feeds.union_feeds(*parts).where(quality.collected_ok())


def _collected_sql() -> str:
    start = duck_with(*POSTINGS)
    parts = [ORACLES[name].removeprefix(start) for name in FEEDS]
    return f"""SELECT source, job_id, province, posted_date FROM ({" UNION ALL ".join(parts)}) u
    WHERE {REQUIRED_OK} AND description IS NOT NULL AND {ID_OK}"""


@query("u1_collected_postings", _collected_sql(), POSTINGS)
def _(fx):
    return _every_feed(fx).select("source", "job_id", "province", "posted_date")


# Stores. Each call writes under a folder of its own in the shared folder.


def _folder(fx, name: str) -> str:
    return f"{shared_folder(fx.spark)}/{name}-{uuid.uuid4().hex}"


STORED = "jobs_raw WHERE source = 'adzuna'"
NEW_POSTINGS = f"""SELECT * REPLACE (CAST(low AS INT) AS salary_min, CAST(high AS INT) AS salary_max) FROM (
  SELECT *, {SWAPPED["low"]} AS low, {SWAPPED["high"]} AS high FROM ({_first("jobs_raw", "job_id")}) f
  WHERE job_id NOT IN (SELECT job_id FROM {STORED})) n"""


@query(
    "s11_new_postings",
    f"SELECT id, job_id, salary_min, salary_max, salary_mid FROM ({NEW_POSTINGS}) p", POSTINGS,
)
def _(fx):
    stored = fx.raw.where(F.col("source") == "adzuna")
    return store.new_postings(fx.raw, stored, ["id"]).select(
        "id", "job_id", "salary_min", "salary_max", "salary_mid"
    )


@query(
    "s14_insert_runs",
    f"""SELECT run_id, CAST(collected AS INT) AS jobs_collected, CAST(valid AS INT) AS jobs_valid,
      CAST(collected - valid AS INT) AS jobs_duplicates, status FROM (
      SELECT 'first' AS run_id, (SELECT count(*) FROM {STORED}) AS collected,
        (SELECT count(DISTINCT job_id) FROM {STORED}) AS valid, 'completed' AS status
      UNION ALL SELECT 'second', (SELECT count(*) FROM jobs_raw), (SELECT count(*) FROM ({NEW_POSTINGS}) p), 'completed'
      UNION ALL SELECT 'third', (SELECT count(*) FROM jobs_raw), 0, 'failed') r""",
    POSTINGS,
)
def _(fx):
    table, metrics = _folder(fx, "raw"), _folder(fx, "metrics")
    runs = [("first", fx.raw.where(F.col("source") == "adzuna")), ("second", fx.raw), ("third", fx.raw)]
    for run, batch in runs:
        store.insert_postings(batch, table, ["id"], metrics, "all", run, datetime(2026, 2, 20))
    return store.read_runs(fx.spark, metrics).select(
        "run_id", "jobs_collected", "jobs_valid", "jobs_duplicates", "status"
    )


@query(
    "s14_replayed_runs",
    f"""SELECT 'first' AS run_id, CAST((SELECT count(*) FROM {STORED}) AS INT) AS jobs_collected,
      CAST((SELECT count(DISTINCT job_id) FROM {STORED}) AS INT) AS jobs_valid, 'completed' AS status
    UNION ALL SELECT 'second', CAST((SELECT count(*) FROM jobs_raw) AS INT), CAST((SELECT count(*) FROM ({NEW_POSTINGS}) p) AS INT), 'completed'""",
    POSTINGS,
)
def _(fx):
    """Each run is repeated, as after a failure; the counts are those of the first time."""
    table, metrics = _folder(fx, "raw"), _folder(fx, "metrics")
    early = fx.raw.where(F.col("source") == "adzuna")
    for run, batch in (("first", early), ("first", early), ("second", fx.raw), ("second", fx.raw), ("first", early)):
        store.insert_postings(batch, table, ["id"], metrics, "all", run, datetime(2026, 2, 20))
    return store.read_runs(fx.spark, metrics).select("run_id", "jobs_collected", "jobs_valid", "status")


@query(
    "s11_stored_keys",
    f"""SELECT job_id, min(id) AS id FROM jobs_raw WHERE id % 20 = 0 AND job_id IN (SELECT job_id FROM {STORED}) GROUP BY job_id""",
    POSTINGS,
)
def _(fx):
    """Keys of a batch that are stored, looked up in the pieces they fall into."""
    table = VersionedTable(fx.spark, _folder(fx, "raw"), JOBS_RAW, piece_rows=500)
    stored = first_per_key(fx.raw.where(F.col("source") == "adzuna"), ["job_id"], ["id"])
    table.append(stored, expected_rows=stored.count())
    batch = fx.raw.where("id % 20 = 0")
    return batch.join(table.lookup(batch, ["job_id"]), "job_id", "left_semi").groupBy("job_id").agg(F.min("id").alias("id"))


@query(
    "s12_upserted_features",
    """SELECT job_id, CASE WHEN exp_level = 'mid' THEN exp_min ELSE coalesce(exp_min, 9) END AS exp_min,
      exp_max, exp_level FROM jobs_features""",
    POSTINGS_AND_FEATURES,
)
def _(fx):
    """Two upserts: older rows with a placeholder lower end, then all known values on top."""
    table = _folder(fx, "features")
    rows = fx.features.withColumn("extracted_at", F.lit(None).cast("timestamp_ntz")).select(*JOBS_FEATURES.names)
    older = rows.where(F.col("exp_level") != "mid").withColumn("exp_min", F.coalesce("exp_min", F.lit(9)))
    store.upsert_features(older, table, JOBS_FEATURES)
    store.upsert_features(rows, table, JOBS_FEATURES)
    return store.read_table(fx.spark, table, JOBS_FEATURES).select(
        "job_id", "exp_min", "exp_max", "exp_level"
    )


@query(
    "s13_patched_postings",
    """SELECT id, description, salary_min, salary_max,
      CAST((coalesce(salary_min, 0) + coalesce(salary_max, 0)) // 2 AS INT) AS salary_mid
    FROM (SELECT id, CASE WHEN hit AND fits AND id % 2 = 0 THEN 'fresh ' || id ELSE description END AS description,
      CAST(CASE WHEN hit AND fits AND id % 5 = 0 THEN 52000 ELSE salary_min END AS INT) AS salary_min, salary_max
    FROM (SELECT *, id % 3 = 0 AND job_id = source || '_' || id AS hit,
      coalesce(salary_max >= CASE WHEN id % 5 = 0 THEN 52000 ELSE salary_min END, TRUE) AS fits FROM jobs_raw
      QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY id) = 1) p) q""",
    POSTINGS,
)
def _(fx):
    raw = first_per_key(fx.raw, ["job_id"], ["id"])
    return store.patched_postings(raw, _patches(raw), "step").select(*PATCHED)


PATCHED = ["id", "description", "salary_min", "salary_max", "salary_mid"]


def _patches(raw):
    """Two patches for some postings, one for others; some with nothing to change, some refused."""
    k = F.col("id")
    updates = raw.where(k % 3 == 0).where(
        F.col("job_id") == F.concat_ws("_", F.col("source"), k.cast("string"))
    ).select(
        "job_id", "id",
        F.when(k % 2 == 0, F.concat(F.lit("fresh "), k.cast("string"))).otherwise(F.lit("")).alias("description"),
        F.when(k % 5 == 0, F.lit(52000)).alias("salary_min"),
        F.lit(None).cast("int").alias("salary_max"),
    )
    first = updates.withColumn("step", F.lit(1)).withColumn("description", F.lit("stale"))
    return first.where(k % 2 == 0).unionByName(updates.withColumn("step", F.lit(2)))


def _patched_table(fx):
    """A stored table of postings after the patches, and what the patch reported."""
    table = VersionedTable(fx.spark, _folder(fx, "raw"), JOBS_RAW)
    raw = first_per_key(fx.raw, ["job_id"], ["id"])
    table.append(raw, order=store.ORDER)
    unknown = raw.where("id % 50 = 0").select(F.concat(F.lit("no-"), "job_id").alias("job_id"), "id", "description", "salary_min", "salary_max", F.lit(1).alias("step"))
    return table, store.patch_postings(_patches(raw).unionByName(unknown), table.path, "step")


@query("s13_stored_patches", ORACLES["s13_patched_postings"].removeprefix(duck_with(*POSTINGS)).strip(), POSTINGS)
def _(fx):
    table, _ = _patched_table(fx)
    return table.read().select(*PATCHED)


@query(
    "s13_patch_report",
    """SELECT job_id, TRUE AS found, fits AND (id % 2 = 0 OR (id % 5 = 0 AND salary_min IS DISTINCT FROM 52000)) AS changed
    FROM (SELECT *, coalesce(salary_max >= CASE WHEN id % 5 = 0 THEN 52000 ELSE salary_min END, TRUE) AS fits FROM jobs_raw
      WHERE id % 3 = 0 AND job_id = source || '_' || id QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY id) = 1) p
    UNION ALL SELECT 'no-' || job_id, FALSE, FALSE FROM jobs_raw WHERE id % 50 = 0
      QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY id) = 1""",
    POSTINGS,
)
def _(fx):
    _, report = _patched_table(fx)
    return report


@query(
    "s16_written_export",
    """SELECT job_id, posted_date, strftime(posted_date, '%Y-%m') AS posted_month
    FROM jobs_raw jr LEFT JOIN jobs_features jf USING (job_id) WHERE posted_date >= DATE '2026-01-21'""",
    POSTINGS_AND_FEATURES,
)
def _(fx):
    table = _folder(fx, "export")
    store.write_export(bi_export(fx.raw, fx.features, AS_OF), table)
    return store.export_table(fx.spark, table).read().select("job_id", "posted_date", "posted_month")


@query(
    "s16_refreshed_export",
    """SELECT job_id, posted_date, exp_level, strftime(posted_date, '%Y-%m') AS posted_month
    FROM (SELECT * FROM jobs_raw QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY id) = 1) r
    LEFT JOIN jobs_features jf USING (job_id) WHERE posted_date >= DATE '2026-01-21'""",
    POSTINGS_AND_FEATURES,
)
def _(fx):
    """Built for an earlier day without some postings and features, then brought up to date."""
    tables = Tables(*[_folder(fx, n) for n in ("raw", "features", "export", "metrics")])
    raw, features = VersionedTable(fx.spark, tables.raw, JOBS_RAW), VersionedTable(fx.spark, tables.features, JOBS_FEATURES)
    rows, found = first_per_key(fx.raw, ["job_id"], ["id"]), first_per_key(fx.features, ["job_id"], ["job_id"])
    found = found.withColumn("extracted_at", F.lit(None).cast("timestamp_ntz")).select(*JOBS_FEATURES.names)
    late = F.col("posted_date").between("2026-02-01", "2026-02-09")
    steps = [(date(2026, 1, 31), ~F.coalesce(late, F.lit(False)), F.col("exp_level") == "mid"), (AS_OF, late, F.col("exp_level") != "mid")]
    for day, posted, level in steps:
        raw.append(rows.where(posted), order=store.ORDER)
        features.append(found.where(level))
        refresh.refresh_export(fx.spark, tables, day)
    return store.export_table(fx.spark, tables.export).read().select("job_id", "posted_date", "exp_level", "posted_month")


@query(
    "v3_rolled_city_stats", ORACLES["v3_city_stats"].removeprefix(duck_with(*POSTINGS_AND_FEATURES)).strip(), POSTINGS_AND_FEATURES,
)
def _(fx):
    """The report from daily states: filled for an earlier day without some postings, then rolled on."""
    raw, features = (VersionedTable(fx.spark, _folder(fx, name)) for name in ("raw", "features"))
    states = _folder(fx, "states")
    late = F.coalesce(F.col("posted_date").between("2026-02-11", "2026-02-14"), F.lit(False))
    for day, posted, level in ((date(2026, 2, 5), ~late, F.col("exp_level") == "mid"), (AS_OF, late, F.col("exp_level") != "mid")):
        raw.append(fx.raw.where(posted), order=store.ORDER)
        features.append(fx.features.where(level))
        rolling.roll_states(raw, features, states, day, is_flexible())
    return rolling.merged_states(rolling.states_table(fx.spark, states).read())


def _clustered(fx):
    """Stored postings, clustered in two steps."""
    raw, path = VersionedTable(fx.spark, _folder(fx, "raw"), JOBS_RAW), _folder(fx, "clustered")
    rows = first_per_key(fx.raw, ["job_id"], ["id"])
    for part in (F.col("source") == "adzuna", F.col("source") != "adzuna"):
        raw.append(rows.where(part), order=store.ORDER)
        store.refresh_clustered(raw, path)
    return store.clustered_table(fx.spark, path)


@query(
    "s1_clustered_recent",
    """SELECT job_id, city, posted_date FROM (SELECT * FROM jobs_raw QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY id) = 1) r
    WHERE posted_date >= DATE '2026-02-06' AND city = 'Ottawa'""",
    POSTINGS,
)
def _(fx):
    """P2 and a city on the clustered copy: one month's files are opened."""
    recent = store.clustered_since(_clustered(fx), AS_OF, 14)
    return recent.where(F.col("city") == "Ottawa").select("job_id", "city", "posted_date")


# Stored indexes: each is filled in two steps before it is asked.


def _features_index(fx):
    index = search_index.SkillIndex(fx.spark, _folder(fx, "skills"))
    index.add(fx.features.where(F.col("exp_level") == "mid"))
    index.add(fx.features.where(F.col("exp_level") != "mid"))
    return index


@query("p10_indexed_skills", "SELECT DISTINCT job_id FROM jobs_features WHERE list_has_all(skills, ['python', 'sql', 'aws'])", POSTINGS_AND_FEATURES)
def _(fx):
    return _features_index(fx).has_all(["sql", "python", "aws"])


def _titles(fx):
    """Postings as a stored table, and the index of their titles."""
    rows = first_per_key(fx.raw, ["job_id"], ["id"])
    table = VersionedTable(fx.spark, _folder(fx, "raw"), JOBS_RAW)
    table.append(rows, order=store.ORDER)
    index = search_index.SubstringIndex(fx.spark, _folder(fx, "titles"), "title")
    for part in (F.col("source") == "adzuna", F.col("source") != "adzuna"):
        index.add(rows.where(part))
    return table, index


FIRST_POSTINGS = "(SELECT * FROM jobs_raw QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY id) = 1) r"


@query(
    "p6_indexed_titles",
    f"SELECT job_id, title FROM {FIRST_POSTINGS} WHERE title ILIKE '%senior%_ata%e_r%' OR title ILIKE '%q_'", POSTINGS,
)
def _(fx):
    """All postings whose title one of two patterns matches; the second has no three letters in a row."""
    table, index = _titles(fx)
    values = index.matching_values("%senior%_ata%e_r%").unionByName(index.matching_values("%q_"))
    return table.lookup(index.places.lookup(values), ["job_id", "title"])


@query(
    "q24_indexed_search",
    f"""SELECT {LISTED}, salary_min, salary_max FROM {FIRST_POSTINGS}
    WHERE contains(lower(title), 'lead') AND contains(lower(title), 'data') AND city = 'Toronto' AND {PLAUSIBLE} {NEWEST} LIMIT 200""",
    POSTINGS,
)
def _(fx):
    table, index = _titles(fx)
    return search.indexed_filter_search(table, index, search.FilterSpec(keywords="DATA lead", city="Toronto"), AS_OF)


@query(
    "q25_indexed_phrase",
    f"""SELECT {LISTED} FROM {FIRST_POSTINGS}
    WHERE title ILIKE '%security%analyst%' AND city ILIKE '%o%' AND {PLAUSIBLE} {NEWEST} LIMIT 100""",
    POSTINGS,
)
def _(fx):
    table, index = _titles(fx)
    return search.indexed_phrase_search(table, index, "show me security%analyst in o")


# The bounded option of ST2: events arrive by weeks, some again. Both sides make the same arrivals:
# a repeat in the same week, one a week later, one three weeks later, and one that is late.

ARRIVALS = """SELECT job_id, ts, week, 0 AS copy FROM base
  UNION ALL SELECT job_id, ts, week, 1 FROM base WHERE event_id % 10 = 1
  UNION ALL SELECT job_id, ts + INTERVAL 7 DAY, week + 1, 2 FROM base WHERE event_id % 10 = 2 AND week <= 2
  UNION ALL SELECT job_id, ts + INTERVAL 21 DAY, week + 3, 3 FROM base WHERE event_id % 10 = 3 AND week = 0
  UNION ALL SELECT job_id, ts, week + 2, 4 FROM base WHERE event_id % 10 = 4 AND week <= 2"""
ARRIVING = "SELECT concat('job_', CAST(event_id AS VARCHAR(20))) AS job_id, event_id, ts, {week} AS week FROM {events}"
REPEATS_HORIZON = "3 days"


@query(
    "st2_bounded_repeats",
    f"""WITH base AS ({ARRIVING.format(week="date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 7", events="events")}),
    arrivals AS ({ARRIVALS}),
    marks AS (SELECT week, date_trunc('milliseconds', max(max(ts)) OVER (ORDER BY week)) - INTERVAL 3 DAY AS mark FROM arrivals GROUP BY week),
    again AS (SELECT a.job_id, a.ts FROM arrivals a JOIN base b USING (job_id) JOIN marks m ON m.week = a.week - 1
      WHERE copy IN (2, 3) AND b.ts + INTERVAL 3 DAY <= mark)
    SELECT job_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS arrived FROM (SELECT job_id, ts FROM base UNION ALL SELECT * FROM again) kept""",
)
def _(fx):
    """A repeat is left out while the state of the first one lives; a late row always."""
    week = "CAST(floor(datediff(ts, DATE '2024-01-01') / 7) AS INT)"
    fx.spark.sql(ARRIVING.format(week=week, events="{events}"), events=fx.table("events")).createOrReplaceTempView("base")
    arrivals = fx.spark.sql(ARRIVALS).select("job_id", F.col("ts").cast("timestamp").alias("ts"), "week")
    landing, checkpoint, kept = (_folder(fx, name) for name in ("arrivals", "checkpoint", "kept"))
    last = arrivals.agg(F.max("week")).first()[0]
    for number in range(last + 1):
        arrivals.where(F.col("week") == number).drop("week").write.mode("append").parquet(landing)
        stream = fx.spark.readStream.schema("job_id string, ts timestamp").parquet(landing)
        written = ingest.without_repeats(stream, "ts", REPEATS_HORIZON).writeStream.format("parquet")
        written.option("checkpointLocation", checkpoint).option("path", kept).trigger(availableNow=True).start().awaitTermination()
    return fx.spark.read.parquet(kept).select("job_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("arrived"))


# The stream: two landings; the second one repeats the first and adds the rest.

def _landing(fx):
    columns = ["id", *POSTING.names]
    tables = Tables(*[_folder(fx, n) for n in ("raw", "features", "export", "metrics", "waiting")])
    landing, checkpoint = _folder(fx, "landing"), _folder(fx, "checkpoint")
    early = fx.raw.where(F.col("source").isin("jobbank", "adzuna")).select(*columns)
    for part in (early, fx.raw.select(*columns)):
        part.write.mode("append").json(landing)
        stream = ingest.landed_postings(fx.spark, landing)
        ingest.ingest(stream, tables, checkpoint, AS_OF).awaitTermination()
    return tables


@query("st1_ingested_postings", "SELECT count(*) AS rows, count(DISTINCT job_id) AS ids FROM "
       + f"({_first('jobs_raw', 'job_id')}) f", POSTINGS)
def _(fx):
    table = store.read_table(fx.spark, _landing(fx).raw, JOBS_RAW)
    return table.agg(F.count("*").alias("rows"), F.count_distinct("job_id").alias("ids"))


# Postings as stored: salary ends in order, first per job_id, missing descriptions made empty.
ARRIVED = f"""(SELECT * REPLACE (coalesce(description, '') AS description, CAST(low AS INT) AS salary_min,
  CAST(high AS INT) AS salary_max) FROM (SELECT *, {SWAPPED["low"]} AS low, {SWAPPED["high"]} AS high
  FROM ({_first("jobs_raw", "job_id")}) f) g)"""


def _ingested(waiting: str) -> str:
    """Storable features of the valid postings that are first with their content."""
    valid = f"(SELECT * FROM (SELECT *, {_issues(False)} AS issues FROM {waiting}) x WHERE issues = '') v"
    kept = f"({_first(valid, CONTENT)}) k"
    return f"SELECT * FROM ({_features(kept)}) f WHERE coalesce(exp_max >= exp_min, TRUE)"


@query(
    "st1_ingested_features",
    f"""WITH day_one AS ({_ingested(f"(SELECT * FROM {ARRIVED} a WHERE source IN ('jobbank', 'adzuna')) w")}),
    day_two AS ({_ingested(f"(SELECT * FROM {ARRIVED} a WHERE job_id NOT IN (SELECT job_id FROM day_one)) w")})
    SELECT job_id, exp_min, exp_max, exp_level, skills, is_remote FROM day_one
    UNION ALL SELECT job_id, exp_min, exp_max, exp_level, skills, is_remote FROM day_two""",
    POSTINGS,
)
def _(fx):
    features = store.read_table(fx.spark, _landing(fx).features, JOBS_FEATURES)
    return _flat(features).select("job_id", "exp_min", "exp_max", "exp_level", "skills", "is_remote")


@query(
    "st3_ingest_runs",
    f"""SELECT 'batch-0' AS run_id, CAST(count(*) AS INT) AS jobs_collected,
      CAST(count(DISTINCT job_id) AS INT) AS jobs_valid FROM jobs_raw WHERE source IN ('jobbank', 'adzuna')
    UNION ALL SELECT 'batch-1', CAST(count(*) AS INT), CAST((SELECT count(DISTINCT job_id) FROM jobs_raw
      WHERE job_id NOT IN (SELECT job_id FROM jobs_raw WHERE source IN ('jobbank', 'adzuna'))) AS INT) FROM jobs_raw""",
    POSTINGS,
)
def _(fx):
    return store.read_runs(fx.spark, _landing(fx).metrics).select("run_id", "jobs_collected", "jobs_valid")
