"""Column parsers over texts derived from order keys, whose right reading is plain arithmetic."""

from pyspark.sql import functions as F

from marketlens.catalog.fixture import AS_OF, CITIES, PROVINCES
from marketlens.catalog.registry import query
from marketlens.functions import dates, location, remote, salary, text
from marketlens.operators.rows import with_parts

DAY = "DATE '2026-02-20'"
CITY = "CASE k % 8 " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(CITIES)) + " END"
CODE = "CASE k % 8 " + " ".join(f"WHEN {i} THEN '{p}'" for i, p in enumerate(PROVINCES)) + " END"
# The long province names in city order.
LONG = """CASE k % 8 WHEN 0 THEN 'Ontario' WHEN 1 THEN 'British Columbia' WHEN 2 THEN 'alberta'
  WHEN 3 THEN 'Ontario' WHEN 4 THEN 'Alberta' WHEN 5 THEN 'Quebec' WHEN 6 THEN 'MANITOBA'
  ELSE 'Saskatchewan' END"""


def _case(modulus: int, branches: list[str]) -> str:
    cases = " ".join(f"WHEN {i} THEN {b}" for i, b in enumerate(branches))
    return f"CASE k % {modulus} {cases} END"


def _keys(fx):
    return fx.table("orders").select(F.col("o_orderkey").alias("k"))


KEYS = "(SELECT o_orderkey AS k FROM orders) o"


def _text(number: str) -> str:
    return f"CAST({number} AS VARCHAR(20))"


def _column(expression: str):
    """The shared SQL expression as a Spark column (VARCHAR reads as STRING there)."""
    return F.expr(expression.replace("VARCHAR(20)", "STRING"))


# Salaries. a and b are whole dollars; the texts spell them in the ways feeds do.
A, B = "(20 + k % 37)", "(22 + k % 41)"
ANNUAL = f"'$' || {_text(A)} || ',000 to $' || {_text(B)} || ',000'"
HOURLY = f"'$' || {_text(A)} || '.50 - $' || {_text(B)} || '.25 per hour'"
SINGLE_HOURLY = f"'$' || {_text(A)} || ' hourly'"
BIWEEKLY = f"'$' || {_text(A)} || '00 bi-weekly'"
BOARD_PAY = _case(
    9, [ANNUAL, HOURLY, SINGLE_HOURLY, BIWEEKLY, "'Salary not specified'", "'notary $70,000'",
        "'$8 - $35'", "'Negotiable.'", "NULL"],
)
LOW = f"least({A} * 1000, {B} * 1000)"
HIGH = f"greatest({A} * 1000, {B} * 1000)"
HOUR_A, HOUR_B = f"({A} * 2080 + 1040)", f"({B} * 2080 + 520)"


def _readings(branches: list[tuple[str, str]], modulus: int) -> str:
    low = _case(modulus, [b[0] for b in branches])
    high = _case(modulus, [b[1] for b in branches])
    return f"CAST({low} AS INT) AS salary_min, CAST({high} AS INT) AS salary_max"


NONE = ("NULL", "NULL")
BOARD_READINGS = [
    (LOW, HIGH), (f"least({HOUR_A}, {HOUR_B})", f"greatest({HOUR_A}, {HOUR_B})"),
    (f"{A} * 2080", f"{A} * 2080"), (f"{A} * 2600", f"{A} * 2600"),
    NONE, NONE, NONE, NONE, NONE,
]


@query(
    "f1_board_salary",
    f"SELECT k, {_readings(BOARD_READINGS, 9)}, k % 9 = 7 AS malformed FROM {KEYS}",
)
def _(fx):
    df = _keys(fx).withColumn("pay", _column(BOARD_PAY))
    return with_parts(df, salary.board_salary(F.col("pay"))).drop("pay")


FEED_PAY = _case(
    7, [f"{_text(A)} || '000 - ' || {_text(B)} || '000'", HOURLY, f"'CAD ' || {_text(A)} || ',000'",
        f"{_text(A)} || '/hr'", "''", "'$8 to $35'", "'competitive'"],
)
FEED_READINGS = [
    (LOW, HIGH), BOARD_READINGS[1], (f"{A} * 1000", f"{A} * 1000"), (f"{A} * 2080", f"{A} * 2080"),
    NONE, NONE, NONE,
]


@query("f2_feed_salary", f"SELECT k, {_readings(FEED_READINGS, 7)} FROM {KEYS}")
def _(fx):
    df = _keys(fx).withColumn("pay", _column(FEED_PAY))
    return with_parts(df, salary.feed_salary(F.col("pay"))).drop("pay", "malformed")


# Places.
BOARD_PLACE = _case(
    5, [f"{CITY} || ' (' || {CODE} || ')'", f"{CITY} || ', ' || {LONG}", f"{CITY} || ',  ' || lower({CODE}) || ' '",
        CITY, f"{CITY} || ', Zealand'"],
)


@query(
    "f3_board_location",
    f"SELECT k, {CITY} AS city, {_case(5, [CODE, CODE, CODE, chr(39) * 2, chr(39) + 'ZE' + chr(39)])} AS province FROM {KEYS}",
)
def _(fx):
    df = _keys(fx).withColumn("place", _column(BOARD_PLACE))
    return with_parts(df, location.board_location(F.col("place"))).drop("place")


FEED_PLACE = _case(
    4, [f"{CITY} || ', ' || {LONG} || ', Canada'", f"{CITY} || ',' || {CODE} || ',Canada'", f"{CITY} || ', Canada'", f"{CITY} || ', Yukon'"],
)


@query(
    "f4_feed_location",
    f"SELECT k, {CITY} AS city, {_case(4, [CODE, CODE, chr(39) * 2, chr(39) + 'YU' + chr(39)])} AS province FROM {KEYS}",
)
def _(fx):
    df = _keys(fx).withColumn("place", _column(FEED_PLACE))
    return with_parts(df, location.feed_location(F.col("place"))).drop("place")


REMOTE_PLACE = _case(
    5, ["'Victoria, BC, Canada'", "'Chicago, IL'", "'Berlin'", "''", "'Montreal, Quebec, Canada'"],
)


@query(
    "f5_remote_location",
    f"""SELECT k, {_case(5, ["'Victoria'", "'Chicago'", "'Remote'", "'Remote'", "'Montreal'"])} AS city,
      {_case(5, ["'BC'", "'ON'", "'ON'", "'ON'", "'QC'"])} AS province FROM {KEYS}""",
)
def _(fx):
    df = _keys(fx).withColumn("place", _column(REMOTE_PLACE))
    return with_parts(df, location.remote_location(F.col("place"))).drop("place")


LAVAL = f"CASE WHEN k % 5 = 0 THEN 'Laval' WHEN k % 7 = 0 THEN 'Halifax' ELSE {CITY} END"


@query(
    "f6_province_of_city",
    f"""SELECT k, CASE WHEN k % 5 = 0 THEN 'QC' WHEN k % 7 = 0 THEN '' ELSE {CODE} END AS province,
      CASE WHEN k % 5 = 0 OR k % 7 = 0 THEN '' ELSE {CODE} END AS province_second_rss FROM {KEYS}""",
)
def _(fx):
    city = _column(LAVAL)
    return _keys(fx).select(
        "k", location.province_of_city(city).alias("province"),
        location.province_of_city_second_rss(city).alias("province_second_rss"),
    )


@query(
    "f7_province_of_region",
    f"""SELECT k, CASE WHEN k % 5 = 0 THEN '' ELSE {CODE} END AS province, {CODE} AS province_of_area FROM {KEYS}""",
)
def _(fx):
    name = _column(f"CASE WHEN k % 5 = 0 THEN 'Bavaria' ELSE {LONG} END")
    area = F.array(F.lit("Canada"), _column(f"CASE WHEN k % 3 = 0 THEN 'Prairies' ELSE {LONG} END"), _column(CODE))
    return _keys(fx).select(
        "k", location.province_of_region(name).alias("province"),
        location.province_of_area(area).alias("province_of_area"),
    )


@query(
    "f8_province_of_state",
    f"""SELECT k, {_case(5, [CODE, CODE, "'YU'", "''", "''"])} AS province FROM {KEYS}""",
)
def _(fx):
    state = _column(_case(5, [LONG, CODE, "'Yukon'", "'Y'", "NULL"]))
    return _keys(fx).select("k", location.province_of_state(state).alias("province"))


# Dates.
N_DAYS = "(k % 45)"
BOARD_DAY = _case(
    7, [f"'Posted ' || {_text(N_DAYS)} || ' days ago'", "'February 08, 2026'", "'Posted on 2026-02-01T10:00'",
        "'Yesterday'", "'today'", "NULL", "'soon'"],
)


@query(
    "f9_board_date",
    f"""SELECT k, CAST({_case(7, [f"{DAY} - CAST({N_DAYS} AS INT)", "DATE '2026-02-08'", "DATE '2026-02-01'",
      "DATE '2026-02-19'", DAY, DAY, DAY])} AS DATE) AS posted_date FROM {KEYS}""",
)
def _(fx):
    return _keys(fx).select("k", dates.board_date(_column(BOARD_DAY), AS_OF).alias("posted_date"))


SECONDS = "(1769000000 + (k % 40) * 86400)"
EPOCH_DAY = f"CAST(DATE '1970-01-01' + CAST(floor({SECONDS} / 86400.0) AS INT) AS DATE)"


@query(
    "f10_millis_date",
    f"SELECT k, {_case(4, [EPOCH_DAY, 'DATE ' + chr(39) + '2026-01-05' + chr(39), DAY, DAY])} AS posted_date FROM {KEYS}",
)
def _(fx):
    day = _column(_case(4, [_text(f"{SECONDS} * 1000"), "'2026-01-05T00:00:00'", "'recently'", "NULL"]))
    return _keys(fx).select("k", dates.millis_date(day, AS_OF).alias("posted_date"))


@query(
    "f10_epoch_date",
    f"SELECT k, {_case(4, [EPOCH_DAY, EPOCH_DAY, 'DATE ' + chr(39) + '2026-01-05' + chr(39), DAY])} AS posted_date FROM {KEYS}",
)
def _(fx):
    day = _column(_case(4, [_text(SECONDS), _text(f"{SECONDS} * 1000"), "'2026-01-05 00:00'", "''"]))
    return _keys(fx).select("k", dates.epoch_date(day, AS_OF).alias("posted_date"))


@query(
    "f10_prefix_date",
    f"SELECT k, CAST(o_orderdate AS DATE) AS posted_date FROM (SELECT o_orderkey AS k, o_orderdate FROM orders) o",
)
def _(fx):
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return fx.table("orders").select(
        F.col("o_orderkey").alias("k"), dates.prefix_date(stamp, AS_OF).alias("posted_date")
    )


@query(
    "f10_syndication_date",
    "SELECT k, CAST(o_orderdate AS DATE) + CASE WHEN k % 6 < 4 AND k % 6 <> 1 THEN 1 ELSE 0 END AS posted_date FROM (SELECT o_orderkey AS k, o_orderdate FROM orders) o",
)
def _(fx):
    k = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "E, dd MMM yyyy")
    stamp = F.concat(day, F.element_at(
        F.array(*[F.lit(t) for t in (" 23:30:00 -0500", " 08:00:00 GMT", " 21:00:00 EST", " 17:30:00 pdt", " 08:00:00", " 23:30:00 XYZ")]), (k % 6 + 1).cast("int")
    ))
    return fx.table("orders").select(k.alias("k"), dates.syndication_date(stamp, AS_OF).alias("posted_date"))


@query(
    "p13_days_since_event",
    "SELECT event_id, CAST(date_diff('day', CAST(ts AS DATE), DATE '2026-02-20') AS INT) AS days FROM events",
)
def _(fx):
    day = F.col("ts").cast("date")
    return fx.table("events").select("event_id", dates.age_in_days(day, AS_OF).alias("days"))


# Work arrangement.
WORK = _case(
    6, ["'Fully REMOTE team'", "'Remote or hybrid'", "'Distributed, flexible hours'", "'WFH'", "'Hybrid desk'", "'At the plant'"],
)


@query(
    "f11_always_remote_type",
    f"""SELECT k, {_case(6, ["'remote'", "'hybrid'", "'hybrid'", "'remote'", "'onsite'", "'onsite'"])} AS kind FROM {KEYS}""",
)
def _(fx):
    kind = remote.always_remote_type(_column(WORK), F.lit("Engineer"))
    return _keys(fx).select("k", kind.alias("kind"))


@query(
    "f12_maybe_remote_type",
    f"""SELECT k, {_case(6, ["'remote'", "'hybrid'", "'remote'", "'remote'", "NULL", "NULL"])} AS kind FROM {KEYS}""",
)
def _(fx):
    return _keys(fx).select("k", remote.maybe_remote_type(_column(WORK)).alias("kind"))


# Texts, ids, links.


@query("f13_strip_tags", "SELECT page_id, regexp_replace(html, '<[^>]+>', ' ', 'g') AS plain FROM pages")
def _(fx):
    return fx.table("pages").select("page_id", text.strip_tags(F.col("html")).alias("plain"))


@query("f13_html_to_text")
def _(fx):
    """Whole pages, no length limit."""
    return fx.table("pages").select("page_id", text.html_to_text(F.col("html"), None).alias("plain"))


@query(
    "f14_ids",
    """SELECT page_id, md5(url) AS short_id,
      CASE WHEN page_id % 2 = 0 THEN CAST(page_id AS VARCHAR) ELSE md5(url || '/x') END AS path_id
    FROM pages""",
)
def _(fx):
    url = F.col("url")
    path = F.when(
        F.col("page_id") % 2 == 0, F.concat(F.lit("/jobs/"), F.col("page_id").cast("string"), F.lit("/"))
    ).otherwise(F.concat(url, F.lit("/x")))
    return fx.table("pages").select(
        "page_id", text.short_id(url).alias("short_id"), text.path_id(path).alias("path_id")
    )


@query(
    "f15_title_and_company",
    """SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_name WHEN p_partkey % 3 = 1 THEN p_name || ' - night'
        ELSE p_name END AS title,
      CASE WHEN p_partkey % 3 = 2 THEN 'Unknown' ELSE p_brand END AS company FROM part""",
)
def _(fx):
    k = F.col("p_partkey") % 3
    full = (
        F.when(k == 0, F.concat_ws(" - ", "p_name", "p_brand"))
        .when(k == 1, F.concat_ws(" - ", F.col("p_name"), F.lit("night"), F.col("p_brand")))
        .otherwise(F.col("p_name"))
    )
    title, company = text.split_title_company(F.col("full"))
    return fx.table("part").withColumn("full", full).select(
        "p_partkey", title.alias("title"), company.alias("company")
    )


@query(
    "f16_absolute_url",
    """SELECT page_id, CASE page_id % 4 WHEN 0 THEN url WHEN 1 THEN 'https://site.test/p/' || page_id
      WHEN 2 THEN 'https://cdn.test/' || page_id ELSE 'https://site.test/rel/' || page_id END AS link FROM pages""",
)
def _(fx):
    k, page = F.col("page_id") % 4, F.col("page_id").cast("string")
    found = (
        F.when(k == 0, F.col("url")).when(k == 1, F.concat(F.lit("/p/"), page))
        .when(k == 2, F.concat(F.lit("//cdn.test/"), page)).otherwise(F.concat(F.lit("rel/"), page))
    )
    return fx.table("pages").withColumn("found", found).select(
        "page_id", text.absolute_url("https://site.test", F.col("found")).alias("link")
    )


@query(
    "f21_words",
    "SELECT p_partkey, array_to_string(string_split(lower(p_name), ' '), '|') AS words FROM part",
)
def _(fx):
    return fx.table("part").select("p_partkey", F.array_join(text.words(F.col("p_name")), "|").alias("words"))
