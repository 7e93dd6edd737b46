"""Operators against brute force and invariants on small tables."""

import difflib
import html as html_module
import itertools
import random
import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from marketlens.catalog.fixture import AS_OF, Fixture
from marketlens.operators import near_duplicates, quality, store
from marketlens.operators.dedupe import deduplicate, drop_repeated_legal_names
from marketlens.operators.features import extract_features
from marketlens.plans import refresh, search
from marketlens.plans.refresh import Tables
from marketlens.schemas import JOBS_FEATURES, JOBS_RAW, POSTING
from marketlens.sources import feeds, html, rss

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def fx(spark):
    return Fixture(spark, FOLDER)


def norm(value):
    kept = re.sub(r"[^a-z0-9\s]", "", value.lower().strip())
    return re.sub(r"\s+", " ", kept)


def made_up_titles(seed, count):
    rng = random.Random(seed)
    words = "senior junior data analyst engineer dev ops qa web lead ii a aa aaaa b ab sr xyz".split()
    for _ in range(count):
        title = list(" ".join(rng.choice(words) for _ in range(rng.randint(1, 4))))
        if rng.random() < 0.5:
            spot = rng.randrange(len(title))
            title[spot:spot + rng.randint(0, 1)] = rng.choice("abcz ")
        yield "".join(title)


@pytest.mark.parametrize(
    "threshold, limits, long",
    [(0.5, (), 60), (0.7, (20,), 60), (0.85, (), 60), (0.85, (20,), 12), (0.85, (20, 120), 60), (0.95, (0, 0), 20)],
)
def test_near_contents_equal_all_pairs(spark, monkeypatch, threshold, limits, long):
    """Two of three rows share one company: the filter must lose no pair of the hot group."""
    monkeypatch.setattr(near_duplicates, "LONG", long)
    rows = [(i, t, "acme" if i % 3 else "Beta", "x") for i, t in enumerate(made_up_titles(3, 250))]
    df = spark.createDataFrame(rows, "id long, title string, company string, city string")
    found = near_duplicates.near_contents(near_duplicates.contents(df), threshold, limits)
    got = {
        (r.first_id_1, r.first_id_2): (r.score, r.score_reversed) for r in found.collect()
    }
    first = {}
    for i, title, company, _ in rows:
        first.setdefault((norm(company), norm(title)), i)
    expected = {}
    for ((c1, t1), i), ((c2, t2), j) in itertools.combinations(sorted(first.items(), key=lambda x: x[1]), 2):
        if c1 == c2:
            scores = [difflib.SequenceMatcher(None, *p).ratio() for p in ((t1, t2), (t2, t1))]
            if max(scores) >= threshold:
                expected[i, j] = scores
    assert got.keys() == expected.keys()
    for pair, (score, back) in got.items():
        want = expected[pair]
        assert score == pytest.approx(want[0]) or (score == 0.0 and want[0] < threshold)
        assert back == pytest.approx(want[1]) or (back == 0.0 and want[1] < threshold)


def test_near_contents_of_parts(spark, fx):
    """The registered query against all pairs of the smallest part table."""
    import __spark_entry__ as entry_points

    got = entry_points.queries()["d5_near_contents_of_parts"](spark, FOLDER).collect()
    first = {}
    for p in fx.table("part").orderBy("p_partkey").collect():
        first.setdefault((norm(p.p_brand), norm(p.p_type), norm(p.p_name)), p.p_partkey)
    expected = set()
    for (a, i), (b, j) in itertools.combinations(sorted(first.items(), key=lambda x: x[1]), 2):
        if a[:2] == b[:2]:
            ratio = max(difflib.SequenceMatcher(None, *p).ratio() for p in ((a[2], b[2]), (b[2], a[2])))
            if ratio >= 0.85:
                expected.add((i, j))
    assert {(r.first_id_1, r.first_id_2) for r in got} == expected


def test_members_and_contents_say_who_repeats(spark):
    rows = [(i, "Data Analyst", "Acme", "Toronto") for i in range(50)] + [(50, "data  analyst!", "ACME", "toronto")]
    df = spark.createDataFrame(rows, "id long, title string, company string, city string")
    (content,) = near_duplicates.contents(df).collect()
    assert (content.first_id, content.postings) == (0, 51)
    assert near_duplicates.posting_contents(df).select("norm_title").distinct().count() == 1


def test_html_to_text_of_pages(spark, fx):
    import __spark_entry__ as entry_points

    got = {r.page_id: r.plain for r in entry_points.queries()["f13_html_to_text"](spark, FOLDER).collect()}
    for page in fx.table("pages").collect():
        assert got[page.page_id] == re.sub(r"<[^>]+>", " ", html_module.unescape(page.html))


def test_deduplicating_twice_changes_nothing(fx):
    once = deduplicate(fx.raw, ["id"])
    assert once.count() == deduplicate(once, ["id"]).count()


def test_first_row_of_a_hot_key_survives(spark):
    df = spark.range(0, 9000, numPartitions=6).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("job_id"),
        F.col("id").cast("string").alias("title"), F.lit("c").alias("company"), F.lit("x").alias("city"),
    )
    kept = deduplicate(df, ["id"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2
    rows = kept.where("job_id = 'hot'").collect()
    assert [r.id for r in rows] == [0]
    assert kept.count() == 6001


def test_valid_and_invalid_make_the_input(fx):
    valid, invalid = quality.split(quality.validate(fx.raw, AS_OF))
    assert valid.count() + invalid.count() == fx.raw.count()
    assert invalid.where(F.size("validation_issues") == 0).count() == 0


def test_messages(spark):
    row = ("adzuna", "x_1", "QA", None, "X", "ZZ", "", 30, 20, None, date(2026, 3, 1), "ftp://a")
    df = spark.createDataFrame([row], POSTING)
    (got,) = quality.validate(df, AS_OF).collect()
    assert got.validation_issues == [
        "Missing required fields",
        "Invalid province code: ZZ",
        "Invalid city name: X",
        "Invalid salary range: 30 - 20",
        "Suspicious posted date: 2026-03-01",
        "Invalid URL: ftp://a",
        "Invalid title length: 2",
        "Invalid company name: None",
        "Job ID doesn't match source: x_1 vs adzuna",
    ]


def test_missing_description_gives_no_features(spark):
    df = spark.createDataFrame(
        [("a", "Dev", None, None), ("b", "Dev", "", None)],
        "job_id string, title string, description string, remote_type string",
    )
    assert [r.job_id for r in extract_features(df).collect()] == ["b"]


def test_upsert_keeps_known_values_and_repeats_safely(spark, tmp_path):
    path = str(tmp_path / "features")
    columns = "job_id string, exp_min int, exp_max int, exp_level string"

    def rows(values):
        df = spark.createDataFrame(values, columns)
        for field in JOBS_FEATURES.fields:
            if field.name not in df.columns:
                df = df.withColumn(field.name, F.lit(None).cast(field.dataType))
        return df.select(*JOBS_FEATURES.names)

    store.upsert_features(rows([(str(i), i, i, "mid") for i in range(40)]), path, JOBS_FEATURES)
    change = rows([("3", None, 9, None), ("x", 1, 2, "junior")])
    for _ in range(2):
        store.upsert_features(change, path, JOBS_FEATURES)
        got = {r.job_id: r for r in store.read_table(spark, path, JOBS_FEATURES).collect()}
        assert len(got) == 41
        assert (got["3"].exp_min, got["3"].exp_max, got["3"].exp_level) == (3, 9, "mid")
        assert got["x"].exp_max == 2 and got["7"].exp_min == 7


def test_patch_that_reverses_the_salary_is_dropped(spark):
    raw = spark.createDataFrame(
        [("a", "old", 10000, 20000), ("b", "old", 10000, 20000), ("c", "old", None, None)],
        "job_id string, description string, salary_min int, salary_max int",
    )
    updates = spark.createDataFrame(
        [("a", "new", 30000, None, 1), ("b", "", 12000, None, 1), ("b", "mid", None, None, 2), ("b", "", None, None, 3)],
        "job_id string, description string, salary_min int, salary_max int, step int",
    )
    got = {r.job_id: tuple(r)[1:] for r in store.patched_postings(raw, updates, "step").collect()}
    assert got == {"a": ("old", 10000, 20000), "b": ("mid", 12000, 20000), "c": ("old", None, None)}
    # A refused patch takes nothing of the others with it, and the middle follows the ends.
    chain = spark.createDataFrame(
        [("a", "first", 12000, None, 1), ("a", "refused", 99000, None, 2), ("a", "", None, 30000, 3)],
        "job_id string, description string, salary_min int, salary_max int, step int",
    )
    (row,) = store.patched_postings(raw.withColumn("salary_mid", F.lit(0)).where("job_id = 'a'"), chain, "step").collect()
    assert tuple(row)[1:] == ("first", 12000, 30000, 21000)


def test_process_stores_features_once(spark, fx, tmp_path):
    tables = Tables(*[str(tmp_path / n) for n in ("raw", "features", "export", "metrics")])
    names = [n for n in JOBS_RAW.names if n in fx.raw.columns]
    inserted = store.insert_postings(
        fx.raw.select(*names), tables.raw, ["id"], tables.metrics, "all", "r1", datetime(2026, 2, 20)
    )
    assert inserted == fx.raw.select("job_id").distinct().count()
    stored = refresh.process(spark, tables, AS_OF)
    assert stored > 0
    # Duplicates of stored content are looked at again, then nothing is left to do.
    while refresh.process(spark, tables, AS_OF):
        pass
    features = store.read_table(spark, tables.features, JOBS_FEATURES)
    assert features.count() == features.select("job_id").distinct().count()
    assert store.export_table(spark, tables.export).read().count() > 0
    limited = refresh.to_process(store.read_table(spark, tables.raw, JOBS_RAW), features, limit=3)
    assert limited.count() == 3


def test_recency_reaches_the_scan_of_a_stored_table(spark, fx, tmp_path):
    from marketlens.plans.views import city_stats

    tables = [str(tmp_path / n) for n in ("raw", "metrics")]
    store.insert_postings(fx.raw, tables[0], ["id"], tables[1], "all", "r1", datetime(2026, 2, 20))
    raw = store.read_table(spark, tables[0], JOBS_RAW)
    plan = city_stats(raw, fx.features, AS_OF)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "posted_date" in line and "FileScan" in line)
    assert "GreaterThanOrEqual(posted_date,2026-01-21)" in scan
    assert "description" not in scan and "url" not in scan


LISTING = """
<article class="action-buttons"><a class="resultJobItem" href="/jobsearch/jobposting/4711">
<span class="noctitle">Data  Analyst</span><ul><li class="business">A &amp; B</li>
<li class="location"><span class="wb-inv">Location</span> Ayr (ON)</li>
<li class="salary">$25 hourly</li><li class="date">Posted 2 days ago</li></ul></a></article>
<article class="action-buttons"><a class="resultJobItem" href="/x"><b>no title</b></a></article>
<article class="action-buttons"><a class="resultJobItem" href="/y"><span class="noctitle">Bad pay</span>
<li class="salary">$1.2.3</li></a></article>
<article class="action-buttons"><a class="resultJobItem" href="https://o.test/z"><span class="noctitle">Cook</span></a></article>
"""


def test_listing_page(spark):
    pages = spark.createDataFrame([("Regina", LISTING), ("Regina", "<p>none"), ("Regina", None)], "city string, html string")
    got = {r.title: r for r in html.jobbank_listing(pages, AS_OF).collect()}
    assert set(got) == {"Data  Analyst", "Cook"}
    row = got["Data  Analyst"]
    assert (row.job_id, row.company, row.city, row.province) == ("jobbank_4711", "A & B", "Ayr", "ON")
    assert (row.salary_min, row.salary_max, row.posted_date) == (52000, 52000, date(2026, 2, 18))
    assert row.url == "https://www.jobbank.gc.ca/jobsearch/jobposting/4711"
    cook = got["Cook"]
    assert (cook.company, cook.city, cook.province, cook.url) == ("Unknown", "Regina", "", "https://o.test/z")


def test_detail_page(spark):
    long = "word " * 60
    rows = [
        ("https://www.jobbank.gc.ca/1", f"<div id='job-description'>tiny</div><div class='details'>{long}</div><p>Pay <b>$30 hourly</b></p>"),
        ("https://www.jobbank.gc.ca/2", f"<div class='jobDetailBox'><p>{long}</p><p>{long}</p></div>"),
        ("https://elsewhere.test/3", "<p>Salary $90,000</p>"),
    ]
    got = {r.url[-1]: r for r in html.jobbank_detail(spark.createDataFrame(rows, "url string, html string")).collect()}
    assert set(got) == {"1", "2"}
    assert got["1"].description == long.strip() and got["1"].salary_min == 62400
    assert got["2"].description == f"{long.strip()}\n{long.strip()}" and got["2"].salary_min is None


def test_feed_files(spark, tmp_path):
    import json

    body = {"data": [{"id": "7", "title": "Dev", "location": "Ottawa, Ontario, Canada", "salary": "$30 per hour"}, {"id": "8"}]}
    (tmp_path / "r.json").write_text(json.dumps({"city": "Ottawa", "payload": json.dumps(body)}))
    (row,) = feeds.rapidapi(feeds.read_payloads(spark, str(tmp_path / "r.json")), AS_OF).collect()
    assert (row.job_id, row.city, row.province, row.salary_min) == ("rapidapi_7", "Ottawa", "ON", 62400)
    (tmp_path / "f.xml").write_text(
        "<rss><channel><item><title>Dev - Acme</title><link>https://l.test/1</link>"
        "<pubDate>Tue, 10 Feb 2026 08:00:00 GMT</pubDate><source url='u'>Src</source></item></channel></rss>"
    )
    items = rss.read_items(spark, str(tmp_path / "f.xml"), "Laval")
    (a,) = rss.indeed(items, AS_OF).collect()
    (b,) = rss.workopolis(items, AS_OF).collect()
    assert (a.title, a.company, a.province, a.posted_date) == ("Dev", "Acme", "QC", date(2026, 2, 10))
    assert (b.title, b.company, b.province) == ("Dev - Acme", "Src", "")


def test_remote_feed_skips_its_first_entry(spark):
    payload = '[{"id": "0", "position": "legal"}, {"id": "1", "position": "Data Dev"}, null, {"position": "x"}]'
    landed = spark.createDataFrame([("c", payload), ("c", "[]")], "city string, payload string")
    (row,) = feeds.remoteok(landed, AS_OF).collect()
    assert (row.job_id, row.city, row.url) == ("remoteok_1", "Remote", "https://remoteok.com/remote-jobs/1")
    assert feeds.remoteok(landed, AS_OF, ["cook"]).count() == 0


def test_phrases():
    assert search.parse_phrase("Find me data analyst in Toronto") == ("data analyst", "Toronto")
    assert search.parse_phrase("jobs get cook in Ayr") == ("cook", "Ayr")
    assert search.parse_phrase("cook in Ayr within last 5 days") is None
    assert search.parse_phrase("show me jobs in " + "x" * 51) is None
    assert search.parse_phrase("cook") is None
    # The first "in" between other words decides, and nothing is tried again after a refusal.
    assert search.parse_phrase("jobs in Toronto in Canada") is None
    assert search.parse_phrase(f"analyst in {'x' * 60} in Toronto") is None
    assert search.parse_phrase("show me in Toronto") == ("show me", "Toronto")
    assert search.parse_phrase("job in in Ottawa") is None
    assert search.parse_phrase("cook in Ayr in Scotland") == ("cook", "Ayr in Scotland")
    assert search.parse_phrase("recently posted cook in Ayr") is None and search.parse_phrase(" in Ayr") is None


def test_guarded_sql():
    assert search.guarded_sql_text("SELECT 1") == "SELECT 1 LIMIT 100"
    assert search.guarded_sql_text("SELECT 1 limit 5; x") == "SELECT 1 limit 5"
    for refused in ("DROP TABLE x", "SELECT updated_at FROM jobs_raw", "SELECT 1; delete"):
        with pytest.raises(ValueError):
            search.guarded_sql_text(refused)


def test_skill_seed(spark):
    from marketlens.plans import overview
    from marketlens.skills_seed import skills_master

    master = skills_master(spark)
    counts = {r.category: r.skills for r in overview.skills_per_category(master).collect()}
    assert sum(counts.values()) == 118 and len(counts) == 14
    assert (counts["programming"], counts["os"], counts["methodology"]) == (14, 3, 2)
    best = [r.skill for r in overview.relevant_skills(master, "data_analyst").limit(2).collect()]
    assert best == ["power bi", "sql"]
    first = overview.skills_by_category(master).first()
    assert (first.category, first.skill, first.alias_count) == ("backend", ".net", 2)


def test_legal_suffix_without_a_name_is_no_name(spark):
    rows = [(1, "QA", ""), (2, "QA", " Inc."), (3, "QA", " LTD "), (4, "QA", "Inc."), (5, "QA", None), (6, "QA", " Acme Ltd"), (7, "QA", "acme")]
    df = spark.createDataFrame(rows, "id int, title string, company string").withColumn("city", F.lit("Regina"))
    assert sorted(r.id for r in drop_repeated_legal_names(df, ["id"]).collect()) == [1, 4, 6]


MARKUP = """< > " &amp; & </p> <br> <div_class="a"> </div> <!--_x_--> <!----> <!--> <script> </script> <style> </SCRIPT> <p_id=3>
<P_ID="q"> <i_a='b'> <br/> &#65 </ <!DOCTYPE_html> <title> </title> <a_href="?a&copy=1"> </p_> <textarea> <p/> text <?x?> </br>""".split()


def test_plain_markup_gives_the_parsers_tree():
    """The quick way must agree with the parser wherever it takes a page, and take the pages of boards."""

    def parsed(markup):
        parser = html._Tree()
        parser.feed(markup)
        parser.close()
        return parser.root

    def spelled(node):
        return node.tag, node.attrs, node.text, [spelled(child) for child in node.children]

    rng, taken = random.Random(5), 0
    for _ in range(20000):
        markup = "".join(rng.choice(MARKUP).replace("_", " ") for _ in range(rng.randint(1, 8)))
        quick = html._plain_tree(markup)
        taken += quick is not None
        assert quick is None or spelled(quick) == spelled(parsed(markup)), markup
    assert taken > 1000
    page = '<article class="action-buttons"><a href="/1?a=1&amp;b" class="resultJobItem"><span class="noctitle">R&amp;D</span></a></article>'
    assert spelled(html._plain_tree(page)) == spelled(parsed(page))


def test_repeated_tags_are_read_once():
    page = '<article class="action-buttons"><a href="/{}" class="resultJobItem"><span class="noctitle">x</span></a></article>'
    html._markup.cache_clear()
    for number in range(50):
        assert len(list(html._listing_rows(page.format(number)))) == 1
    # Each page has a link of its own; the other tags are those of the first page.
    assert html._markup.cache_info().misses == 50 + 5


def test_plain_scripts_are_closed_where_they_end():
    for markup in ("<script>a</script >b", "<script>a<!-- c --></script>", "<style>a</script>", "<style>a"):
        assert html._plain_tree(markup) is None
    for markup in ("<script>a</script>b<!-- <p> -->c", '<style id="x"></style><p>a &lt; b</p>', "</script>a"):
        parser = html._Tree()
        parser.feed(markup)
        parser.close()
        trees = [[(n.tag, n.attrs, n.text) for n in root.walk()] for root in (html._plain_tree(markup), parser.root)]
        assert trees[0] == trees[1]
