"""Golden values of the column functions."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from marketlens.fixed_values import MAX_EXTRACTED_SKILLS
from marketlens.functions import dates, experience, location, roles, salary, skills, text

AS_OF = date(2026, 2, 20)


def apply(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    rows = df.select("i", function(F.col("x")).alias("r")).collect()
    out = [r.r for r in sorted(rows, key=lambda r: r.i)]
    return [tuple(v) if hasattr(v, "asDict") else v for v in out]


def test_experience(spark):
    cases = {
        "3-5 years of python": (3, 5),
        "3 to 5 yrs": (3, 5),
        "3 - - 5 yrs": (3, 5),
        "5+ years": (5, 8),
        "29 years": (29, 30),
        "0 years": (0, 3),
        "junior developer": (0, 2),
        "international team": (0, 2),
        "500-503 years": None,
        "99999999999999 years": None,
        "founded 40 years ago, minimum 5 years": (5, 8),
        "5-3 years": (5, 3),
        "at least 40 years, at least 7 yrs": None,
        "year": None,
    }
    assert apply(spark, experience.experience_range, list(cases)) == list(cases.values())


def test_levels(spark):
    rows = [(None, None), (0, 0), (0, 2), (1, 3), (3, 5), (5, 8), (9, 12), (None, 4), (4, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a int, b int")
    got = df.select(
        "i", experience.exp_level(F.col("a"), F.col("b")), experience.is_junior(F.col("a"), F.col("b")),
        experience.is_junior_unless_unknown(F.col("a"), F.col("b")),
    ).collect()
    got = sorted(tuple(r) for r in got)
    assert [r[1] for r in got] == [
        "mid", "entry", "entry", "junior", "mid", "senior", "lead", "junior", "mid",
    ]
    assert [r[2] for r in got] == [False, True, True, True, False, False, False, True, False]
    assert [r[3] for r in got] == [False, True, True, True, False, False, False, False, False]


@pytest.mark.parametrize(
    "words, expected",
    [
        ("$60,000 to $80,000", (60000, 80000, False)),
        ("$80,000 to $60,000", (60000, 80000, False)),
        ("$25 hourly", (52000, 52000, False)),
        ("$25.50-$35.00 per hour", (53040, 72800, False)),
        ("$2,000 biweekly", (52000, 52000, False)),
        ("$8 - $35", (None, None, False)),
        ("Salary not specified", (None, None, False)),
        ("notary $70,000", (None, None, False)),
        ("1.2.3", (None, None, True)),
        ("Negotiable.", (None, None, True)),
        ("$99999999999", (None, None, True)),
        ("", (None, None, False)),
        (None, (None, None, False)),
    ],
)
def test_board_salary(spark, words, expected):
    assert apply(spark, salary.board_salary, [words]) == [expected]


def test_salary_mid_counts_missing_ends_as_zero(spark):
    df = spark.createDataFrame([(None, None), (50001, None), (1, 2)], "a int, b int")
    got = df.select(salary.salary_mid(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == [0, 25000, 1]


def test_locations(spark):
    cases = {
        "Toronto (ON)": ("Toronto", "ON"),
        "Ayr (ON)": ("Ayr", "ON"),
        "Montréal (QC)": ("Montréal", "QC"),
        "Toronto": ("Toronto", ""),
        "Vancouver, British Columbia": ("Vancouver", "BC"),
        "Calgary, AB": ("Calgary", "AB"),
        "Calgary, zed": ("Calgary", "ZE"),
    }
    assert apply(spark, location.board_location, list(cases)) == list(cases.values())
    remote = {"Chicago, IL": ("Chicago", "ON"), "Berlin": ("Remote", "ON"), "Victoria, BC, Canada": ("Victoria", "BC")}
    assert apply(spark, location.remote_location, list(remote)) == list(remote.values())


def test_dates(spark):
    cases = {
        "Posted 5 days ago": date(2026, 2, 15),
        "February 08, 2026": date(2026, 2, 8),
        "february 8,  2026": date(2026, 2, 8),
        "2026-02-01T10:00": date(2026, 2, 1),
        "Yesterday": date(2026, 2, 19),
        "soon": AS_OF,
        "Feb 08, 2026": AS_OF,
    }
    got = apply(spark, lambda c: dates.board_date(c, AS_OF), [*cases, None])
    assert got == [*cases.values(), AS_OF]
    feeds = ["Tue, 10 Feb 2026 23:30:00 -0500", "Tue, 10 Feb 2026 08:00:00 GMT", "x", None]
    got = apply(spark, lambda c: dates.syndication_date(c, AS_OF), feeds)
    assert got == [date(2026, 2, 11), date(2026, 2, 10), AS_OF, AS_OF]


def test_skills(spark):
    cases = {
        "we use c++ daily": [],
        "c++11 and sql": ["c++", "sql"],
        "node.js, nodejs": ["nodejs"],
        "éjava postgresql": ["postgresql"],
        "excel looker python java javascript typescript rust react angular vue sql aws": [
            "python", "java", "javascript", "typescript", "rust", "react", "angular", "vue", "sql", "aws",
        ],
    }
    ten = lambda text: skills.extracted_skills(text, MAX_EXTRACTED_SKILLS)
    assert apply(spark, ten, list(cases)) == list(cases.values())
    assert apply(spark, skills.extracted_skills, [list(cases)[-1]]) == [[*list(cases.values())[-1], "looker", "excel"]]
    lists = [["a", 'b"c'], [], None]
    assert apply(spark, skills.skills_json, lists, "array<string>") == ['["a", "b\\"c"]', "[]", None]


def test_texts(spark):
    cases = {
        "Montréal": "montral",
        "  Data   Analyst!! ": "data analyst",
        "(New) Analyst": "new analyst",
        "a  b": "a b",
        "data -": "data ",
    }
    assert apply(spark, text.normalise, list(cases)) == list(cases.values())
    assert apply(spark, text.html_to_text, ["&lt;b&gt;x&amp;y<br>z", None]) == [" x&y z", None]
    titles = ["Latest dev", "ETL lead", "Studios", "Data Analyst", "Cook"]
    expected = ["QA Engineer", "Data Engineer", "Mobile Developer", "Data Analyst", "Other"]
    assert apply(spark, roles.classify_role, titles) == expected


def test_content_hash(spark):
    from marketlens.operators.dedupe import content_hash

    df = spark.createDataFrame([("Data Analyst!", "Tech  Corp", "TORONTO")], "title string, company string, city string")
    assert df.select(content_hash()).first()[0] == "9e7962668b0984af2ec9594aeb674532"
