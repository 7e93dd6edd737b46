"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from check_oracles import connect, differences
from marketlens.catalog import registry

FOLDER = "/root/testdata/sf0.001"
# No SQL can say these; brute-force tests cover them.
WITHOUT_SQL = {
    "d5_near_contents_of_parts", "d5_near_contents_of_postings",
    "f13_html_to_text", "s10_detail_of_pages",
}
# Nothing of the smallest tables meets what these ask for.
EMPTY = {
    "q1_experience_ladder", "q3_remote_availability", "q4_salary_percentiles", "q7_weekly_trend", "q31a_role_city_recent",
}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_only_known_queries_lack_sql():
    assert set(registry.QUERIES) - set(registry.ORACLES) == WITHOUT_SQL
    assert not set(registry.ORACLES) - set(registry.QUERIES)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_rows_agree(spark, con, name):
    problem = differences(spark, con, FOLDER, name)
    assert problem is None or problem == "no rows" and name in EMPTY


def test_entry(spark):
    rows = entry_points.entry(spark)
    assert rows.columns[0] == "city" and rows.count() > 0
