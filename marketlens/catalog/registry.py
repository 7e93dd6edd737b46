"""Named queries with the SQL that gives the same rows."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketlens.catalog.fixture import Fixture, duck_with

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

POSTINGS = ("jobs_raw",)
POSTINGS_AND_FEATURES = ("jobs_raw", "jobs_features")


def query(name: str, sql: str | None = None, tables: tuple[str, ...] = ()):
    """Register a query over a Fixture; `sql` may use the named fixture tables."""

    def add(build: Callable[[Fixture], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: build(Fixture(spark, folder))
        if sql is not None:
            body = sql.strip()
            if tables:
                start = duck_with(*tables)
                body = f"{start}, {body[5:]}" if body.startswith("WITH ") else f"{start} {body}"
            ORACLES[name] = body
        return build

    return add


def rounded(value: str, digits: int) -> str:
    """Half-up rounding of a quotient, free of binary noise."""
    return f"CAST(round(CAST({value} AS DECIMAL(38, 9)), {digits}) AS DOUBLE)"


def percent(condition: str, digits: int = 1) -> str:
    """Share of rows, in percent."""
    return rounded(f"avg(CASE WHEN {condition} THEN 100 WHEN NOT ({condition}) THEN 0 END)", digits)


def skills_text(column: str = "skills") -> str:
    return f"""'[' || array_to_string(['"' || x || '"' for x in {column}], ', ') || ']'"""
