"""Exact and content de-duplication; the first row in `order` survives."""

import re

from pyspark.sql import Column, DataFrame, functions as F

from marketlens.functions.text import WHITESPACE, normalise, strip
from marketlens.operators.rows import first_per_key


def content_hash(title: str = "title", company: str = "company", city: str = "city") -> Column:
    """MD5 of the normalised title, company and city."""
    parts = [normalise(F.col(c)) for c in (title, company, city)]
    return F.md5(F.concat_ws("::", *[F.coalesce(p, F.lit("")) for p in parts]))


def drop_repeated_ids(df: DataFrame, order: list[str]) -> DataFrame:
    return first_per_key(df, ["job_id"], order)


def drop_repeated_content(df: DataFrame, order: list[str], **columns: str) -> DataFrame:
    """Keep the first row per content hash (a name map covers other column names)."""
    hashed = df.withColumn("_content", content_hash(**columns))
    return first_per_key(hashed, ["_content"], order).drop("_content")


def deduplicate(df: DataFrame, order: list[str]) -> DataFrame:
    """Repeated ids first, then repeated content among what is left."""
    return drop_repeated_content(drop_repeated_ids(df, order), order)


def dedupe_report(df: DataFrame, order: list[str]) -> DataFrame:
    """Rows in, rows kept, rows removed."""
    kept = drop_repeated_ids(df, order).select(content_hash().alias("h"))
    return df.agg(
        F.count("*").alias("total_jobs"),
        kept.agg(F.count_distinct("h")).scalar().alias("unique_jobs"),
    ).withColumn("duplicates_removed", F.col("total_jobs") - F.col("unique_jobs"))


# Legal suffixes of companies.
LEGAL_SUFFIXES = ("inc.", "inc", "ltd.", "ltd", "corp.", "corp", "llc")


def legal_name_key(title: str = "title", company: str = "company", city: str = "city") -> Column:
    """Alternative key: SHA-256 over title, company without its legal
    suffixes, and city."""
    t, co, ci = (F.lower(F.coalesce(F.col(c), F.lit(""))) for c in (title, company, city))
    t, ci = strip(t), strip(ci)
    # White space in front stays until the suffixes are off: where no name precedes it, a suffix is one still.
    co = F.rtrim(co, F.lit(WHITESPACE))
    for noise in (" - remote", " (remote)"):
        t = F.replace(t, F.lit(noise), F.lit(""))
    t = strip(F.replace(t, F.lit("/"), F.lit(" ")))
    # From the end they come off in the order of the list, each at most once.
    ends = "".join(f"(?: {re.escape(suffix)})?" for suffix in reversed(LEGAL_SUFFIXES))
    co = F.regexp_replace(co, ends + r"\z", "")
    return F.sha2(F.concat_ws("|", t, strip(co), ci), 256)


def drop_repeated_legal_names(df: DataFrame, order: list[str]) -> DataFrame:
    keyed = df.withColumn("_key", legal_name_key())
    return first_per_key(keyed, ["_key"], order).drop("_key")
