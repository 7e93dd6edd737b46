"""Near-duplicate titles within one company and city.

Two postings are near duplicates when company and city agree after normalising and the
matching-block ratio of their titles reaches the threshold. Postings whose normalised title,
company and city agree form one *content*; they are near duplicates of each other with ratio 1.
`contents` holds one row per content, `posting_contents` the members, and `near_contents` the
matching pairs of different contents. Together they say everything the list of all posting
pairs would, without writing the pairs of a large group out one by one.

Candidates come from an exact filter. The matching blocks are a common subsequence, so a ratio
of at least t bounds the characters to delete and insert between the titles, hence the number
of two-letter pieces of one title that the other one lacks. A title of length l lacks at most
K = floor(c * l) of them, so under any common order of pieces two matching titles that share
at least n pieces share n of their K + n first ones. The order used puts rare letters first.

Titles meet under keys made of n such pieces. A company and city with many contents takes a
larger n: more keys per title, but far fewer strangers under each, so that a group holding much
of the table does not compare all its titles. Titles that may share fewer than n pieces, and
long ones, whose combinations would be too many, also meet under single pieces.
"""

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from marketlens.functions.text import computed_once, normalise

# Letters and digits from frequent to rare, and the codes that sort them rare first.
_FREQUENT_FIRST = " etaoinsrhldcumfpgwybvkxjqz0123456789"
_RARE_FIRST = "".join(chr(ord("~") - i) for i in range(len(_FREQUENT_FIRST)))
_SHORT = ""

# Contents per company and city above which keys take two, then three pieces, and the title
# length above which single pieces are used.
GROUP_LIMITS = (1_000, 100_000)
LONG = 60


def _lacking_factor(threshold: float) -> float:
    """c in K = floor(c * l): worst number of pieces lacking, over all partner lengths."""
    slope = 1 - 1.5 * threshold
    partner = threshold / (2 - threshold) if slope < 0 else (2 - threshold) / threshold
    return (2 - 1.5 * threshold) + slope * partner


def _pieces(title: Column) -> Column:
    """All distinct two-letter pieces of a title, rare letters first."""
    coded = F.translate(title, _FREQUENT_FIRST, _RARE_FIRST)
    starts = F.sequence(F.lit(1), F.length(title) - 1)
    cut = F.transform(starts, lambda i: F.substr(coded, i, F.lit(2)))
    return F.when(F.length(title) >= 2, F.array_sort(F.array_distinct(cut))).otherwise(
        F.array().cast("array<string>")
    )


def _combinations(pieces: Column, n: int) -> Column:
    """All n pieces in order, each choice as one text."""
    if n == 1:
        return pieces
    return F.flatten(
        F.transform(
            pieces,
            lambda a, i: F.transform(
                _combinations(F.slice(pieces, i + 2, F.size(pieces)), n - 1), lambda b: F.concat(a, b)
            ),
        )
    )


def _with_keys(found: DataFrame, threshold: float, group_limits: tuple[int, ...]) -> DataFrame:
    """Add the pieces, the first ones, and the keys under which a title meets others."""
    sizes = found.groupBy("norm_company", "norm_city").agg(F.count("*").alias("contents"))
    level = F.lit(1)
    for limit in group_limits:
        level = level + (F.col("contents") > limit).cast("int")
    c = F.col
    none = F.array().cast("array<string>")
    lacking = F.floor(c("length") * F.lit(_lacking_factor(threshold)) + F.lit(1e-9)).cast("int")
    # A title may match one longer by this factor, so shorter ones never meet a long one.
    near_long = c("length") > LONG * threshold / (2 - threshold)
    combined = F.when(c("level") == 1, none)
    for n in range(2, len(group_limits) + 2):
        combined = combined.when(c("level") == n, _combinations(c("first"), n))
    alone = (c("level") == 1) | near_long | (F.size("pieces") < c("lacking") + c("level"))
    keys = F.concat(
        F.when(c("length") > LONG, none).otherwise(combined),
        F.when(alone, F.slice("pieces", F.lit(1), c("lacking") + 1)).otherwise(none),
        F.when(F.size("pieces") <= c("lacking"), F.array(F.lit(_SHORT))).otherwise(none),
    )
    return (
        found.join(sizes, ["norm_company", "norm_city"])
        .withColumn("level", level)
        .withColumn("length", F.length("norm_title"))
        .withColumn("lacking", lacking)
        .withColumn("pieces", _pieces(c("norm_title")))
        .withColumn("first", F.slice("pieces", F.lit(1), c("lacking") + c("level")))
        .withColumn("keys", keys)
    )


def _meeting_key() -> Column:
    """The one key, among all that a pair shares, under which it is compared."""
    long_pair = F.greatest("length_1", "length_2") > LONG
    n = F.when(long_pair, F.lit(1)).otherwise(F.col("level_1"))
    shared = F.array_intersect("first_1", "first_2")
    return computed_once(
        shared,
        lambda s: F.when(F.size(s) >= n, F.array_join(F.slice(s, F.lit(1), n), ""))
        .when(F.size(s) >= 1, F.get(s, F.lit(0)))
        .otherwise(F.lit(_SHORT)),
    )


def _lacks_few(mine: str, other: str, threshold: float) -> Column:
    """Pieces of one title missing in the other stay within the bound for this pair of lengths."""
    l1, l2 = F.col(f"length_{mine}"), F.col(f"length_{other}")
    bound = l1 * F.lit(2.0) + l2 - (l1 + l2) * F.lit(1.5 * threshold) + F.lit(1e-9)
    return F.size(F.array_except(f"pieces_{mine}", f"pieces_{other}")) <= bound


def _keyed(df: DataFrame, title: str, company: str, city: str) -> DataFrame:
    return df.select(
        "*",
        *[
            F.coalesce(normalise(F.col(c)), F.lit("")).alias(f"norm_{n}")
            for n, c in (("title", title), ("company", company), ("city", city))
        ],
    )


def contents(
    df: DataFrame, order: str = "id", title: str = "title", company: str = "company", city: str = "city"
) -> DataFrame:
    """One row per normalised (company, city, title) with its first row and row count.

    Map-side counting shrinks a group of copies before it travels.
    """
    return (
        _keyed(df, title, company, city)
        .groupBy("norm_company", "norm_city", "norm_title")
        .agg(F.min(order).alias("first_id"), F.count("*").alias("postings"))
    )


def posting_contents(
    df: DataFrame, order: str = "id", title: str = "title", company: str = "company", city: str = "city"
) -> DataFrame:
    """Row id with the normalised company, city and title that name its content."""
    return _keyed(df, title, company, city).select(
        order, "norm_company", "norm_city", "norm_title"
    )


def _ratio_udf(threshold: float):
    # The count of common letters bounds the ratio from above, so most candidates stop there.
    def one(x: str, y: str) -> float:
        matcher = SequenceMatcher(None, x, y)
        return matcher.ratio() if matcher.quick_ratio() >= threshold else 0.0

    @F.pandas_udf("score double, score_reversed double")
    def ratios(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        pairs = list(zip(a, b))
        return pd.DataFrame(
            {
                "score": pd.Series([one(x, y) for x, y in pairs], dtype="float64"),
                "score_reversed": pd.Series([one(y, x) for x, y in pairs], dtype="float64"),
            }
        )

    # Marked so that the filter on its result does not run it a second time.
    return ratios.asNondeterministic()


def near_contents(
    found: DataFrame, threshold: float = 0.85, group_limits: tuple[int, ...] = GROUP_LIMITS
) -> DataFrame:
    """Pairs of different contents of one company and city whose titles match.

    The ratio depends on the order of its arguments, so both directions are given:
    `score` with the earlier content first, `score_reversed` the other way round; a pair is
    kept when either reaches the threshold (a direction certainly below it may read 0).
    A company and city with more contents than the i-th group limit uses keys of i + 1 pieces.
    """
    side = _with_keys(found, threshold, group_limits).withColumn("key", F.explode("keys"))
    keys = ["norm_company", "norm_city", "key"]
    values = ["first_id", "postings", "norm_title", "length", "level", "pieces", "first"]
    left, right = (
        side.select(*keys, *[F.col(v).alias(f"{v}_{n}") for v in values]) for n in (1, 2)
    )
    longest = F.lit(2.0) * F.least("length_1", "length_2")
    candidates = (
        left.join(right, keys)
        .where(F.col("first_id_1") < F.col("first_id_2"))
        .where(longest >= F.lit(threshold - 1e-9) * (F.col("length_1") + F.col("length_2")))
        .where(_lacks_few("1", "2", threshold) & _lacks_few("2", "1", threshold))
        .where(_meeting_key() == F.col("key"))
        .select(
            "norm_company", "norm_city", "first_id_1", "first_id_2",
            "norm_title_1", "norm_title_2", "postings_1", "postings_2",
        )
    )
    # Scoring a pair costs far more than its bytes, so spread by pair and not by size.
    tasks = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    candidates = candidates.repartition(tasks, "first_id_1", "first_id_2")
    scored = candidates.withColumn(
        "ratios", _ratio_udf(threshold)(F.col("norm_title_1"), F.col("norm_title_2"))
    ).select(*candidates.columns, "ratios.*")
    return scored.where(F.greatest("score", "score_reversed") >= threshold)
