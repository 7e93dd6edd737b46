"""Composite scores."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T


def weighted_score(weights: dict[str, float]) -> Column:
    """Sum of weight * column, unknown columns counting as 0."""
    terms = [F.coalesce(F.col(c), F.lit(0.0)) * F.lit(w) for c, w in weights.items()]
    return reduce(lambda a, b: a + b, terms)


def min_max(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add columns scaled to 0..1 over all rows: {new name: old name}.

    The bounds come from a one-row scalar sub-query, so no task sees all rows. The sub-query
    bounds every numeric column: it then needs what the rows themselves need, and Spark reuses
    their shuffle instead of computing them twice. A column without spread gives NULL.
    """
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    bounds = df.agg(
        F.struct(
            *[F.min(name).cast("double").alias(f"{name}_low") for name in numeric],
            *[F.max(name).cast("double").alias(f"{name}_high") for name in numeric],
        ).alias("bounds")
    )
    out = df.withColumn("_bounds", bounds.scalar())
    scaled = {}
    for new, old in columns.items():
        low, high = F.col(f"_bounds.{old}_low"), F.col(f"_bounds.{old}_high")
        scaled[new] = (F.col(old) - low) / F.nullif(high - low, F.lit(0.0))
    return out.withColumns(scaled).drop("_bounds")


def capped(value: Column, cap: float) -> Column:
    """value / cap, at most 1; an unknown value gives 1 because LEAST skips NULLs."""
    return F.least(value / F.lit(float(cap)), F.lit(1.0))


def bucket(score: Column, limits: list[tuple[float, str]], above: str) -> Column:
    """Name of the first limit the score stays below."""
    out = F
    for limit, name in limits:
        out = out.when(score < limit, F.lit(name))
    return out.otherwise(F.lit(above))
