"""Distinct counts per key, value frequencies, and masking of values that occur once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.operators.skew import HeavyKeys, left_join
from visitlens.session import cut_lineage


def distinct_per_key(df: DataFrame, key: str, counted: str, name: str) -> DataFrame:
    """Exact distinct count of ``counted`` per non-null ``key``.

    Spark aggregates by (key, counted) first, so a hot key is already reduced when its
    rows come together.
    """
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count_distinct(F.col(counted)).cast("bigint").alias(name))
    )


def add_distinct_count(
    df: DataFrame,
    key: str,
    counted: str,
    name: str,
    heavy: HeavyKeys | None = None,
    spread: str | None = None,
    source: DataFrame | None = None,
) -> DataFrame:
    """Map the distinct count of each key back to its rows; a null key gets null.

    The counts are stored, so that Spark knows their size and does not shuffle the rows for a small table.
    """
    counts = cut_lineage(distinct_per_key(df if source is None else source, key, counted, name))
    return left_join(df, counts, [key], heavy, spread)


def value_counts(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """How often each non-null value occurs."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).cast("bigint").alias(name))


def mask_rare_values(df: DataFrame, columns: Sequence[str], row_id: str = "row_id") -> DataFrame:
    """Replace values that occur exactly once in their column by null.

    A value that occurs once names a single row, so the join back runs on the unique
    row id and not on the values: a frequent value is reduced by the map-side
    aggregation and never travels. The flags are stored: where they are few, the rows stay in place.
    """
    cells = df.select(
        row_id,
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(i).alias("_column"), F.col(c).cast("string").alias("_value"))
                    for i, c in enumerate(columns)
                ]
            )
        ),
    )
    single = (
        cells.where(F.col("_value").isNotNull())
        .groupBy("_column", "_value")
        .agg(F.count(F.lit(1)).alias("_n"), F.min(row_id).alias(row_id))
        .where(F.col("_n") == 1)
        .groupBy(row_id)
        .agg(*[F.max(F.col("_column") == i).alias(f"_rare{i}") for i in range(len(columns))])
    )
    joined = df.join(cut_lineage(single), row_id, "left")
    masked = {c: F.when(F.col(f"_rare{i}"), None).otherwise(F.col(c)) for i, c in enumerate(columns)}
    return joined.withColumns(masked).select(*df.columns)
