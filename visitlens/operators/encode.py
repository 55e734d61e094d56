"""Category codes and one-hot levels as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.functions.values import fill_levels
from visitlens.operators.ordered import row_number
from visitlens.operators.skew import HeavyKeys, left_join
from visitlens.session import cut_lineage


def category_codes(df: DataFrame, column: str) -> DataFrame:
    """Each level of ``column`` with its rank in sorted order; null is a level of its own."""
    levels = cut_lineage(df.select(fill_levels(column).alias(column)).distinct())
    return row_number(levels, [column], f"{column}_code")


def label_encode(
    df: DataFrame, column: str, heavy: HeavyKeys | None = None, spread: str | None = None
) -> DataFrame:
    """Append ``<column>_code``; the column itself gets the named null level."""
    named = df.withColumn(column, fill_levels(column))
    return left_join(named, category_codes(df, column), [column], heavy, spread)


def one_hot_long(df: DataFrame, column: str, row_id: str, heavy: HeavyKeys | None = None) -> DataFrame:
    """Long form of the one-hot block: the (row, level) pairs whose value is 1."""
    return label_encode(df, column, heavy, row_id).select(
        row_id,
        F.lit(column).alias("feature"),
        F.col(column).alias("level"),
        F.col(f"{column}_code").alias("position"),
        F.lit(1.0).alias("value"),
    )
