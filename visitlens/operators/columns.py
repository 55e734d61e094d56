"""Schema operators: prefixes, column roles, union with typed nulls, table shapes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def prefix_columns(df: DataFrame, prefix: str, keys: Sequence[str]) -> DataFrame:
    """Prefix every column but the keys."""
    return df.select(*[F.col(f"`{c}`").alias(c if c in keys else prefix + c) for c in df.columns])


@dataclass(frozen=True)
class ColumnRoles:
    categorical: list[str]
    dates: list[str]
    general: list[str]


def column_roles(df: DataFrame, skip: Sequence[str] = ()) -> ColumnRoles:
    """Sort columns by type: strings are categorical, time stamps are dates, the rest is general."""
    kept = [f for f in df.schema.fields if f.name not in skip]
    categorical = [f.name for f in kept if isinstance(f.dataType, T.StringType)]
    dates = [f.name for f in kept if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType, T.DateType))]
    general = [f.name for f in kept if f.name not in {*categorical, *dates}]
    return ColumnRoles(categorical, dates, general)


def move_string_features(df: DataFrame, roles: ColumnRoles, extra: Sequence[str]) -> tuple[ColumnRoles, list[str]]:
    """Move string-typed derived features to the categorical role."""
    strings = column_roles(df.select(*extra)).categorical
    moved = ColumnRoles([*roles.categorical, *strings], roles.dates, roles.general)
    return moved, [c for c in extra if c not in strings]


def union_train_test(train: DataFrame, test: DataFrame, flag: str = "is_train") -> DataFrame:
    """Stack both by column name; columns one side lacks are null there."""
    return train.withColumn(flag, F.lit(True)).unionByName(
        test.withColumn(flag, F.lit(False)), allowMissingColumns=True
    )


def split_train_test(df: DataFrame, flag: str = "is_train") -> tuple[DataFrame, DataFrame]:
    return df.where(F.col(flag)).drop(flag), df.where(~F.col(flag)).drop(flag)


def table_shapes(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table."""
    shapes = [
        df.agg(F.count(F.lit(1)).cast("bigint").alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_columns")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, shapes)
