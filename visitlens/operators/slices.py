"""A total order cut into stored key ranges, so that scans along it need no single task.

``store_sliced`` writes the rows once, range-partitioned and sorted, with the number of their
range in ``_slice``. Every later pass reads that table: windows run inside a slice, and what
crosses a border comes from a table with one row per slice (and group).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlens.session import cut_lineage

SLICE = "_slice"
#: Rows of a border table up to which it is broadcast.
MOST_BROADCAST = 100_000


def nulls_last(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def slice_count(df: DataFrame, slices: int | None = None) -> int:
    return slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def border_table(df: DataFrame, most_rows: int) -> DataFrame:
    """``df``, for broadcast if its known bound of rows is small, else left to Spark."""
    return F.broadcast(df) if most_rows <= MOST_BROADCAST else df


def store_sliced(df: DataFrame, order: Sequence[str], slices: int | None = None) -> DataFrame:
    """``df`` in ranges of ``order`` (nulls last), written once; as many slices as shuffle partitions."""
    slices = slice_count(df, slices)
    keys = nulls_last(order)
    ranged = df.repartitionByRange(slices, *keys).sortWithinPartitions(*keys)
    return cut_lineage(ranged.withColumn(SLICE, F.spark_partition_id()))


def running_sums(
    stored: DataFrame, sums: dict[str, str], order: Sequence[str], group: Sequence[str] = ()
) -> DataFrame:
    """Append, per (name, value column), the sum of all rows before this one in its group.

    ``stored`` comes from ``store_sliced`` on [group, order]. Null values count as 0.
    """
    inside = Window.partitionBy(SLICE, *group).orderBy(*nulls_last(order))
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = {f"_in_{n}": F.coalesce(F.sum(v).over(before), F.lit(0)) for n, v in sums.items()}
    totals = stored.groupBy(SLICE, *group).agg(*[F.coalesce(F.sum(v), F.lit(0)).alias(f"_of_{n}") for n, v in sums.items()])
    earlier = Window.partitionBy(*group).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        F.col(SLICE).alias("_s"),
        *[F.col(g).alias(f"_g_{g}") for g in group],
        *[F.coalesce(F.sum(f"_of_{n}").over(earlier), F.lit(0)).alias(f"_from_{n}") for n in sums],
    )
    on = F.col(SLICE) == F.col("_s")
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    out = stored.withColumns(local).join(carried, on, "left")
    return out.select(*stored.columns, *[(F.col(f"_in_{n}") + F.col(f"_from_{n}")).alias(n) for n in sums])
