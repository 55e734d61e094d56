"""Ordered scans over a total order, with no task that sees more than one slice of it.

The rows are written once in ranges of the whole sort key (group columns, order columns,
unique row id; see ``slices``), so one group may span many slices and one slice may hold
many groups. Window functions run inside a slice; what crosses a slice border (rows so far, the
neighbours k rows away) comes from tables with a few rows per slice, which are broadcast while their bound of rows is small.
There are as many slices as shuffle partitions, whatever the size of the input.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from visitlens.operators.slices import SLICE, border_table, nulls_last, slice_count, store_sliced


@dataclass(frozen=True)
class Counter:
    """Zero-based position of the row in its group."""

    name: str


@dataclass(frozen=True)
class Shift:
    """Value of the row ``k`` places earlier in the group (later when ``k`` is negative)."""

    name: str
    value: str
    k: int = 1


def order_key(columns: Sequence[str]) -> Column:
    """One comparable struct for the sort columns; nulls come last in each of them."""
    fields = []
    for i, column in enumerate(columns):
        fields += [F.col(column).isNull().alias(f"n{i}"), F.col(column).alias(f"k{i}")]
    return F.struct(*fields)


class OrderedScan:
    """Running positions and shifted values along ``order`` within ``group``.

    ``order`` has to end with a unique column. ``stored`` holds the rows with their slice.
    """

    def __init__(self, df: DataFrame, order: Sequence[str], group: Sequence[str] = (), slices: int | None = None):
        self.columns = df.columns
        self.order = list(order)
        self.group = list(group)
        self.slices = slice_count(df, slices)
        self.stored = store_sliced(df, [*group, *order], self.slices)

    def slice_sizes(self) -> DataFrame:
        """One row per slice: rows in it and rows before it."""
        sizes = self.stored.groupBy(SLICE).agg(F.count(F.lit(1)).alias("_rows"))
        before = F.sum("_rows").over(Window.orderBy(SLICE)) - F.col("_rows")
        return sizes.withColumn("_before", before)

    def apply(self, features: Sequence[Counter | Shift]) -> DataFrame:
        shifts = [f for f in features if isinstance(f, Shift)]
        counters = [f for f in features if isinstance(f, Counter)]
        in_slice = Window.partitionBy(SLICE).orderBy(*nulls_last([*self.group, *self.order]))
        in_group = Window.partitionBy(SLICE, *self.group).orderBy(*nulls_last(self.order))

        local = {"_place": F.row_number().over(in_slice) - 1}
        if counters:
            local["_count"] = F.row_number().over(in_group) - 1
        for k in {s.k for s in shifts}:
            local[f"_inside{k}"] = F.lag(F.lit(True), k).over(in_group).isNotNull()
        for s in shifts:
            local[f"_local_{s.name}"] = F.lag(F.col(s.value), s.k).over(in_group)
        out = self.stored.withColumns(local)

        if shifts:
            sizes = self.slice_sizes()
            out = out.join(border_table(sizes.select(SLICE, "_before"), self.slices), SLICE, "left")
            out = out.withColumn("_place", F.col("_before") + F.col("_place"))
            for k in sorted({s.k for s in shifts}):
                out = self._fetch_across(out, sizes, k, [s for s in shifts if s.k == k])
        if counters:
            same = F.col(SLICE) == F.col("_s")
            for g in self.group:
                same = same & F.col(g).eqNullSafe(F.col(f"_c_{g}"))
            out = out.join(border_table(self._rows_before_slice(), 2 * self.slices), same, "left")
            total = F.col("_count") + F.coalesce(F.col("_carried"), F.lit(0))
            out = out.withColumns({c.name: total.cast("bigint") for c in counters})
        return out.select(*self.columns, *[f.name for f in features])

    def _fetch_across(self, out: DataFrame, sizes: DataFrame, k: int, shifts: list[Shift]) -> DataFrame:
        """Fill the shifts whose source row lies in another slice."""
        donors = self._border_rows(sizes, k, sorted({s.value for s in shifts}))
        wanted = F.when(~F.col(f"_inside{k}"), F.col("_place") - k)
        out = out.withColumn("_wanted", wanted).join(border_table(donors, abs(k) * self.slices), "_wanted", "left")
        same = F.col("_has_donor")
        for g in self.group:
            same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
        filled = {
            s.name: F.when(F.col(f"_inside{k}"), F.col(f"_local_{s.name}")).when(same, F.col(f"_v_{s.value}"))
            for s in shifts
        }
        return out.withColumns(filled).drop(*donors.columns)

    def _border_rows(self, sizes: DataFrame, k: int, values: list[str]) -> DataFrame:
        """The |k| rows next to each border, with their places: at most |k| per slice."""
        full = [*self.group, *self.order]
        if k > 0:
            ranking = [F.col(c).desc_nulls_first() for c in full]
            place = F.col("_before") + F.col("_rows") - F.col("_rank")
        else:
            ranking = nulls_last(full)
            place = F.col("_before") + F.col("_rank") - 1
        narrow = self.stored.select(SLICE, *dict.fromkeys([*full, *values]))
        ranked = narrow.withColumn("_rank", F.row_number().over(Window.partitionBy(SLICE).orderBy(*ranking)))
        border = ranked.where(F.col("_rank") <= abs(k)).join(border_table(sizes, self.slices), SLICE)
        return border.select(
            place.alias("_wanted"),
            F.lit(True).alias("_has_donor"),
            *[F.col(g).alias(f"_g_{g}") for g in self.group],
            *[F.col(v).alias(f"_v_{v}") for v in values],
        )

    def _rows_before_slice(self) -> DataFrame:
        """For the groups at slice borders, their rows in earlier slices: at most two per slice."""
        keyed = self.stored
        if not self.group:
            return self.slice_sizes().select(F.col(SLICE).alias("_s"), F.col("_before").alias("_carried"))
        key = order_key(self.group)
        ends = keyed.groupBy(SLICE).agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
        edges = ends.select(F.col(SLICE).alias("_s"), F.explode(F.array_distinct(F.array("lo", "hi"))).alias("_edge"))
        at_edge = keyed.join(
            border_table(edges, 2 * self.slices), (F.col(SLICE) == F.col("_s")) & (key == F.col("_edge")), "left_semi"
        )
        held = at_edge.groupBy(SLICE, *self.group).agg(F.count(F.lit(1)).alias("_rows"))
        earlier = Window.partitionBy(*self.group).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
        return held.select(
            F.col(SLICE).alias("_s"),
            *[F.col(g).alias(f"_c_{g}") for g in self.group],
            F.sum("_rows").over(earlier).alias("_carried"),
        )


def over(feature: Counter | Shift, window: WindowSpec) -> Column:
    if isinstance(feature, Counter):
        return (F.row_number().over(window) - 1).cast("bigint")
    return F.lag(F.col(feature.value), feature.k).over(window)


def add_features(
    df: DataFrame, features: Sequence[Counter | Shift], group: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The same features with plain windows, for groups that fit into a task."""
    window = Window.partitionBy(*group).orderBy(*nulls_last(order))
    return df.withColumns({f.name: over(f, window) for f in features})


def row_number(
    df: DataFrame, order: Sequence[str], name: str = "row_number", slices: int | None = None
) -> DataFrame:
    """Zero-based position of every row in the whole table."""
    return OrderedScan(df, order, slices=slices).apply([Counter(name)])


def shift(
    df: DataFrame, value: str, k: int, order: Sequence[str], name: str, slices: int | None = None
) -> DataFrame:
    """Value of the row ``k`` places earlier in the whole table (later when negative)."""
    return OrderedScan(df, order, slices=slices).apply([Shift(name, value, k)])
