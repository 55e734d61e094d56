"""Unique row ids through a join that repeats rows.

A left join repeats a row for every duplicate of its key on the right. If the duplicates of a key are
numbered on the (small) right side before the join, the row id and those numbers name every joined row, and
one id can be computed from them in place: no row of the fact table is numbered again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.operators.ordered import Counter, OrderedScan
from visitlens.session import cut_lineage


@dataclass(frozen=True)
class Numbered:
    """A table whose rows of equal key carry 0, 1, ... in ``ordinal``; ``most`` rows share a key at most."""

    df: DataFrame
    ordinal: str
    most: int


def most_per_key(tables: Sequence[DataFrame], keys: Sequence[str]) -> list[int]:
    """The largest number of rows of one full key, per table, in one job; 1 for an empty table."""
    has_key = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    tops = [
        t.where(has_key).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).select(F.lit(i).alias("i"), "n")
        for i, t in enumerate(tables)
    ]
    found = {r["i"]: r["n"] for r in reduce(DataFrame.unionByName, tops).collect()} if tops else {}
    return [found.get(i) or 1 for i in range(len(tables))]


def number_duplicates(df: DataFrame, keys: Sequence[str], ordinal: str, most: int | None = None) -> Numbered:
    """Number the rows of equal key in the order of their other columns.

    Without duplicates nothing is sorted. With them the rows are scanned in stored ranges, so a key that
    holds a large part of the table is numbered by several tasks; equal rows differ only in their number.
    """
    most = most_per_key([df], keys)[0] if most is None else most
    if most == 1:
        return Numbered(df.withColumn(ordinal, F.lit(0).cast("bigint")), ordinal, 1)
    stored = cut_lineage(df.withColumn("_seen", F.monotonically_increasing_id()))
    values = [c for c in df.columns if c not in keys]
    numbered = OrderedScan(stored, [*values, "_seen"], keys).apply([Counter(ordinal)])
    return Numbered(numbered.drop("_seen"), ordinal, most)


def spread_ids(df: DataFrame, row_id: str, numbered: Sequence[Numbered]) -> DataFrame:
    """``df`` with the id of every joined copy in place of the row's: ids keep their order, copies follow each other.

    All ids are multiplied by the same number, the product of the tables' most duplicates, so
    other tables of the same rows stay comparable through ``wide_ids``.
    """
    copy = F.lit(0).cast("bigint")
    for n in numbered:
        copy = copy * n.most + F.coalesce(F.col(n.ordinal), F.lit(0))
    return wide_ids(df, row_id, numbered, copy).drop(*[n.ordinal for n in numbered])


def wide_ids(df: DataFrame, row_id: str, numbered: Sequence[Numbered], copy: Column | None = None) -> DataFrame:
    """``df`` with ids on the scale of ``spread_ids``; unchanged where no key has duplicates."""
    scale = reduce(int.__mul__, [n.most for n in numbered], 1)
    wide = F.col(row_id) * F.lit(scale).cast("bigint") if scale > 1 else F.col(row_id)
    return df.withColumn(row_id, wide + copy if copy is not None and scale > 1 else wide)
