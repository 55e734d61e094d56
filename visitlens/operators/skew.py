"""Heavy keys: find them in one sketching pass, then split or salt the rows that carry them.

A key that holds a large share of all rows would put that share into one task of a
hash shuffle. ``find_heavy_keys`` names such keys with a frequent-items sketch (no
shuffle, a bounded answer), and the joins and windows of this package treat their
rows apart. The sketch only decides how rows travel: results are the same whether or
not a key was named.

The heavy keys are a small table (hash, parts) that rows are joined with, so neither the plan nor the cost
of a row grows with their number. It is broadcast: it has at most ``MOST_KEYS`` rows of twelve bytes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.session import cut_lineage

TRACKED_ITEMS = 65_536
MOST_KEYS = 100_000
PARTS_PER_FAIR_SHARE = 2
HASH, PARTS = "_key_hash", "_parts"


@dataclass(frozen=True)
class HeavyKeys:
    """Key tuples that need special routing, and into how many parts each is cut.

    ``table`` holds ``count`` rows (hash of the key, parts). ``nulls`` says that rows with a null in
    the key exist; they are routed with the heavy ones, so the remaining rows always have a full key.
    ``rows`` is the number of rows they were looked for in, where it is known.
    """

    keys: tuple[str, ...]
    table: DataFrame | None = None
    count: int = 0
    nulls: bool = False
    null_parts: int = 1
    rows: int | None = None

    def __bool__(self) -> bool:
        return self.nulls or self.count > 0

    def marked(self, df: DataFrame) -> DataFrame:
        """``df`` with the parts of each row's key in ``PARTS``; null where the key is not heavy."""
        if self.count:
            table = F.broadcast(self.table) if self.count <= MOST_KEYS else self.table
            df = df.withColumn(HASH, F.xxhash64(*self.keys)).join(table, HASH, "left").drop(HASH)
        else:
            df = df.withColumn(PARTS, F.lit(None).cast("int"))
        return df.withColumn(PARTS, F.when(_any_null(self.keys), F.lit(self.null_parts)).otherwise(F.col(PARTS))) if self.nulls else df

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The rows whose key is not heavy, and those whose key is."""
        marked = self.marked(df)
        return marked.where(F.col(PARTS).isNull()).drop(PARTS), marked.where(F.col(PARTS).isNotNull()).drop(PARTS)

    @property
    def hashes(self) -> tuple[int, ...]:
        return tuple(r[HASH] for r in self.table.orderBy(HASH).collect()) if self.count else ()

    @property
    def parts(self) -> tuple[int, ...]:
        return tuple(r[PARTS] for r in self.table.orderBy(HASH).collect()) if self.count else ()


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(Column.__or__, [F.col(k).isNull() for k in keys])


def _parts(rows_of_key: Column, rows: Column | int, partitions: int) -> Column:
    """As many as keep a part below half of a partition's fair share."""
    return F.greatest(F.lit(1), F.ceil(rows_of_key * F.lit(PARTS_PER_FAIR_SHARE * partitions) / rows)).cast("int")


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def find_heavy_keys(df: DataFrame, *key_sets: Sequence[str], share: float | None = None) -> list[HeavyKeys]:
    """Key tuples holding more than ``share`` of all rows, for several key sets in one pass.

    ``share`` defaults to one shuffle partition's fair part, at every size of the input. The keys
    themselves stay in a stored table; the driver sees how many there are.
    """
    partitions = _partitions(df)
    if share is None:
        share = max(1.0 / partitions, 1.0 / MOST_KEYS)
    top = min(MOST_KEYS, int(1 / share) + 1)
    sketches = [
        F.expr(f"approx_top_k(xxhash64({', '.join(f'`{k}`' for k in keys)}), {top}, {max(TRACKED_ITEMS, 2 * top)})").alias(f"top{i}")
        for i, keys in enumerate(key_sets)
    ]
    nulls = [F.count_if(_any_null(keys)).alias(f"null{i}") for i, keys in enumerate(key_sets)]
    found = df.agg(F.greatest(F.count(F.lit(1)), F.lit(1)).alias("rows"), *sketches, *nulls)
    is_heavy = lambda t: t["count"] > F.col("rows") * share
    summary = cut_lineage(found.withColumns({f"top{i}": F.filter(f"top{i}", is_heavy) for i in range(len(key_sets))}))
    sizes = summary.select("rows", *[f"null{i}" for i in range(len(key_sets))], *[F.size(f"top{i}").alias(f"n{i}") for i in range(len(key_sets))]).first()
    out = []
    for i, keys in enumerate(key_sets):
        table = summary.select("rows", F.inline(f"top{i}")).select(
            F.col("item").alias(HASH), _parts(F.col("count"), F.col("rows"), partitions).alias(PARTS)
        )
        null_parts = max(1, -(-PARTS_PER_FAIR_SHARE * partitions * sizes[f"null{i}"] // sizes["rows"]))
        out.append(HeavyKeys(tuple(keys), table, sizes[f"n{i}"] or 0, sizes[f"null{i}"] > 0, null_parts, sizes["rows"]))
    return out


def heavy_from_counts(counts: DataFrame, keys: Sequence[str], count: str, null_rows: int = 0) -> HeavyKeys:
    """Heavy keys of a table whose rows per key are known: those above a shuffle partition's fair part."""
    partitions = _partitions(counts)
    total = (counts.agg(F.sum(count)).first()[0] or 0) + null_rows
    heavy = counts.where(F.col(count) * partitions > total)
    table = cut_lineage(heavy.select(F.xxhash64(*keys).alias(HASH), _parts(F.col(count), F.lit(max(1, total)), partitions).alias(PARTS)))
    null_parts = max(1, -(-PARTS_PER_FAIR_SHARE * partitions * null_rows // max(1, total)))
    return HeavyKeys(tuple(keys), table, table.count(), null_rows > 0, null_parts)


def left_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    heavy: HeavyKeys | None = None,
    spread: str | None = None,
) -> DataFrame:
    """Left outer equi-join that spreads heavy keys of the left side over as many tasks as they fill.

    Whether the right side is broadcast stays with Spark, which knows its size. The
    salt is a hash of ``spread`` (a unique column if there is one), so a task that is
    run again sends every row to the same place.
    """
    keys = list(keys)
    if not heavy:
        return left.join(right, keys, "left")
    spread_by = [spread] if spread else left.columns
    parts = F.coalesce(F.col(PARTS), F.lit(1))
    salted = heavy.marked(left).withColumn("_salt", F.pmod(F.xxhash64(*spread_by), parts.cast("bigint")).cast("int"))
    copied = heavy.marked(right).withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1)))
    return salted.drop(PARTS).join(copied.drop(PARTS), [*keys, "_salt"], "left").drop("_salt")
