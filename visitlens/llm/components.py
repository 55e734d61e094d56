"""Connected components by alternating stars, on stored edge tables; few edges are merged by one task."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from visitlens.llm.common import on_workers, stored
from visitlens.session import cut_lineage

#: Edges that one task merges, some 100 MB of it; more are merged by stars, which need no task to hold them.
ONE_TASK = 250_000


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _star(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Neighbours of each node point to the smallest of them (and the node).

    Large stars look at all neighbours and move the greater ones; small stars look at smaller
    neighbours and move these and the node. The minimum is aggregated map-side before it meets the edges
    again; there the edges of a node with very many neighbours are split by Spark's handling of skewed joins.
    """
    if both_ways:
        edges = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
    met = edges.join(least, F.col("a") == F.col("k"))
    moved = met.where(F.col("b") > F.col("a")) if both_ways else met.where(F.col("b") != F.col("m"))
    out = moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not both_ways:
        out = out.union(least.select(F.col("k").alias("a"), F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def _in_one_task(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` by union-find; for edge tables of a checked size."""
    kind = edges.schema["a"].dataType
    schema = T.StructType([T.StructField("node", kind), T.StructField("root", kind)])

    def merge(batches):
        parent: dict = {}

        def find(x):
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = x = parent.setdefault(up, up)
            return x

        for batch in batches:
            for one, two in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                low, high = sorted((find(one), find(two)))
                parent[high] = low
        nodes = [x for x in parent if find(x) != x]  # an edge from a node to itself adds none
        columns = [pa.array(c, to_arrow_type(kind)) for c in (nodes, [find(x) for x in nodes])]
        yield pa.RecordBatch.from_arrays(columns, names=["node", "root"])

    return on_workers(edges.select("a", "b").coalesce(1)).mapInArrow(merge, schema)


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (its component's smallest node) of all nodes of edges (a, b) but the roots; stored."""
    return counted_components(edges)[0]


def counted_components(edges: DataFrame, one_task: int = ONE_TASK, rows: int | None = None) -> tuple[DataFrame, int]:
    """The same, and the number of these nodes; ``one_task`` steers the way, not the result.

    ``rows`` is the number of edges, of stored ones, where it is known.
    """
    if rows is None:
        edges, rows = stored(edges)
    if rows <= one_task:
        return stored(_in_one_task(edges))
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    stars = cut_lineage(down.where(F.col("a") != F.col("b")).distinct())
    seen = _fingerprint(stars)
    while seen[0]:
        stars = cut_lineage(_star(_star(stars, both_ways=True), both_ways=False))
        now = _fingerprint(stars)
        if now == seen:
            break
        seen = now
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")), seen[0]
