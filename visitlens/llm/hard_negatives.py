"""Hard negatives for contrastive training, mined with Fagin's threshold algorithm.

Vectors become integers (floor of 256 x), so scores are exact inner products. Rows are dealt into blocks of
bounded size by their place in the table; a block keeps, per dimension, its rows sorted by that component.
For an anchor the lists are read from the end that its sign favours, some rows of every list at a time
(sorted access); each row met for the first time is scored whole (random access). No unseen row can
score more than the threshold, the sum of the anchor's components times the last values read. Reading
stops once the threshold falls strictly below the k-th best score of every window, so that ties are all
seen, or below the window's lower end.

Anchors meet blocks in units of some anchors and one block, spread over the cluster; a unit returns k rows
per window, and the best of all units are ranked by Spark. First the positives are found (one window
without ends, rows of the anchor's label), then the negatives (one window per positive, rows of other
labels). The anchors are a stated query set against all rows: work grows with anchors times blocks.

Defined cases: rows with a null label, a null vector, or a null or non-finite component take no part, nor
do rows without an id, which could not be named. A shorter vector counts as ended by zeros. Components
beyond 2^20 after scaling count as 2^20, so that scores stay in 64 bits. Repeated rows each count, ties
among them give equal results; "other" rows have another id than the anchor. Other columns are ignored;
an empty table gives an empty one. An anchor without positives, or a positive whose window holds no row
(a negative score leaves none), returns nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlens.llm.common import located, on_workers
from visitlens.session import cut_lineage

#: Rows of a block and anchors of a unit: a few MB each. A small table is cut finer, one block per shuffle
#: partition, but not below the least: every block returns k rows per window, which must be merged.
BLOCK_ROWS, LEAST_ROWS = 4_096, 512
UNIT_ANCHORS = 512
#: Rows read of every list at a time; doubled from round to round.
FIRST_STEP = 8
LARGEST = 1 << 20


@dataclass(frozen=True)
class Rule:
    """Positives per anchor, negatives per positive, and the window of the negatives' scores in percent."""

    positives: int = 5
    negatives: int = 3
    least_percent: int = 50
    most_percent: int = 95


def integers(vector: Column, scale: int = 256) -> Column:
    """The components as floor(scale * x), held within the largest size."""
    return F.transform(vector, lambda x: F.least(F.greatest(F.floor(x.cast("double") * scale).cast("long"), F.lit(-LARGEST)), F.lit(LARGEST)).cast("int"))


def usable(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(id, label, vector) of the rows that take part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    kept = F.col(key).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & finite
    return rows.where(kept).select(F.col(key).alias("id"), F.col(label).cast("long").alias("label"), integers(F.col(vector)).alias("vector"))


class Lists:
    """Rows of a block with their per-dimension order, and the threshold algorithm over them."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray):
        self.ids, self.matrix = ids, matrix
        self.order = np.argsort(matrix, axis=0, kind="stable").T  # one ascending list per dimension

    def best(self, query: np.ndarray, allowed: np.ndarray, windows: np.ndarray, k: int) -> list[list[tuple[int, int]]]:
        """Per window (least, most; ends included) the k first allowed rows as (score, row), by score and id."""
        n, found = len(self.ids), [[] for _ in windows]
        signed = np.flatnonzero(query)
        if not n or not len(windows):
            return found
        seen, at, step = np.zeros(n, dtype=bool), 0, FIRST_STEP
        backwards = query[signed] > 0
        while at < n:
            stop = min(at + step, n)
            if len(signed):
                down, up = self.order[signed[backwards], n - stop : n - at], self.order[signed[~backwards], at:stop]
                met = np.concatenate([down.ravel(), up.ravel()])
            else:
                met = np.arange(at, stop)
            fresh = np.zeros(n, dtype=bool)
            fresh[met] = True
            fresh &= ~seen
            seen |= fresh
            rows = np.flatnonzero(fresh & allowed)
            scores = self.matrix[rows] @ query
            for w, (least, most) in enumerate(windows):
                inside = (scores >= least) & (scores <= most)
                found[w] = self._first(found[w], scores[inside], rows[inside], k)
            threshold = 0
            if len(signed):
                last = np.where(backwards, self.order[signed, n - stop], self.order[signed, stop - 1])
                threshold = int((self.matrix[last, signed] * query[signed]).sum())
            if all(threshold < (found[w][-1][0] if len(found[w]) == k else windows[w, 0]) for w in range(len(windows))):
                break
            at, step = stop, 2 * step
        return found

    def _first(self, known: list[tuple[int, int]], scores: np.ndarray, rows: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The k first of those known and those met now."""
        if len(scores) > k:
            high = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
            scores, rows = scores[high], rows[high]
        if not len(scores):
            return known
        both = known + list(zip(scores.tolist(), rows.tolist()))
        return sorted(both, key=lambda c: (-c[0], self.ids[c[1]]))[:k]


def _padded(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """The vectors as a matrix of that width; missing components are zero."""
    flat = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    lengths = flat.value_lengths().to_numpy(zero_copy_only=False)
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lengths), width), dtype=np.int64)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def _width(*tables: pa.Table) -> int:
    return max([0, *(int(t["vector"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False).max()) for t in tables if len(t))])


def _match(left: pa.Table, right: pa.Table, k: int, same_label: bool, schema: pa.Schema) -> pa.Table:
    """The k best rows of a block (left) in every window of the unit's anchors (right)."""
    if not len(left) or not len(right):
        return schema.empty_table()
    width = _width(left, right)
    matrix, queries = _padded(left["vector"], width), _padded(right["vector"], width)
    ids, labels = left["id"].to_numpy(), left["label"].to_numpy()
    anchor_ids, anchor_labels = right["anchor_id"].to_numpy(), right["anchor_label"].to_numpy()
    if same_label:
        parts = {label: np.flatnonzero(labels == label) for label in np.unique(anchor_labels)}
        lists = {label: Lists(ids[rows], matrix[rows]) for label, rows in parts.items()}
    else:
        whole = Lists(ids, matrix)
    found: list[tuple] = []
    for i, (anchor, windows) in enumerate(zip(right["anchor"].to_pylist(), right["windows"].to_pylist())):
        side = lists[anchor_labels[i]] if same_label else whole
        allowed = side.ids != anchor_ids[i] if same_label else labels != anchor_labels[i]
        bounds = np.array([(w["least"], w["most"]) for w in windows], dtype=np.int64).reshape(-1, 2)
        for w, best in zip(windows, side.best(queries[i], allowed, bounds, k)):
            found += [(anchor, w["number"], int(side.ids[row]), score) for score, row in best]
    columns = zip(*found) if found else [()] * len(schema)
    return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def first_in_windows(blocks: DataFrame, anchors: DataFrame, k: int, same_label: bool) -> DataFrame:
    """Per anchor and window its k first rows over all blocks: (anchor, number, id, score, rank).

    ``anchors`` has anchor, anchor_id, anchor_label, unit, vector and an array ``windows`` of (number, least, most).
    """
    n_blocks, n_units = (d.agg(F.max(c)).first()[0] for d, c in ((blocks, "block"), (anchors, "unit")))
    out = "anchor long, number int, id long, score long"
    if n_blocks is None or n_units is None:
        return blocks.sparkSession.createDataFrame([], f"{out}, rank int")
    schema = pa.schema([("anchor", pa.int64()), ("number", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])
    spread = lambda df, name, most: df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(most))))
    left = spread(blocks.select("block", "id", "label", "vector"), "unit", n_units).groupBy("block", "unit")
    right = spread(anchors, "block", n_blocks).groupBy("block", "unit")

    def rows(block: pa.Table, unit: pa.Table) -> pa.Table:
        return _match(block, unit, k, same_label, schema)

    on_workers(blocks)
    each = left.cogroup(right).applyInArrow(rows, out)
    order = Window.partitionBy("anchor", "number").orderBy(F.desc("score"), "id")
    return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, anchor: Column, rule: Rule = Rule()) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` has id, label and an integer vector, as ``usable`` gives them; ``anchor`` is a predicate on them.
    """
    placed = located(rows, "id", "label", "vector")
    n_rows, partitions = placed.count(), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_blocks = max(1, -(-n_rows // BLOCK_ROWS), min(partitions, -(-n_rows // LEAST_ROWS)))
    block = F.pmod(F.xxhash64("_file", "_row"), F.lit(n_blocks)).cast("int").alias("block")
    blocks = cut_lineage(placed.select("id", "label", "vector", block))
    chosen = blocks.where(anchor)
    number = F.monotonically_increasing_id()
    unit = F.pmod(F.xxhash64(number), F.lit(max(1, -(-chosen.count() // UNIT_ANCHORS)))).cast("int")
    anchors = cut_lineage(
        chosen.select(number.alias("anchor"), F.col("id").alias("anchor_id"), F.col("label").alias("anchor_label"), "vector", unit.alias("unit"))
    )

    everything = F.array(F.struct(F.lit(0).alias("number"), F.lit(-(1 << 62)).alias("least"), F.lit(1 << 62).alias("most")))
    found = first_in_windows(blocks, anchors.withColumn("windows", everything), rule.positives, True)
    positives = cut_lineage(
        found.select("anchor", F.col("rank").alias("number"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    )
    # least_percent * score <= 100 * x <= most_percent * score, in whole numbers
    least = F.expr(f"-((-positive_score * {rule.least_percent} - pmod(-positive_score * {rule.least_percent}, 100)) div 100)")
    most = F.expr(f"(positive_score * {rule.most_percent} - pmod(positive_score * {rule.most_percent}, 100)) div 100")
    window = F.struct("number", least.alias("least"), most.alias("most"))
    windows = positives.where(least <= most).groupBy("anchor").agg(F.array_sort(F.collect_list(window)).alias("windows"))
    negatives = first_in_windows(blocks, anchors.join(windows, "anchor"), rule.negatives, False)
    return (
        negatives.join(positives, ["anchor", "number"])
        .join(anchors.select("anchor", "anchor_id"), "anchor")
        .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )


def digest(embeddings: DataFrame) -> DataFrame:
    """Anchors are rows with an id divisible by 50; an id divisible by 7 moves the label on by one of ten first."""
    rows = usable(embeddings)
    moved = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", moved), F.col("id") % 50 == 0)


SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_inner_product(a.vec, b.vec) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score
  FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
),
n AS (
  SELECT p.anchor_id, positive_id, s.id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, s.id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 3
"""
