"""Hard negatives against brute force, ties, ragged vectors and rows that take no part."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from visitlens.llm import hard_negatives as hn


def _brute(rows, rule=hn.Rule()):
    kept = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in vector], (label + 1) % 10 if vec_id % 7 == 0 else label))
    out = []
    for a, va, la in kept:
        if a % 50:
            continue
        scored = [(sum(x * y for x, y in zip(va, v)), i, label) for i, v, label in kept if i != a]
        scored.sort(key=lambda s: (-s[0], s[1]))
        for score, positive, _ in [s for s in scored if s[2] == la][: rule.positives]:
            window = [s for s in scored if s[2] != la and rule.least_percent * score <= 100 * s[0] <= rule.most_percent * score]
            out += [(a, positive, k + 1, s[1], score, s[0]) for k, s in enumerate(window[: rule.negatives])]
    return sorted(out)


def _made(n, dims, labels, seed, values=None):
    rng = random.Random(seed)
    pick = (lambda: rng.choice(values)) if values else (lambda: rng.gauss(0.02, 0.12))
    return [(i, [pick() for _ in range(dims)], rng.randrange(labels)) for i in range(n)]


SCHEMA = "vec_id long, embedding array<float>, label int, id string, vector string"


def _mined(spark, rows):
    return sorted(tuple(r) for r in hn.digest(spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)).collect())


@pytest.mark.parametrize("values", [None, [-0.25, 0.0, 0.25, 0.5]])
def test_equals_brute_force(spark, monkeypatch, values):
    monkeypatch.setattr(hn, "UNIT_ANCHORS", 3)
    rows = _made(700, 6, 4, 1, values)
    want = _brute(rows)
    assert len(want) > 60 and _mined(spark, rows) == want


def test_rows_that_take_no_part_and_ragged_vectors(spark):
    rows = _made(260, 5, 3, 2)
    rows += [(None, [0.5] * 5, 1), (300, None, 1), (301, [0.5, None], 1), (302, [math.nan] * 5, 1), (303, [math.inf], 2), (304, [0.5] * 5, None)]
    rows += [(350, [0.3, 0.2], 1), (351, [], 1), (352, [0.4] * 9, 2), (400, [0.0] * 5, 0), (401, [0.4, 0.1], 1), (401, [0.4, 0.1], 1)]
    assert _mined(spark, rows) == _brute(rows)


def test_empty_and_lonely(spark):
    assert _mined(spark, []) == []
    assert _mined(spark, [(50, [0.5], 1), (51, [0.5], 2)]) == []


def test_huge_components_do_not_fail(spark):
    assert _mined(spark, [(50, [3e38, -3e38], 1), (51, [3e38, 0.0], 1), (52, [2.0, 0.0], 2)]) == []


def test_threshold_stops_early():
    rng = np.random.default_rng(3)
    matrix = rng.integers(-20, 20, (4_000, 3))
    matrix[:5] = 300
    lists = hn.Lists(np.arange(4_000), matrix)
    read = []
    lists.matrix = matrix.view(_Counted)
    _Counted.read = read
    best = lists.best(np.array([5, 4, 3]), np.ones(4_000, bool), np.array([(-(1 << 62), 1 << 62)]), 5)
    assert [row for _, row in best[0]] == [0, 1, 2, 3, 4]
    assert sum(read) < 200


class _Counted(np.ndarray):
    read: list = []

    def __matmul__(self, other):
        self.read.append(len(self))
        return np.asarray(self) @ other


def test_rules_are_parameters(spark):
    rows = _made(300, 4, 2, 8)
    rule = hn.Rule(positives=2, negatives=1, least_percent=10, most_percent=90)
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    moved = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = hn.mine(hn.usable(table).withColumn("label", moved), F.col("id") % 50 == 0, rule)
    assert sorted(tuple(r) for r in got.collect()) == _brute(rows, rule)
