"""Ordered scans: equal to brute force for any cut into slices."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from visitlens.operators.ordered import Counter, OrderedScan, Shift, row_number, shift
from visitlens.operators.slices import SLICE, store_sliced

SCHEMA = "g string, t timestamp_ntz, id bigint, v double"


def make_rows(n, hot_share, seed):
    rng = random.Random(seed)
    start = dt.datetime(2001, 1, 1)
    rows = []
    for i in range(n):
        group = "hot" if rng.random() < hot_share else rng.choice(["a", "b", None, "zz", "k%d" % rng.randrange(40)])
        time = None if rng.random() < 0.05 else start + dt.timedelta(hours=rng.randrange(60), microseconds=rng.randrange(3))
        rows.append((group, time, i, None if rng.random() < 0.1 else rng.random()))
    return rows


def key(value):
    return (value is None, value)


def brute(rows, ks):
    groups = {}
    for row in sorted(rows, key=lambda r: (key(r[1]), r[2])):
        groups.setdefault(row[0], []).append(row)
    want = {}
    for members in groups.values():
        for i, row in enumerate(members):
            values = [members[i - k][3] if 0 <= i - k < len(members) else None for k in ks]
            want[row[2]] = (i, *values)
    return want


@pytest.mark.parametrize("hot_share, slices", [(0.0, 23), (0.4, 1), (0.4, 5), (0.4, 400), (1.0, 23)])
def test_scan_equals_brute_force(spark, hot_share, slices):
    ks = [1, 2, -1, -11]
    rows = make_rows(400, hot_share, seed=slices)
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    scan = OrderedScan(df, ["t", "id"], ["g"], slices)
    out = scan.apply([Counter("n"), *[Shift(f"s{i}", "v", k) for i, k in enumerate(ks)]])
    found = out.collect()
    assert len(found) == len(rows)
    got = {r["id"]: (r["n"], *[r[f"s{i}"] for i in range(len(ks))]) for r in found}
    assert got == brute(rows, ks)


@pytest.mark.parametrize("slices", [1, 9, 60])
def test_whole_table_scan(spark, slices):
    rows = make_rows(300, 0.4, seed=1)
    df = spark.createDataFrame(rows, SCHEMA)
    ordered = sorted(rows, key=lambda r: (key(r[1]), r[2]))
    want = {r[2]: i for i, r in enumerate(ordered)}
    got = row_number(df, ["t", "id"], "n", slices)
    assert {r["id"]: r["n"] for r in got.collect()} == want
    lagged = shift(df, "v", 3, ["t", "id"], "earlier", slices)
    expected = {r[2]: ordered[i - 3][3] if i >= 3 else None for i, r in enumerate(ordered)}
    assert {r["id"]: r["earlier"] for r in lagged.collect()} == expected


def test_string_and_double_keys(spark):
    rows = [(f"w{i % 13}", float(i * 37 % 101) / 7, i) for i in range(200)]
    df = spark.createDataFrame(rows, "s string, x double, id bigint")
    got = {r["id"]: r["n"] for r in row_number(df, ["s", "x", "id"], "n", 17).collect()}
    assert got == {r[2]: i for i, r in enumerate(sorted(rows))}


def test_heavy_leading_key_is_cut(spark):
    df = spark.range(20000).select(F.lit(1).alias("k"), "id")
    sizes = [r["count"] for r in store_sliced(df, ["k", "id"], 20).groupBy(SLICE).count().collect()]
    assert len(sizes) > 10
    assert max(sizes) < 20000 / 4


def test_result_does_not_depend_on_partitioning(spark):
    df = spark.createDataFrame(make_rows(300, 0.3, seed=5), SCHEMA)
    results = []
    for parts in (1, 3, 16):
        out = OrderedScan(df.repartition(parts), ["t", "id"], ["g"], 11).apply([Counter("n"), Shift("p", "v", 1)])
        results.append(sorted(map(repr, out.select("id", "n", "p").collect())))
    assert results[0] == results[1] == results[2]


def test_empty_and_single_row(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert OrderedScan(empty, ["t", "id"], ["g"], 8).apply([Counter("n")]).count() == 0
    one = spark.createDataFrame(make_rows(1, 0, 1), SCHEMA)
    assert [r["n"] for r in OrderedScan(one, ["t", "id"], ["g"], 8).apply([Counter("n")]).collect()] == [0]


def test_no_single_task_over_the_rows(spark):
    """With slices, a whole-table scan gathers only slice-sized tables in one task."""
    df = spark.range(5000).select("id", (F.col("id") * 7 % 1000).alias("v"))
    plan = row_number(df, ["v", "id"], "n", 16)._jdf.queryExecution().executedPlan().toString()
    for part in plan.split("Exchange SinglePartition")[1:]:
        assert "HashAggregate(keys=[_slice" in part[:2000]


def test_planning_does_not_grow_with_slices(spark):
    """A predicate on the slice is one comparison, however many slices there are."""
    df = spark.range(5000).select("id", (F.col("id") * 7 % 1000).alias("v"))
    lengths, seconds = [], []
    for slices in (16, 4096):
        plan = OrderedScan(df, ["v", "id"], slices=slices).apply([Counter("n"), Shift("p", "v", 1)]).where("n = 7")
        planning = time.perf_counter()
        lengths.append(len(plan._jdf.queryExecution().optimizedPlan().toString()))
        seconds.append(time.perf_counter() - planning)
    assert lengths[1] < 1.2 * lengths[0]
    assert seconds[1] < 5
