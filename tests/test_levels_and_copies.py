"""Level dictionary, unique ids of joined copies, sketches, and heavy keys as a table."""

import random
import time

import pytest
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from visitlens.operators import copies, levels, sketches
from visitlens.operators.skew import HASH, PARTS, HeavyKeys, find_heavy_keys, heavy_from_counts, left_join
from visitlens.plans import training
from visitlens.plans.assemble import assemble
from visitlens.plans.features import FeatureTable


@pytest.fixture(scope="module")
def rows(spark):
    made = [(i, None if i % 9 == 0 else f"v{i % 4}", "b" if i % 2 else "a", float(i % 5)) for i in range(60)]
    return spark.createDataFrame(made, "row_id bigint, x string, y string, n double")


def test_positions_are_prefix_sums_over_columns(rows):
    known = levels.level_dictionary(rows, ["x", "y"], first=3)
    got = [tuple(r) for r in known.table.orderBy("position").collect()]
    names = [("x", v) for v in ("Is Null", "v0", "v1", "v2", "v3")] + [("y", "a"), ("y", "b")]
    assert got == [(c, v, 3 + i) for i, (c, v) in enumerate(names)]
    assert known.slots == 10 and known.counts == {"x": 5, "y": 2}


def test_vectors_and_feature_map(spark, rows, monkeypatch):
    table = FeatureTable(rows, ["row_id"], ["n"], [], [], ["x", "y"])
    names = [r["feature"] for r in training.feature_map(table).orderBy("position").collect()]
    assert names == ["n", "x_hot_Is Null", "x_hot_v0", "x_hot_v1", "x_hot_v2", "x_hot_v3", "y_hot_a", "y_hot_b"]
    want = {}
    for r in rows.collect():
        x = "x_hot_" + (r["x"] or "Is Null")
        want[r["row_id"]] = SparseVector(8, sorted([(0, r["n"]), (names.index(x), 1.0), (names.index(f"y_hot_{r['y']}"), 1.0)]))
    for limit in (levels.BROADCAST_BYTES, 0):
        monkeypatch.setattr(levels, "BROADCAST_BYTES", limit)
        vectors = training.vectorise(table)
        assert {r["row_id"]: r["features"] for r in vectors.collect()} == want
        assert "ml_attr" not in vectors.schema["features"].metadata


def test_no_levels_and_unknown_levels(spark, rows):
    none = levels.level_dictionary(rows, [])
    assert none.slots == 0 and levels.slot_names(["n"], none).count() == 1
    plain = training.vectorise(FeatureTable(rows, ["row_id"], ["n"], [], [], []))
    assert plain.first()["features"].size == 1
    known = levels.level_dictionary(rows.where("x = 'v1'"), ["x"])
    placed = levels.add_positions(rows, known, "row_id")
    assert placed.where("x_position IS NULL").count() == rows.where("x IS NULL OR x <> 'v1'").count()


def test_many_levels_stay_out_of_the_driver_and_the_schema(spark):
    df = spark.range(60_000).select(F.col("id").alias("row_id"), F.concat(F.lit("level "), F.col("id")).alias("x"))
    known = levels.level_dictionary(df, ["x"])
    assert known.slots == 60_000
    vectors = training.vectorise(FeatureTable(df, ["row_id"], [], [], [], ["x"]), known)
    assert len(vectors.schema.json()) < 1_000
    places = vectors.rdd.map(lambda r: (r["row_id"], int(r["features"].indices[0])))
    sample = dict(places.take(50))
    order = sorted(f"level {i}" for i in range(60_000))
    assert all(order[p] == f"level {i}" for i, p in sample.items())


def test_duplicates_are_numbered_and_ids_spread(spark):
    left = spark.createDataFrame([(0, 1), (1, 2), (2, 3), (3, None), (4, 1)], "row_id bigint, k bigint")
    a = spark.createDataFrame([(1, "p"), (1, "q"), (1, "q"), (2, "r"), (None, "s"), (None, "t")], "k bigint, a string")
    b = spark.createDataFrame([(1, 10), (1, 20), (3, 30)], "k bigint, b bigint")
    assert copies.most_per_key([a, b, a.limit(0)], ["k"]) == [3, 2, 1]
    numbered = [copies.number_duplicates(t, ["k"], f"_c{i}") for i, t in enumerate((a, b))]
    joined = left.join(numbered[0].df, "k", "left").join(numbered[1].df, "k", "left")
    out = copies.spread_ids(joined, "row_id", numbered)
    ids = [r["row_id"] for r in out.collect()]
    assert len(ids) == len(set(ids)) == 6 + 1 + 1 + 1 + 6
    assert {i // 6 for i in ids} == {0, 1, 2, 3, 4}
    assert out.columns == ["k", "row_id", "a", "b"]
    assert [r["row_id"] for r in copies.wide_ids(left, "row_id", numbered).orderBy("row_id").collect()] == [0, 6, 12, 18, 24]
    assert copies.wide_ids(left, "row_id", []).orderBy("row_id").first()["row_id"] == 0


def test_a_key_with_most_rows_is_numbered_over_slices(spark):
    df = spark.range(5_000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"), (F.col("id") % 11).alias("v"))
    numbered = copies.number_duplicates(df, ["k"], "_c").df
    found = numbered.where("k = 7").agg(F.count_distinct("_c").alias("n"), F.max("_c").alias("m")).first()
    assert tuple(found) == (df.where("k = 7").count(), df.where("k = 7").count() - 1)


def test_assembled_ids_are_unique_with_repeated_attendance(spark):
    reg = "row_id bigint, Patient_ID bigint, Health_Camp_ID bigint, Registration_Date timestamp_ntz"
    day = "2005-01-01 00:00:00"
    make = lambda n, at: spark.sql(f"SELECT id AS row_id, id % 3 AS Patient_ID, 1L AS Health_Camp_ID, timestamp_ntz'{day}' AS Registration_Date FROM range({n})").to(spark.createDataFrame([], reg).schema)
    side = {
        "camps": spark.createDataFrame([(1, "x")], "Health_Camp_ID bigint, Category1 string"),
        "patients": spark.createDataFrame([(0, "y")], "Patient_ID bigint, City string"),
        "first": spark.createDataFrame([(0, 1, 0.5), (0, 1, 0.7), (1, 1, None)], "Patient_ID bigint, Health_Camp_ID bigint, Health_Score double"),
        "second": spark.createDataFrame([(0, 1, 0.5)] * 2, "Patient_ID bigint, Health_Camp_ID bigint, `Health Score` double"),
        "third": spark.createDataFrame([(2, 1, 1)], "Patient_ID bigint, Health_Camp_ID bigint, Number_of_stall_visited bigint"),
    }
    train, test = assemble(make(9, 0), make(4, 0), side)
    ids = [r["row_id"] for r in train.collect()]
    assert len(ids) == len(set(ids)) == 3 * 4 + 3 + 3
    assert {r["row_id"] for r in test.collect()} == {0, 4, 8, 12}
    assert train.agg(F.sum("target")).first()[0] == 12 + 3


def test_sketches_merge_to_the_same_estimate(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(6), rng.randrange(20), rng.randrange(3_000)) for _ in range(12_000)] + [(1, 1, None), (None, 2, 5)]
    df = spark.createDataFrame(pairs, "camp bigint, day bigint, who bigint")
    fine = sketches.store_sketches(df, ["camp", "day"], "who")
    by_camp = {r["camp"]: r["n"] for r in sketches.estimates(sketches.merge_sketches(fine, ["camp"]), "n").collect()}
    direct = {r["camp"]: r["n"] for r in sketches.estimates(sketches.store_sketches(df, ["camp"], "who"), "n").collect()}
    exact = {c: len({w for k, _, w in pairs if k == c and w is not None}) for c in by_camp}
    assert by_camp.keys() == exact.keys() and all(abs(by_camp[c] - n) <= max(1, 0.065 * n) for c, n in exact.items())
    assert all(abs(direct[c] - by_camp[c]) <= max(1, 0.03 * exact[c]) for c in exact)
    (whole,) = sketches.estimates(sketches.merge_sketches(fine, []), "n").collect()
    assert abs(whole["n"] - len({w for _, _, w in pairs if w is not None})) < 200


def test_heavy_keys_from_counts(spark):
    counts = spark.createDataFrame([("a", 500), ("b", 3)] + [(f"k{i}", 1) for i in range(97)], "k string, n bigint")
    heavy = heavy_from_counts(counts, ["k"], "n", null_rows=400)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert (heavy.count, heavy.nulls, heavy.null_parts) == (1, True, 2 * partitions * 400 // 1000 + (2 * partitions * 400 % 1000 > 0))
    assert heavy.parts == (partitions,)
    marked = heavy.marked(spark.createDataFrame([("a",), ("b",), (None,)], "k string"))
    assert {r["k"]: r[PARTS] for r in marked.collect()} == {"a": partitions, "b": None, None: heavy.null_parts}
    assert HASH not in marked.columns


def test_cost_does_not_grow_with_the_number_of_heavy_keys(spark):
    """Plans have the same size and rows the same path for ten and for ten thousand heavy keys."""
    left = spark.range(200_000).select((F.col("id") % 10_000).alias("k"), F.col("id"))
    right = spark.range(10_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    took, plans = {}, {}
    for n in (10, 10_000):
        table = spark.range(n).select(F.xxhash64("id").alias(HASH), F.lit(3).alias(PARTS))
        joined = left_join(left, right, ["k"], HeavyKeys(("k",), table, n), "id")
        assert joined.agg(F.sum("v")).first()[0] == 200_000 * 9_999
        start = time.time()
        joined.write.format("noop").mode("overwrite").save()
        took[n] = time.time() - start
        plans[n] = len(joined._jdf.queryExecution().optimizedPlan().toString())
    assert abs(plans[10_000] - plans[10]) < 200
    assert took[10_000] < 5 * took[10] + 2


def test_found_heavy_keys_stay_in_a_table(spark):
    df = spark.range(10_000).select(F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id")).alias("k"))
    (heavy,) = find_heavy_keys(df, ["k"])
    assert heavy.count == 1 and heavy.table.columns == [HASH, PARTS]
    plain, hot = heavy.split(df)
    assert (plain.count(), hot.count()) == (5_000, 5_000) and plain.columns == df.columns
