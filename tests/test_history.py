"""History features: contract on small frames, and the split path for heavy entities."""

import datetime as dt

import pytest

from visitlens.operators import history as h
from visitlens.operators.skew import HeavyKeys, find_heavy_keys, left_join
from visitlens.plans.features import history_features
from visitlens.sources import roles

V = h.Visits()
DAY = dt.datetime(2005, 1, 1)
SCHEMA = (
    "row_id bigint, Patient_ID bigint, Health_Camp_ID bigint, Registration_Date timestamp_ntz, "
    "CD_Category1 string, CD_Category2 string, CD_Category3 bigint, "
    "F_Health_Score double, S_Health_Score double, target double"
)


def visit(row_id, patient, camp, day, cat1="First", cat2=None, cat3=None, f=None, s=None, target=None):
    date = None if day is None else DAY + dt.timedelta(days=day)
    return (row_id, patient, camp, date, cat1, cat2, cat3, f, s, target)


def run(spark, rows, *features, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    out = h.add_history(df, features, V, **options).select("row_id", *[f.name for f in features])
    return {r[0]: tuple(r[1:]) if len(features) > 1 else r[1] for r in out.collect()}


def test_null_dates_sort_last_and_differ_by_zero(spark):
    rows = [visit(1, 7, 1, None), visit(2, 7, 1, 4), visit(3, 7, 1, 1.5), visit(4, 7, 1, None)]
    got = run(spark, rows, h.time_since_last(V), h.visits_so_far(V), h.time_since_first(V))
    assert got == {3: (0.0, 0, 0.0), 2: (2.5, 1, 2.5), 1: (0.0, 2, None), 4: (0.0, 3, None)}


def test_ties_follow_row_id(spark):
    rows = [visit(9, 7, 1, 0), visit(2, 7, 1, 0), visit(5, 7, 1, 0), visit(1, 7, 1, 1)]
    got = run(spark, rows, h.visits_so_far(V), h.visits_same_time(V))
    assert got == {2: (0, 0), 5: (1, 1), 9: (2, 2), 1: (3, 0)}


def test_null_category_has_no_count(spark):
    rows = [visit(1, 7, 1, 0, cat2="x"), visit(2, 7, 1, 1), visit(3, 7, 1, 2, cat2="x"), visit(4, 7, 1, 3)]
    got = run(spark, rows, h.visits_within(V, "CD_Category2", "n"))
    assert got == {1: 0, 2: None, 3: 1, 4: None}


def test_previous_row_crosses_entities(spark):
    rows = [visit(1, 1, 5, 10), visit(2, 1, 6, 12), visit(3, 2, 5, 4), visit(4, 2, 6, 4)]
    got = run(spark, rows, history_features(V)["time_since_last_visit_in_this_camp_today"])
    assert got == {1: 0.0, 2: 2.0, 3: -8.0, 4: 0.0}


def test_scores_and_targets_follow_file_order(spark):
    rows = [
        visit(1, 7, 1, 9, f=0.9, target=1.0),
        visit(2, 7, 1, 1, f=0.1, target=0.0),
        visit(3, 7, 2, 5, cat1="Second", s=0.5, target=1.0),
        visit(4, 7, 1, 0, f=0.4),
    ]
    known = history_features(V)
    got = run(
        spark, rows, known["last1_score_camp1"], known["last2_score_camp1"], known["last_1_target"], known["last_2_target"]
    )
    assert got == {
        1: (None, None, None, None),
        2: (0.9, None, 1.0, None),
        3: (None, None, 0.0, 1.0),
        4: (0.1, 0.9, 1.0, 0.0),
    }


def test_lead_of_eleven_rows(spark):
    rows = [visit(i, 7, 1, 20 - i) for i in range(13)]
    got = run(spark, rows, history_features(V)["Registration_Date_lag"])
    assert [i for i, d in got.items() if d is not None] == [0, 1]
    assert got[0] == DAY + dt.timedelta(days=9)


def test_rows_without_entity_have_no_group(spark):
    rows = [visit(1, None, 1, 0), visit(2, None, 1, 3), visit(3, 4, 1, 1), visit(4, 4, 1, 2)]
    got = run(
        spark,
        rows,
        h.visits_so_far(V),
        h.time_since_last(V),
        history_features(V)["time_since_last_visit_in_this_camp"],
    )
    assert got == {1: (None, 0.0, -2.0), 2: (None, 0.0, 3.0), 3: (0, 0.0, 0.0), 4: (1, 1.0, 1.0)}


@pytest.mark.parametrize("slices", [3, 40])
def test_split_path_equals_plain_path(spark, data, slices):
    """One entity with a third of the rows gives the same features split or not."""
    rows = roles.registrations(spark, data)
    hot = rows.selectExpr(
        "row_id", "if(row_id % 3 = 0, 5, Patient_ID) AS Patient_ID", "Health_Camp_ID", "Registration_Date",
        "if(row_id % 2 = 0, 'First', 'Second') AS CD_Category1", "nullif(Var1 % 3, 1) AS CD_Category2",
        "Var1 % 2 AS CD_Category3", "double(Var2) AS F_Health_Score", "double(Var2) AS S_Health_Score",
        "double(Var1 % 2) AS target",
    )
    features = list(history_features(V).values())
    (heavy,) = find_heavy_keys(hot, [V.entity], share=0.1)
    assert len(heavy.hashes) == 1
    plain = h.add_history(hot, features, V, HeavyKeys((V.entity,)))
    split = h.add_history(hot, features, V, heavy, slices=slices)
    assert sorted(map(repr, split.collect())) == sorted(map(repr, plain.collect()))


def test_salted_join_equals_plain_join(spark):
    left = spark.range(3000).selectExpr("id AS row_id", "if(id % 3 = 0, 1, if(id % 7 = 0, null, id % 50)) AS k")
    right = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k bigint, v string")
    (heavy,) = find_heavy_keys(left, ["k"], share=0.05)
    assert len(heavy.hashes) == 2 and heavy.nulls
    for spread in ("row_id", None):
        salted = left_join(left, right, ["k"], heavy, spread)
        plain = left_join(left, right, ["k"])
        assert salted.columns == plain.columns
        assert sorted(map(repr, salted.collect())) == sorted(map(repr, plain.collect()))


def test_history_shares_one_shuffle(spark, data):
    rows = roles.registrations(spark, data)
    features = [h.time_since_last(V), h.visits_so_far(V), h.visits_within(V, V.group, "in_camp"), h.visits_same_time(V)]
    plan = h.add_history(rows, features, V)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1
    assert "Python" not in plan


def test_partitions_follow_the_rows_and_are_not_merged(spark, monkeypatch):
    """With more rows than the cores' shares, a task gets a bounded number of them, and the features stay the same."""
    rows = spark.range(4000).selectExpr(
        "id AS row_id", "id * 7 % 500 AS Patient_ID", "id % 9 AS Health_Camp_ID",
        "timestamp_ntz'2005-01-01' + make_dt_interval(int(id % 31)) AS Registration_Date",
    )
    features = [h.time_since_last(V), h.visits_so_far(V), h.visits_within(V, V.group, "in_camp"), h.visits_same_time(V)]
    whole = h.add_history(rows, features, V)
    monkeypatch.setattr(h, "ROWS_PER_TASK", 100)
    spread = h.add_history(rows, features, V)
    assert spread.rdd.getNumPartitions() == 40
    assert sorted(map(tuple, spread.collect())) == sorted(map(tuple, whole.collect()))
