"""One query per operator over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlens.functions.calendar import date_parts, days_between
from visitlens.functions.values import fill_levels, fill_numbers, null_out
from visitlens.operators import camps as camp_ops
from visitlens.operators import columns, counts, encode, metrics, ordered, sketches, split
from visitlens.operators import history as h
from visitlens.operators.skew import find_heavy_keys, left_join
from visitlens.plans import assemble as asm
from visitlens.plans import training
from visitlens.plans.ensemble import ensemble
from visitlens.plans.features import (
    LAG_DATE,
    LEAD_DATE,
    FeatureTable,
    all_features,
    build_features,
    history_features,
    select_recipe,
)
from visitlens.plans.recipes import CONFIGS, RECIPES, Recipe
from visitlens.sources import roles

V = h.Visits()
E = h.Visits("user_id", "event_type", "ts", "event_id")

UNSHARED = {"CD_Category2": "2-HIGH", "CD_Category3": 1}
HELD_OUT_MONTHS = [199906, 199907, 199908, 199909, 199910, 199911, 199912]

Query = Callable[[SparkSession, str], DataFrame]


def side_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {
        "camps": roles.camps(spark, d),
        "patients": roles.patients(spark, d),
        "first": roles.attendance_1(spark, d),
        "second": roles.attendance_2(spark, d),
        "third": roles.attendance_3(spark, d),
    }


def assembled(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, dict]:
    heavy = asm.heavy_visit_keys(roles.registrations(spark, d), V)
    train, test = asm.assemble(*roles.train_test(spark, d), side_tables(spark, d), V, heavy, unique_pairs=True)
    return train, test, heavy


def stacked(spark: SparkSession, d: str) -> tuple[DataFrame, dict]:
    train, test, heavy = assembled(spark, d)
    return columns.union_train_test(train, test), heavy


def with_camps(spark: SparkSession, d: str) -> DataFrame:
    camps = columns.prefix_columns(roles.camps(spark, d), "CD_", [V.group])
    return roles.registrations(spark, d).join(camps, V.group, "left")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(F.col(c), digits) for c in doubles})


# Sources, projections, unions


def scan_registrations(spark: SparkSession, d: str) -> DataFrame:
    return roles.registrations(spark, d)


def table_shapes(spark: SparkSession, d: str) -> DataFrame:
    return columns.table_shapes({name: roles.table(spark, d, name) for name in roles.TABLES})


def prefixed_table(name: str) -> Query:
    def query(spark: SparkSession, d: str) -> DataFrame:
        return asm.prefixed(side_tables(spark, d), V)[name]

    return query


def union_train_test(spark: SparkSession, d: str) -> DataFrame:
    train, test, _ = assembled(spark, d)
    return columns.union_train_test(train, test).select(
        "row_id", "is_train", "target", asm.SCORE_1, asm.SCORE_2, asm.STALLS
    )


def split_union(spark: SparkSession, d: str) -> DataFrame:
    train, test = roles.train_test(spark, d)
    parts = columns.split_train_test(columns.union_train_test(train, test))
    tagged = [p.select("row_id", F.lit(side).alias("side")) for p, side in zip(parts, ("train", "test"))]
    return reduce(DataFrame.unionByName, tagged)


# Joins and target


def join_dimensions(spark: SparkSession, d: str) -> DataFrame:
    rows = roles.registrations(spark, d)
    side = asm.prefixed(side_tables(spark, d), V)
    return asm.join_dimensions(rows, side["camps"], side["patients"], V, asm.heavy_visit_keys(rows, V))


def join_attendance(spark: SparkSession, d: str) -> DataFrame:
    train, _ = roles.train_test(spark, d)
    side = asm.prefixed(side_tables(spark, d), V)
    (heavy,) = find_heavy_keys(train, [V.entity, V.group])
    return asm.join_attendance(train, [side["first"], side["second"], side["third"]], V, heavy)


def join_repeated_attendance(spark: SparkSession, d: str) -> DataFrame:
    """Attendance records as they come, several for one (patient, camp): every joined copy has its own row id."""
    side = {**side_tables(spark, d), "first": roles.attendance_records(spark, d, "F"), "second": roles.attendance_records(spark, d, "O", "Health Score")}
    train, test = asm.assemble(*roles.train_test(spark, d), side, V)
    both = columns.union_train_test(train, test)
    return both.select("row_id", V.entity, V.group, "is_train", asm.SCORE_1, asm.SCORE_2, asm.STALLS, "target")


def derive_target(spark: SparkSession, d: str) -> DataFrame:
    train, _, _ = assembled(spark, d)
    return train


# Cleaning and calendar


def null_out_value(spark: SparkSession, d: str) -> DataFrame:
    return with_camps(spark, d).select("row_id", *[null_out(c, x).alias(c) for c, x in UNSHARED.items()])


def value_counts(spark: SparkSession, d: str) -> DataFrame:
    events = roles.table(spark, d, "events").select(F.floor("value").cast("bigint").alias("v"))
    return counts.value_counts(events, "v")


def mask_rare_values(spark: SparkSession, d: str) -> DataFrame:
    events = roles.table(spark, d, "events").select("event_id", F.floor("value").cast("bigint").alias("v"))
    return counts.mask_rare_values(events, ["v"], "event_id")


def mask_rare_columns(spark: SparkSession, d: str) -> DataFrame:
    names = ["Var1", "Var2", "Var4", "Var5"]
    rows = roles.registrations(spark, d).select("row_id", *names)
    return counts.mask_rare_values(rows, names, "row_id")


def fill_sentinel(spark: SparkSession, d: str) -> DataFrame:
    data, _ = stacked(spark, d)
    numbers = [asm.SCORE_1, asm.SCORE_2, asm.STALLS, "target"]
    filled = fill_numbers(data.withColumn("CD_Category2", null_out("CD_Category2", "2-HIGH")), numbers)
    return filled.select("row_id", *numbers, fill_levels("CD_Category2").alias("CD_Category2"))


def date_part_columns(spark: SparkSession, d: str) -> DataFrame:
    data = join_dimensions(spark, d)
    dates = columns.column_roles(data, [V.row_id]).dates
    parts = date_parts(dates)
    return data.withColumns(parts).select("row_id", *parts)


def time_deltas(spark: SparkSession, d: str) -> DataFrame:
    data = join_dimensions(spark, d)
    return rounded(
        data.select(
            "row_id",
            days_between("PD_First_Interaction", V.time).alias("time_since_interaction"),
            days_between("CD_Camp_Start_Date", V.time).alias("time_since_camp_start"),
            days_between(V.time, "CD_Camp_End_Date").alias("time_before_camp_ends"),
        )
    )


def camp_time(spark: SparkSession, d: str) -> DataFrame:
    return rounded(
        with_camps(spark, d).select(
            "row_id",
            days_between("CD_Camp_End_Date", "CD_Camp_Start_Date").alias("camp_time"),
            days_between("CD_Camp_Start_Date", "CD_Camp_End_Date").alias("camp_time_forward"),
        )
    )


# History


def _history(spark: SparkSession, d: str, *names: str) -> DataFrame:
    data, heavy = stacked(spark, d)
    known = history_features(V)
    made = h.add_history(data, [known[n] for n in names], V, heavy[V.entity])
    return rounded(made.select("row_id", *names))


def _row_history(rows: DataFrame, features: list[h.Feature], v: h.Visits) -> DataFrame:
    return rounded(h.add_history(rows, features, v).select(v.row_id, *[f.name for f in features]))


def time_since_last_visit(spark: SparkSession, d: str) -> DataFrame:
    return _row_history(roles.registrations(spark, d), [h.time_since_last(V)], V)


def time_since_first_visit(spark: SparkSession, d: str) -> DataFrame:
    return _row_history(roles.registrations(spark, d), [h.time_since_first(V)], V)


def event_recency(spark: SparkSession, d: str) -> DataFrame:
    events = roles.table(spark, d, "events").select("event_id", "user_id", "event_type", "ts")
    features = [
        h.time_since_last(E),
        h.time_since_first(E),
        h.visits_so_far(E),
        h.visits_within(E, "event_type", "visits_of_this_type"),
    ]
    return _row_history(events, features, E)


def visits_till_now(spark: SparkSession, d: str) -> DataFrame:
    features = [h.visits_so_far(V), h.visits_so_far(V, "number_of_camps_attended")]
    return _row_history(roles.registrations(spark, d), features, V)


def visits_in_camp(spark: SparkSession, d: str) -> DataFrame:
    feature = h.visits_within(V, V.group, "number_of_visits_in_this_camp")
    return _row_history(roles.registrations(spark, d), [feature], V)


def visits_by_category(spark: SparkSession, d: str) -> DataFrame:
    rows = with_camps(spark, d).withColumns({c: null_out(c, x) for c, x in UNSHARED.items()})
    features = [
        h.visits_within(V, f"CD_Category{i}", f"number_of_visits_in_this_camp_type{i}") for i in (1, 2, 3)
    ]
    return _row_history(rows, features, V)


def visits_today(spark: SparkSession, d: str) -> DataFrame:
    return _row_history(roles.registrations(spark, d), [h.visits_same_time(V)], V)


def last_scores(spark: SparkSession, d: str) -> DataFrame:
    return _history(
        spark, d, "last1_score_camp1", "last1_score_camp2", "last2_score_camp1", "last2_score_camp2"
    )


def lag_target(spark: SparkSession, d: str) -> DataFrame:
    return _history(spark, d, "last_1_target", "last_2_target")


def lead_lag_target(spark: SparkSession, d: str) -> DataFrame:
    data, heavy = stacked(spark, d)
    features = [
        h.earlier_value(V, "target", 1, "target_lead", V.by_time),
        h.earlier_value(V, "target", -1, "target_lag", V.by_time),
    ]
    made = h.add_history(data, features, V, heavy[V.entity])
    return made.select("row_id", "target_lead", "target_lag")


def lead_lag_dates(spark: SparkSession, d: str) -> DataFrame:
    known = history_features(V)
    return _row_history(roles.registrations(spark, d), [known[LEAD_DATE], known[LAG_DATE]], V)


def global_lag_diff(spark: SparkSession, d: str) -> DataFrame:
    feature = history_features(V)["time_since_last_visit_in_this_camp_today"]
    return _row_history(roles.registrations(spark, d), [feature], V)


def global_lag_diff_by_row(spark: SparkSession, d: str) -> DataFrame:
    feature = history_features(V)["time_since_last_visit_in_this_camp"]
    return _row_history(roles.registrations(spark, d), [feature], V)


def global_lag_events(spark: SparkSession, d: str) -> DataFrame:
    """The previous event of the whole table, by the sliced scan itself."""
    events = roles.table(spark, d, "events").select("event_id", "user_id", "event_type", "ts")
    lagged = ordered.shift(events, "ts", 1, ["user_id", "event_type", "ts", "event_id"], "previous_ts", slices=16)
    return rounded(
        lagged.select("event_id", F.coalesce(days_between("previous_ts", "ts"), F.lit(0.0)).alias("days_since_previous"))
    )


# Groups


def people_in_camp(spark: SparkSession, d: str) -> DataFrame:
    rows = roles.registrations(spark, d)
    (heavy,) = find_heavy_keys(rows, [V.group])
    return counts.add_distinct_count(rows, V.group, V.entity, "num_people_in_camp", heavy, "row_id").select(
        "row_id", V.group, "num_people_in_camp"
    )


def people_per_day(spark: SparkSession, d: str) -> DataFrame:
    rows = roles.registrations(spark, d)
    (heavy,) = find_heavy_keys(rows, [V.time])
    return counts.add_distinct_count(rows, V.time, V.entity, "num_people_in_camp_today", heavy, "row_id").select(
        "row_id", V.time, "num_people_in_camp_today"
    )


def people_in_camp_sketch(spark: SparkSession, d: str) -> DataFrame:
    """Per camp and over all camps, from sketches by (camp, day) that are merged: is the estimate within four standard errors?"""
    rows = roles.registrations(spark, d)
    sketches_of_days = sketches.store_sketches(rows, [V.group, V.time], V.entity)
    whole = sketches_of_days.withColumn(V.group, F.lit(None).cast("bigint"))
    merged = sketches.merge_sketches(sketches_of_days.unionByName(whole), [V.group])
    exact = rows.unionByName(rows.withColumn(V.group, F.lit(None).cast("bigint"))).groupBy(V.group)
    counted = exact.agg(F.count_distinct(V.entity).cast("bigint").alias("num_people"))
    bound = F.greatest(F.lit(1.0), 4 * sketches.standard_error() * F.col("num_people"))
    both = sketches.estimates(merged, "estimate").withColumnRenamed(V.group, "_camp").join(counted, F.col("_camp").eqNullSafe(F.col(V.group)))
    return both.select(V.group, "num_people", (F.abs(F.col("estimate") - F.col("num_people")) <= bound).alias("within_bound"))


def users_per_day(spark: SparkSession, d: str) -> DataFrame:
    events = roles.table(spark, d, "events").select(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"), "user_id")
    return counts.distinct_per_key(events, "day", "user_id", "num_users")


def camp_bounds(spark: SparkSession, d: str) -> DataFrame:
    rows = with_camps(spark, d)
    bounds = camp_ops.group_bounds(rows, V.group, "CD_Camp_Start_Date", "CD_Camp_End_Date", "row_id")
    return camp_ops.next_start(bounds, V.group)


def next_camp_in(spark: SparkSession, d: str) -> DataFrame:
    rows = with_camps(spark, d)
    (heavy,) = find_heavy_keys(roles.registrations(spark, d), [V.group])
    made = camp_ops.add_next_in(
        rows, V.group, V.time, "CD_Camp_Start_Date", "CD_Camp_End_Date", "row_id", heavy=heavy
    )
    return rounded(made.select("row_id", "next_camp_in"))


# Total orders and splits


def row_number_global(spark: SparkSession, d: str) -> DataFrame:
    rows = roles.registrations(spark, d).select("row_id", V.time)
    return ordered.row_number(rows, [V.time, "row_id"])


def sort_by_date(spark: SparkSession, d: str) -> DataFrame:
    return roles.registrations(spark, d).orderBy(F.col(V.time).asc_nulls_last(), "row_id")


def _fifth(rows: DataFrame) -> int:
    return rows.count() // 5


def holdout_last_n(spark: SparkSession, d: str) -> DataFrame:
    train, _ = roles.train_test(spark, d)
    parts = split.split_last_n(train, _fifth(train), V.time, "row_id")
    return _sides(parts)


def holdout_by_group(spark: SparkSession, d: str) -> DataFrame:
    train, _ = roles.train_test(spark, d)
    return _sides(split.split_by_group(train, V.group, HELD_OUT_MONTHS))


def _sides(parts: tuple[DataFrame, DataFrame]) -> DataFrame:
    tagged = [p.select("row_id", F.lit(side).alias("side")) for p, side in zip(parts, ("training", "validation"))]
    return reduce(DataFrame.unionByName, tagged)


# Encoding and feature tables


def label_encode(spark: SparkSession, d: str) -> DataFrame:
    segments = roles.table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    (heavy,) = find_heavy_keys(segments, ["c_mktsegment"])
    return encode.label_encode(segments, "c_mktsegment", heavy, "c_custkey")


def one_hot(spark: SparkSession, d: str) -> DataFrame:
    rows = roles.table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    (heavy,) = find_heavy_keys(rows, ["o_orderpriority"])
    return encode.one_hot_long(rows, "o_orderpriority", "o_orderkey", heavy)


def features_of(spark: SparkSession, d: str, recipe: Recipe) -> FeatureTable:
    train, test, heavy = assembled(spark, d)
    return build_features(train, test, recipe, V, unshared=UNSHARED, heavy=heavy, keys_only=with_camps(spark, d))


def feature_table(recipe: str) -> Query:
    def query(spark: SparkSession, d: str) -> DataFrame:
        table = features_of(spark, d, RECIPES[recipe])
        return rounded(table.df)

    return query


# Scores


def _scored(spark: SparkSession, d: str) -> DataFrame:
    train, _, _ = assembled(spark, d)
    return roles.predictions(spark, d).join(train.select("row_id", "target"), "row_id")


def auc_exact(spark: SparkSession, d: str) -> DataFrame:
    return rounded(metrics.auc(_scored(spark, d), "Outcome", "target", ["model"]), 9)


def share_of_total(spark: SparkSession, d: str) -> DataFrame:
    used = roles.table(spark, d, "events").groupBy("user_id").agg(F.count(F.lit(1)).cast("bigint").alias("fscore"))
    return rounded(metrics.share_of_total(used, "fscore", "share"), 9).orderBy("share", "user_id")


def ensemble_mean(spark: SparkSession, d: str) -> DataFrame:
    keys = ["row_id", "Patient_ID", "Health_Camp_ID"]
    return rounded(ensemble(roles.predictions(spark, d), keys), 9)


# Hot keys and nulls


def hot_registrations(spark: SparkSession, d: str) -> DataFrame:
    """Registrations with a third of all rows on one patient, and rows without patient, date or value."""
    return roles.registrations(spark, d).select(
        "row_id",
        F.expr("CASE WHEN row_id % 11 = 0 THEN NULL WHEN row_id % 3 = 0 THEN 5 ELSE Patient_ID END").alias("Patient_ID"),
        "Health_Camp_ID",
        F.expr("CASE WHEN row_id % 17 <> 0 THEN Registration_Date END").alias("Registration_Date"),
        F.expr("nullif(Var1, 3)").alias("Var1"),
        F.expr("CASE WHEN row_id % 5 <> 0 THEN Var2 END").alias("Var2"),
    )


def hot_entity_history(spark: SparkSession, d: str) -> DataFrame:
    features = [
        h.time_since_last(V),
        h.visits_so_far(V),
        h.visits_within(V, V.group, "number_of_visits_in_this_camp"),
        h.earlier_value(V, "Var2", 2, "var2_two_rows_ago"),
    ]
    return _row_history(hot_registrations(spark, d), features, V)


def hot_key_join(spark: SparkSession, d: str) -> DataFrame:
    rows = hot_registrations(spark, d).select("row_id", "Patient_ID")
    (heavy,) = find_heavy_keys(rows, ["Patient_ID"])
    return left_join(rows, roles.patients(spark, d), ["Patient_ID"], heavy, "row_id")


def mask_with_nulls(spark: SparkSession, d: str) -> DataFrame:
    rows = hot_registrations(spark, d).select("row_id", "Var1", "Var2")
    return counts.mask_rare_values(rows, ["Var1", "Var2"], "row_id")


# Training


def _vectors(spark: SparkSession, d: str, recipe: str = "R1") -> DataFrame:
    return training.vectorise(features_of(spark, d, RECIPES[recipe]).stored())


def _held_out(vectors: DataFrame, holdout: str) -> Column:
    train = vectors.where(F.col("is_train"))
    return training.holdout(
        holdout, train, V.time, V.group, V.row_id, last_rows=_fifth(train), groups=HELD_OUT_MONTHS
    )


KEYS = [V.row_id, V.entity, V.group]


def feature_map(spark: SparkSession, d: str) -> DataFrame:
    return training.feature_map(features_of(spark, d, RECIPES["R1"]).stored())


def train_gbt(spark: SparkSession, d: str) -> DataFrame:
    vectors = _vectors(spark, d)
    return training.train_and_score(vectors, CONFIGS["model1"], _held_out(vectors, "time"), KEYS).predictions


def rounds_by_auc(spark: SparkSession, d: str) -> DataFrame:
    vectors = _vectors(spark, d)
    held_out, train = _held_out(vectors, "time"), vectors.where(F.col("is_train"))
    _, curve = training.choose_rounds(train.where(~held_out), train.where(held_out), CONFIGS["model1"])
    return curve.table()


def feature_importance(spark: SparkSession, d: str) -> DataFrame:
    table = features_of(spark, d, RECIPES["R4"]).stored()
    levels = training.levels_of(table)
    vectors = training.vectorise(table, levels)
    trained = training.train_and_score(vectors, CONFIGS["model4"], _held_out(vectors, "group"), KEYS)
    return training.feature_importance(trained.model, training.feature_map(table, levels))


def sweep(spark: SparkSession, d: str) -> DataFrame:
    """Mean prediction over all thirteen configurations, per test row."""
    table = features_of(spark, d, all_features()).stored()
    vectors = {name: training.vectorise(select_recipe(table, r)) for name, r in RECIPES.items()}
    splits = {r: _held_out(v, RECIPES[r].holdout) for r, v in vectors.items()}
    trained = training.sweep(vectors.get, list(CONFIGS.values()), splits.get, KEYS)
    return ensemble(training.stack_predictions(trained), KEYS)


QUERIES: dict[str, Query] = {
    "scan_registrations": scan_registrations,
    "hot_entity_history": hot_entity_history,
    "hot_key_join": hot_key_join,
    "mask_with_nulls": mask_with_nulls,
    "table_shapes": table_shapes,
    "prefix_columns": prefixed_table("second"),
    "prefix_camps": prefixed_table("camps"),
    "prefix_patients": prefixed_table("patients"),
    "prefix_first": prefixed_table("first"),
    "prefix_third": prefixed_table("third"),
    "union_train_test": union_train_test,
    "split_union": split_union,
    "join_dimensions": join_dimensions,
    "join_attendance": join_attendance,
    "join_repeated_attendance": join_repeated_attendance,
    "derive_target": derive_target,
    "null_out_value": null_out_value,
    "value_counts": value_counts,
    "mask_rare_values": mask_rare_values,
    "mask_rare_columns": mask_rare_columns,
    "fill_sentinel": fill_sentinel,
    "date_parts": date_part_columns,
    "time_deltas": time_deltas,
    "camp_time": camp_time,
    "time_since_last_visit": time_since_last_visit,
    "time_since_first_visit": time_since_first_visit,
    "event_recency": event_recency,
    "visits_till_now": visits_till_now,
    "visits_in_camp": visits_in_camp,
    "visits_by_category": visits_by_category,
    "visits_today": visits_today,
    "last_scores": last_scores,
    "lag_target": lag_target,
    "lead_lag_target": lead_lag_target,
    "lead_lag_dates": lead_lag_dates,
    "global_lag_diff": global_lag_diff,
    "global_lag_diff_by_row": global_lag_diff_by_row,
    "global_lag_events": global_lag_events,
    "people_in_camp": people_in_camp,
    "people_per_day": people_per_day,
    "people_in_camp_sketch": people_in_camp_sketch,
    "users_per_day": users_per_day,
    "camp_bounds": camp_bounds,
    "next_camp_in": next_camp_in,
    "row_number_global": row_number_global,
    "sort_by_date": sort_by_date,
    "holdout_last_n": holdout_last_n,
    "holdout_by_group": holdout_by_group,
    "label_encode": label_encode,
    "one_hot": one_hot,
    "feature_table": feature_table("R1"),
    "feature_table_r4": feature_table("R4"),
    "feature_table_r5": feature_table("R5"),
    "feature_table_r6": feature_table("R6"),
    "feature_table_r7": feature_table("R7"),
    "auc_exact": auc_exact,
    "share_of_total": share_of_total,
    "ensemble_mean": ensemble_mean,
    "feature_map": feature_map,
    "train_gbt": train_gbt,
    "rounds_by_auc": rounds_by_auc,
    "feature_importance": feature_importance,
    "sweep": sweep,
}
