"""Step 2a: the feature table of a recipe, from the assembled training and test tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.functions.calendar import date_part_names, date_parts, days_between
from visitlens.functions.values import fill_levels, fill_numbers, null_out
from visitlens.operators import history as h
from visitlens.operators.camps import add_next_in
from visitlens.operators.columns import ColumnRoles, column_roles, move_string_features, union_train_test
from visitlens.operators.counts import add_distinct_count, mask_rare_values
from visitlens.operators.skew import HeavyKeys
from visitlens.plans.assemble import heavy_visit_keys
from visitlens.plans.recipes import (
    CAMP_TYPES,
    DATE_LAG,
    DATE_LEAD,
    RARE_VALUE_COLUMNS,
    RECIPES,
    UNSHARED_VALUES,
    Recipe,
)
from visitlens.session import cut_lineage

CAMP_TIME_FROM_END = "camp_time_from_end"
LEAD_DATE, LAG_DATE = "Registration_Date_lead", "Registration_Date_lag"
INTERACTION, START, END = "PD_First_Interaction", "CD_Camp_Start_Date", "CD_Camp_End_Date"


@dataclass(frozen=True)
class FeatureTable:
    """The rows with their keys, flag, target, numeric and categorical feature columns."""

    df: DataFrame
    keys: list[str]
    general: list[str]
    dates: list[str]
    extra: list[str]
    categorical: list[str]

    @property
    def numeric(self) -> list[str]:
        return [*self.general, *date_part_names(self.dates), *self.extra]

    def stored(self) -> FeatureTable:
        """The same table, computed once and read from the shared folder from here on."""
        return replace(self, df=cut_lineage(self.df))


def history_features(v: h.Visits) -> dict[str, h.Feature]:
    """Every per-entity feature by name."""
    in_camp, in_camp_row = (v.group, *v.by_time), (v.group, v.row_id)
    made = [
        h.time_since_last(v),
        h.time_since_first(v),
        h.time_since_previous_row(v, in_camp, "time_since_last_visit_in_this_camp_today"),
        h.time_since_previous_row(v, in_camp_row, "time_since_last_visit_in_this_camp"),
        h.visits_within(v, v.group, "number_of_visits_in_this_camp"),
        *[h.visits_within(v, f"CD_Category{i}", f"number_of_visits_in_this_camp_type{i}") for i in (1, 2, 3)],
        *[
            h.earlier_value(v, score, k, f"last{k}_score_{camp}", only=("CD_Category1", level))
            for camp, (level, score) in CAMP_TYPES.items()
            for k in (1, 2)
        ],
        h.visits_same_time(v),
        h.visits_so_far(v),
        h.visits_so_far(v, "number_of_camps_attended"),
        *[h.earlier_value(v, "target", k, f"last_{k}_target") for k in (1, 2)],
        h.earlier_value(v, v.time, DATE_LEAD, LEAD_DATE),
        h.earlier_value(v, v.time, DATE_LAG, LAG_DATE),
    ]
    return {feature.name: feature for feature in made}


def row_features(v: h.Visits, recipe: Recipe) -> dict[str, Column]:
    """Features that need nothing but their own row."""
    forward, backward = days_between(START, END), days_between(END, START)
    return {
        "time_since_interaction": days_between(INTERACTION, v.time),
        "time_since_camp_start": days_between(START, v.time),
        "time_before_camp_ends": days_between(v.time, END),
        "camp_time": backward if recipe.camp_time_from_end else forward,
        CAMP_TIME_FROM_END: backward,
    }


def clean(df: DataFrame, unshared: dict, rare: Sequence[str], row_id: str) -> DataFrame:
    """Blank out values not shared by training and test rows, and values that occur once."""
    blanked = {c: null_out(c, value) for c, value in unshared.items() if c in df.columns}
    present = [c for c in rare if c in df.columns]
    df = df.withColumns(blanked) if blanked else df
    return mask_rare_values(df, present, row_id) if present else df


def build_features(
    train: DataFrame,
    test: DataFrame,
    recipe: Recipe,
    v: h.Visits = h.Visits(),
    unshared: dict | None = None,
    rare: Sequence[str] = RARE_VALUE_COLUMNS,
    heavy: dict[str, HeavyKeys] | None = None,
    keys_only: DataFrame | None = None,
) -> FeatureTable:
    """Union, clean, derive and fill; the result holds every feature as double or named level.

    ``keys_only`` may be a cheaper frame with the same keys, such as the registrations
    joined with nothing but their camps; counts, bounds and heavy keys then come from it.
    """
    roles = column_roles(test, skip=[v.entity, v.group, v.row_id])
    data = union_train_test(train, test)
    source = data if keys_only is None else keys_only
    if heavy is None:
        heavy = heavy_visit_keys(source, v)
    data = clean(data, UNSHARED_VALUES if unshared is None else unshared, rare, v.row_id)

    wanted = list(recipe.features)
    available = history_features(v)
    history = [f for f in wanted if f in available]
    dates = list(roles.dates)
    if recipe.shifted_dates:
        history += [LEAD_DATE, LAG_DATE]
        dates += [LEAD_DATE, LAG_DATE]
    data = h.add_history(data, [available[f] for f in history], v, heavy.get(v.entity), source=source)
    data = data.withColumns({n: c for n, c in row_features(v, recipe).items() if n in wanted})
    if "num_people_in_camp" in wanted:
        data = add_distinct_count(
            data, v.group, v.entity, "num_people_in_camp", heavy.get(v.group), v.row_id, source
        )
    if "num_people_in_camp_today" in wanted:
        data = add_distinct_count(
            data, v.time, v.entity, "num_people_in_camp_today", heavy.get(v.time), v.row_id, source
        )
    if "next_camp_in" in wanted:
        data = add_next_in(
            data, v.group, v.time, START, END, v.row_id, heavy=heavy.get(v.group), source=source
        )

    data = data.withColumns(date_parts(dates))
    roles, extra = move_string_features(data, ColumnRoles(roles.categorical, dates, roles.general), wanted)
    keys = [v.row_id, v.entity, v.group, v.time, "is_train", "target"]
    made = FeatureTable(data, keys, roles.general, dates, extra, roles.categorical)
    filled = fill_numbers(data, made.numeric).withColumns({c: fill_levels(c) for c in made.categorical})
    return replace(made, df=filled.select(*keys, *made.numeric, *made.categorical))


def all_features() -> Recipe:
    """The union of all recipes, so that one table can serve every model."""
    names = dict.fromkeys(f for r in RECIPES.values() for f in r.features)
    return Recipe("all", (*names, CAMP_TIME_FROM_END), "time", shifted_dates=True)


def select_recipe(table: FeatureTable, recipe: Recipe) -> FeatureTable:
    """A recipe's columns of the table built with ``all_features``."""
    df = table.df
    if recipe.camp_time_from_end:
        df = df.withColumn("camp_time", F.col(CAMP_TIME_FROM_END))
    shifted = (LEAD_DATE, LAG_DATE)
    dates = [d for d in table.dates if recipe.shifted_dates or d not in shifted]
    extra = [f for f in recipe.features if f in table.extra]
    picked = replace(table, dates=dates, extra=extra)
    return replace(picked, df=df.select(*table.keys, *picked.numeric, *table.categorical))
