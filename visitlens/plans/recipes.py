"""Feature lists and training parameters of the thirteen models, as data."""

from __future__ import annotations

from dataclasses import dataclass

# Derived features of the base recipe.
BASE_FEATURES = (
    "time_since_interaction",
    "time_since_camp_start",
    "time_before_camp_ends",
    "num_people_in_camp",
    "num_people_in_camp_today",
    "time_since_last_visit",
    "time_since_first_visit",
    "time_since_last_visit_in_this_camp_today",
    "number_of_visits_in_this_camp",
    "number_of_visits_in_this_camp_type1",
    "number_of_visits_in_this_camp_type2",
    "number_of_visits_in_this_camp_type3",
    "last1_score_camp1",
    "last1_score_camp2",
    "last2_score_camp1",
    "last2_score_camp2",
    "number_of_visits_today",
    "visits_till_now",
    "next_camp_in",
)

# Camps held out by the group split.
HELD_OUT_CAMPS = (6570, 6571, 6575, 6578, 6580, 6581, 6585, 6586, 6587)

# Rows held out by the time split, columns checked for rare values,
# and category values that training and test rows do not share.
HELD_OUT_ROWS = 15000
RARE_VALUE_COLUMNS = ("Var1", "Var2", "Var4", "Var5")
UNSHARED_VALUES = {"CD_Category2": "B", "CD_Category3": 1}

# Camp types whose scores are looked up, and places of the date shifts.
CAMP_TYPES = {"camp1": ("First", "F_Health_Score"), "camp2": ("Second", "S_Health_Score")}
DATE_LEAD, DATE_LAG = 1, -11


@dataclass(frozen=True)
class Recipe:
    """Which derived features a model uses and how it holds out its validation rows."""

    name: str
    features: tuple[str, ...]
    holdout: str
    shifted_dates: bool = False
    camp_time_from_end: bool = False


def _without(*names: str) -> tuple[str, ...]:
    return tuple(f for f in BASE_FEATURES if f not in names)


_GROUP_ADDED = ("number_of_camps_attended", "camp_time", "time_since_last_visit_in_this_camp")

RECIPES = {
    r.name: r
    for r in (
        Recipe("R1", BASE_FEATURES, "time"),
        Recipe(
            "R4",
            _without("last2_score_camp2", "number_of_visits_today", "visits_till_now", "next_camp_in")
            + ("number_of_camps_attended", "camp_time"),
            "group",
            camp_time_from_end=True,
        ),
        Recipe("R5", BASE_FEATURES + _GROUP_ADDED, "group", camp_time_from_end=True),
        Recipe(
            "R6",
            BASE_FEATURES + _GROUP_ADDED + ("last_1_target", "last_2_target"),
            "group",
            camp_time_from_end=True,
        ),
        Recipe("R7", BASE_FEATURES + ("camp_time",), "time", shifted_dates=True),
    )
}


@dataclass(frozen=True)
class Config:
    """One model's training parameters."""

    model: str
    recipe: str
    eta: float
    min_child_weight: float
    gamma: float
    colsample: float
    subsample: float
    alpha: float
    lambda_: float
    patience: int


# Fixed values, common to all models.
MAX_DEPTH = 6
SEED = 6656
MAX_ROUNDS = 1200

# Model, recipe, eta, min_child_weight, gamma, colsample, subsample, alpha, lambda, patience.
CONFIGS = {
    c.model: c
    for c in (
        Config("model1", "R1", 0.3, 1.5, 0.0, 0.7, 0.7, 0.3, 1.3, 30),
        Config("model2", "R1", 0.3, 1.5, 0.0, 0.7, 0.7, 0.4, 1.4, 60),
        Config("model3", "R1", 0.2, 1.5, 0.0, 0.7, 0.7, 0.5, 1.5, 60),
        Config("model4", "R4", 0.1, 1.2, 0.0, 0.75, 0.75, 0.3, 1.3, 30),
        Config("model5", "R5", 0.05, 1.2, 0.0, 0.75, 0.75, 0.3, 1.3, 30),
        Config("model6", "R6", 0.2, 1.2, 0.0, 0.75, 0.75, 0.3, 1.3, 30),
        Config("model7", "R7", 0.3, 1.5, 0.0, 0.7, 0.7, 0.3, 1.3, 30),
        Config("model8", "R1", 0.3, 1.5, 0.2, 0.7, 0.7, 0.3, 1.3, 30),
        Config("model9", "R1", 0.3, 1.5, 0.1, 0.7, 0.7, 0.3, 1.3, 30),
        Config("model10", "R1", 0.3, 1.5, 0.15, 0.7, 0.7, 0.3, 1.3, 30),
        Config("model11", "R1", 0.3, 1.5, 0.2, 0.8, 0.75, 0.2, 1.2, 30),
        Config("model12", "R1", 0.3, 1.5, 0.2, 0.6, 0.7, 0.3, 1.3, 30),
        Config("model13", "R1", 0.3, 1.4, 0.2, 0.7, 0.7, 0.4, 1.4, 30),
    )
}
