"""Steps 2 and 3 over stored tables: train the models of a run, store predictions, average them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from visitlens.operators.history import Visits
from visitlens.plans import training
from visitlens.plans.ensemble import ensemble_run
from visitlens.plans.features import all_features, build_features, select_recipe
from visitlens.plans.recipes import CONFIGS, HELD_OUT_CAMPS, HELD_OUT_ROWS, MAX_DEPTH, MAX_ROUNDS, RECIPES, Config
from visitlens.sources.files import close_run, open_run, write_predictions


def run_models(
    spark: SparkSession,
    folder: str,
    output: str,
    run_id: str,
    configs: Sequence[Config] = tuple(CONFIGS.values()),
    max_rounds: int = MAX_ROUNDS,
    depth: int = MAX_DEPTH,
    last_rows: int = HELD_OUT_ROWS,
    groups: Sequence[int] = HELD_OUT_CAMPS,
    parallelism: int = 8,
) -> list[training.Trained]:
    """Train every configuration on ``folder``/train and /test; write predictions, metrics and their mean.

    All recipes are cut out of one feature table that is built and written once. The run's manifest is
    emptied first and written last, so the mean of a run that broke off is refused.
    """
    v = Visits()
    open_run(spark, output, run_id)
    keys = [v.row_id, v.entity, v.group]
    train, test = (spark.read.parquet(f"{folder}/{side}") for side in ("train", "test"))
    names = dict.fromkeys(c.recipe for c in configs)
    table = build_features(train, test, all_features(), v).stored()
    vectors = {r: training.vectorise(select_recipe(table, RECIPES[r])) for r in names}
    splits = {
        r: training.holdout(
            RECIPES[r].holdout, df.where(F.col("is_train")), v.time, v.group, v.row_id, last_rows, groups
        )
        for r, df in vectors.items()
    }
    trained = training.sweep(vectors.get, configs, splits.get, keys, max_rounds, depth, parallelism)
    for t in trained:
        write_predictions(t.predictions, training.metrics_table([t]), output, run_id, t.config.model)
    close_run(spark, output, run_id, [c.model for c in configs])
    ensemble_run(spark, output, run_id, f"{output}/ensemble/run_id={run_id}", keys)
    return trained
