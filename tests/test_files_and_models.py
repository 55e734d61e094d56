"""File sources and sinks, and the three steps from CSV files to the averaged predictions."""

import csv
import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from visitlens.plans.assemble import assemble_files
from visitlens.plans.ensemble import ensemble_files, ensemble_run
from visitlens.plans.features import FeatureTable
from visitlens.plans.models import run_models
from visitlens.plans.recipes import CONFIGS, HELD_OUT_CAMPS, RECIPES
from visitlens.plans import training
from visitlens.sources import files
from visitlens.sources.checked import read_checked, write_rejects


def write_csv(path, header, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        csv.writer(f).writerows([header, *rows])


@pytest.fixture(scope="module")
def camp_files(tmp_path_factory):
    """Seven small files; patients with an even id attend, so the target can be learnt."""
    folder = str(tmp_path_factory.mktemp("camps"))
    rng = random.Random(3)
    date = lambda d: (dt.date(2005, 1, 1) + dt.timedelta(days=d)).strftime("%d-%b-%y")
    camps = [*HELD_OUT_CAMPS, *range(6500, 6512)]
    reg = ["Patient_ID", "Health_Camp_ID", "Registration_Date", "Var1", "Var2", "Var4", "Var5"]
    rows = []
    for _ in range(900):
        i = rng.randrange(len(camps))
        gone = rng.random() < 0.02
        rows.append([rng.randrange(60), camps[i], "" if gone else date(i * 20 + rng.randrange(15)), rng.randrange(5), 0, 1, 2])
    write_csv(f"{folder}/Train/Train.csv", reg, rows)
    write_csv(f"{folder}/Test_D7W1juQ.csv", reg, [[rng.randrange(70), c, date(600 + c % 7), 1, 0, 1, 2] for c in camps] * 3)
    write_csv(
        f"{folder}/Train/Health_Camp_Detail.csv",
        ["Health_Camp_ID", "Camp_Start_Date", "Camp_End_Date", "Category1", "Category2", "Category3"],
        [[c, date(i * 20), date(i * 20 + 15), ("First", "Second", "Third")[i % 3], "ABC"[i % 3], i % 2 + 1] for i, c in enumerate(camps)],
    )
    write_csv(
        f"{folder}/Train/Patient_Profile.csv",
        ["Patient_ID", "City_Type", "Age", "First_Interaction"],
        [[p, "AB"[p % 2], 30 + p % 2 * 20, date(-p)] for p in range(65)],
    )
    pairs = sorted({(r[0], r[1]) for r in rows if r[0] % 2 == 0})
    third = [(p, c, p % 3) for p, c in pairs[1::3]]
    write_csv(
        f"{folder}/Train/First_Health_Camp_Attended.csv",
        ["Patient_ID", "Health_Camp_ID", "Donation", "Health_Score", ""],
        [(p, c, 10, 0.5, "") for p, c in pairs[0::3]],
    )
    write_csv(
        f"{folder}/Train/Second_Health_Camp_Attended.csv",
        ["Patient_ID", "Health_Camp_ID", "Health Score"],
        [(p, c, 0.25) for p, c in pairs[2::3]],
    )
    write_csv(
        f"{folder}/Train/Third_Health_Camp_Attended.csv",
        ["Patient_ID", "Health_Camp_ID", "Number_of_stall_visited", "Last_Stall_Visited_Number"],
        [(*t, 1) for t in third],
    )
    return folder


def test_three_steps_from_files(spark, camp_files, tmp_path):
    assembled, output = str(tmp_path / "assembled"), str(tmp_path / "out")
    assemble_files(spark, camp_files, assembled)
    train, test = spark.read.parquet(f"{assembled}/train"), spark.read.parquet(f"{assembled}/test")
    assert train.count() == 900 and test.count() == 63
    assert not [c for c in train.columns if "Unnamed" in c or c.startswith("F__c")]
    assert dict(train.dtypes)["CD_Camp_Start_Date"] == "timestamp_ntz"
    assert train.where("Registration_Date IS NULL").count() > 0
    ids = sorted(r["row_id"] for r in train.select("row_id").union(test.select("row_id")).collect())
    assert ids == list(range(963))

    configs = [CONFIGS["model1"], CONFIGS["model6"], CONFIGS["model7"]]
    trained = run_models(spark, assembled, output, "r1", configs, max_rounds=3, depth=3, last_rows=150)
    for t in trained:
        assert t.auc > 0.5 and 1 <= t.rounds <= 3
    predictions = files.read_predictions(spark, output, "r1")
    assert predictions.groupBy("model").count().where("count != 63").count() == 0
    low, high = predictions.agg(F.min("Outcome"), F.max("Outcome")).first()
    assert 0 <= low < high <= 1
    assert spark.read.parquet(f"{output}/metrics").count() == 3

    mean = spark.read.parquet(f"{output}/ensemble/run_id=r1")
    assert mean.count() == 63
    key = mean.first()
    parts = [r["Outcome"] for r in predictions.where(F.col("row_id") == key["row_id"]).collect()]
    assert key["Outcome"] == pytest.approx(sum(parts) / 3)


def test_rows_are_numbered_in_file_order_across_blocks(spark, tmp_path):
    for part in ("a", "b"):
        write_csv(str(tmp_path / "in" / f"{part}.csv"), ["name"], [[f"{part}{i:05d}"] for i in range(3000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = files.read_csv(spark, str(tmp_path / "in"), schema="name string", row_id="row_id")
        got = [r["name"] for r in df.orderBy("row_id").collect()]
        ids = [r["row_id"] for r in df.select("row_id").orderBy("row_id").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [f"{part}{i:05d}" for part in ("a", "b") for i in range(3000)]
    assert ids == list(range(6000))


def test_prediction_files_are_read_by_name_part(spark, tmp_path):
    folder = str(tmp_path / "csv")
    header = ["Health_Camp_ID", "Outcome", "Patient_ID"]
    write_csv(f"{folder}/8123_model1.csv", header, [[5, 0.2, 1], [5, 0.4, 2]])
    write_csv(f"{folder}/79_model2.csv", header, [[5, 0.4, 1], [5, "", 2]])
    write_csv(f"{folder}/ensemble.csv", header, [[5, 0.9, 1]])
    df = files.read_prediction_files(spark, folder)
    assert {(r["model"], r["auc_digits"]) for r in df.collect()} == {("model1", "8123"), ("model2", "79")}
    target = str(tmp_path / "mean")
    ensemble_files(spark, folder, target)
    got = {r["Patient_ID"]: float(r["Outcome"]) for r in spark.read.option("header", True).csv(target).selectExpr("int(Patient_ID) Patient_ID", "Outcome").collect()}
    assert got == {1: pytest.approx(0.3), 2: pytest.approx(0.4)}
    assert files.auc_digits(0.8123) == "8123"


def test_date_layouts(spark):
    df = spark.createDataFrame([("10-Sep-05",), ("2005-09-10",), ("2005-09-10 12:30:00",), ("",), (None,)], "d string")
    got = [r["d"] for r in files.parse_dates(df, ["d"]).collect()]
    assert got == [dt.datetime(2005, 9, 10), dt.datetime(2005, 9, 10), dt.datetime(2005, 9, 10, 12, 30), None, None]


def test_the_plan_of_a_scoring_pass_grows_with_its_rounds(spark):
    """A tree is weighted twice in the plan at most (before: once for each later round, 21 times in all), and the sums are those of the trees."""
    from pyspark.ml.feature import VectorAssembler

    rows = [(i, float(i % 2), float(i % 7), float(i * 31 % 11)) for i in range(200)]
    df = spark.createDataFrame(rows, "_id bigint, target double, a double, b double")
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    model = training.classifier(CONFIGS["model1"], 8, depth=2).fit(vectors)
    outputs = [{r[0]: r[1] for r in t.transform(vectors).select("_id", "prediction").collect()} for t in model.trees]
    scored = training._add_outputs(model, vectors, range(2, 8))
    assert scored._jdf.queryExecution().optimizedPlan().toString().count(" * _tree") <= 12
    for row in scored.collect():
        total = None
        for i in range(2, 8):
            output = model.treeWeights[i] * outputs[i][row["_id"]]
            total = output if total is None else total + output
            assert row[f"_sum{i}"] == total


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.5), (2, None)], "k bigint, x double")
    files.write_table(df, str(tmp_path / "t"), "csv")
    files.write_table(df, str(tmp_path / "t"), "csv")
    back = files.read_csv(spark, str(tmp_path / "t"), schema="k bigint, x double")
    assert sorted(map(tuple, back.collect()), key=repr) == [(1, 0.5), (2, None)]


def test_round_choice():
    curve = [(1, 0.5), (2, 0.7), (3, 0.6), (4, 0.7), (5, 0.9)]
    assert training.best_round(curve, 10) == training.Choice(5, 0.9, False)
    assert training.best_round(curve, 2) == training.Choice(2, 0.7, True)
    assert training.best_round([(1, None), (2, None)], 5) == training.Choice(1, None, False)


def test_running_margin_equals_model_margin(spark):
    rows = [(float(i % 2), float(i % 7), float(i * 31 % 11)) for i in range(300)]
    df = spark.createDataFrame(rows, "target double, a double, b double")
    from pyspark.ml.feature import VectorAssembler

    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    model = training.classifier(CONFIGS["model1"], 5, depth=3).fit(vectors)
    curve = dict(training.Curve.start(vectors).extend(model, per_pass=2).aucs)
    assert sorted(curve) == [1, 2, 3, 4, 5]
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    full = BinaryClassificationEvaluator(labelCol="target", numBins=0).evaluate(model.transform(vectors))
    assert curve[5] == pytest.approx(full)

    longer = training.classifier(CONFIGS["model1"], 7, depth=3).fit(vectors)
    extended = dict(training.Curve.start(vectors).extend(model, 3).extend(longer, 3).aucs)
    assert {n: extended[n] for n in curve} == pytest.approx(curve)
    assert extended == pytest.approx(dict(training.Curve.start(vectors).extend(longer, 25).aucs))
    chosen, known = training.choose_rounds(vectors, vectors, CONFIGS["model1"], 7, 3, first=2)
    assert dict(known.aucs) == pytest.approx(extended)
    assert (chosen.rounds, chosen.auc) == (training.best_round(list(extended.items()), 30).rounds, pytest.approx(max(extended.values())))

    names = training.feature_map(FeatureTable(vectors, [], ["a", "b"], [], [], []))
    assert [tuple(r) for r in names.collect()] == [(0, "a", "q"), (1, "b", "q")]
    shares = training.feature_importance(model, names).collect()
    assert sum(r["split_share"] for r in shares) == pytest.approx(1)
    assert sum(r["gain_share"] for r in shares) == pytest.approx(1)
    text = model.toDebugString
    for r in shares:
        assert r["splits"] == text.count(f"If (feature {r['position']} ")


def test_recipes_and_configurations():
    assert {name: len(r.features) for name, r in RECIPES.items()} == {"R1": 19, "R4": 17, "R5": 22, "R6": 24, "R7": 20}
    assert len(CONFIGS) == 13
    assert [c.model for c in CONFIGS.values() if c.recipe != "R1"] == ["model4", "model5", "model6", "model7"]


def test_the_stop_comes_from_patience(spark):
    """With the configured limits the search ends because the AUC has stalled, before round 1200."""
    rows = [(float((i * i * 31 + i) % 97 % 2), float(i % 7), float(i * 31 % 11)) for i in range(400)]
    from pyspark.ml.feature import VectorAssembler

    df = spark.createDataFrame(rows, "target double, a double, b double")
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    train, valid = vectors.where("a < 5"), vectors.where("a >= 5")
    chosen, curve = training.choose_rounds(train, valid, CONFIGS["model1"])
    assert chosen.stalled and len(curve.aucs) < 1200
    assert chosen.rounds + CONFIGS["model1"].patience <= len(curve.aucs)


def test_no_two_fits_are_the_same():
    """Models 1 and 2 differ in patience alone; all others differ in what Spark fits."""
    seen = {}
    for config in CONFIGS.values():
        fit = training.classifier(config, 10)
        key = (config.recipe, *(fit.getOrDefault(p) for p in (fit.stepSize, fit.subsamplingRate, fit.featureSubsetStrategy, fit.minInstancesPerNode, fit.minInfoGain)))
        seen.setdefault(key, []).append(config.model)
    assert [m for m in seen.values() if len(m) > 1] == [["model1", "model2"]]
    assert CONFIGS["model1"].patience != CONFIGS["model2"].patience


def test_recipe_names_are_as_stated():
    assert set(RECIPES["R6"].features) - set(RECIPES["R5"].features) == {"last_1_target", "last_2_target"}
    assert set(RECIPES["R7"].features) - set(RECIPES["R1"].features) == {"camp_time"}
    assert set(RECIPES["R4"].features) - set(RECIPES["R1"].features) == {"number_of_camps_attended", "camp_time"}


def test_equal_fits_are_grown_once(spark, monkeypatch):
    """Models 1 and 2 share one curve, long enough for the longer patience, and their choices are their own."""
    rows = [(float((i * i * 31 + i) % 97 % 2), float(i % 7), float(i * 31 % 11), True, i) for i in range(300)]
    from pyspark.ml.feature import VectorAssembler

    df = spark.createDataFrame([*rows, (None, 1.0, 2.0, False, 300)], "target double, a double, b double, is_train boolean, row_id bigint")
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    fits = []
    grow = training.GBTClassifier.fit
    monkeypatch.setattr(training.GBTClassifier, "fit", lambda self, rows: fits.append(self.getMaxIter()) or grow(self, rows))
    pair = [CONFIGS["model1"], CONFIGS["model2"]]
    together = training.sweep({"R1": vectors}.get, pair, {"R1": F.col("a") >= 5}.get, ["row_id"], max_rounds=6, depth=2)
    assert [t.config.model for t in together] == ["model1", "model2"]
    assert len(fits) == 2 and fits[0] == 6
    alone = [training.train_and_score(vectors, c, F.col("a") >= 5, ["row_id"], 6, 2) for c in pair]
    for one, other in zip(together, alone):
        assert (one.rounds, one.auc) == (other.rounds, other.auc)
        assert one.predictions.collect() == other.predictions.collect()


def test_the_longest_patience_extends_a_shared_curve(spark):
    rows = [(float((i * i * 31 + i) % 97 % 2), float(i % 7), float(i * 31 % 11)) for i in range(300)]
    from pyspark.ml.feature import VectorAssembler

    df = spark.createDataFrame(rows, "target double, a double, b double")
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    train, valid = vectors.where("a < 5"), vectors.where("a >= 5")
    short, shared = training.choose_rounds(train, valid, CONFIGS["model1"], 200, 2, patiences=[60])
    _, own = training.choose_rounds(train, valid, CONFIGS["model1"], 200, 2)
    assert short == training.best_round(own.aucs, 30)
    assert training.best_round(shared.aucs, 60).stalled or len(shared.aucs) == 200


def test_passes_write_no_features(spark):
    """What a pass adds is a table of margins by row id, without vectors."""
    rows = [(i, float(i % 2), float(i % 7)) for i in range(200)]
    from pyspark.ml.feature import VectorAssembler

    df = spark.createDataFrame(rows, "row_id bigint, target double, a double")
    vectors = VectorAssembler(inputCols=["a"], outputCol="features").transform(df)
    curve = training.Curve.start(vectors).extend(training.classifier(CONFIGS["model1"], 4, 2).fit(vectors), 2)
    assert curve.margins.columns == ["_id", "_margin"] and curve.margins.count() == 200
    assert curve.vectors.count() == 200


def test_a_broken_run_is_refused_and_leftovers_are_dropped(spark, tmp_path):
    folder = str(tmp_path)
    rows = spark.createDataFrame([(1, 5, 0.2)], "Patient_ID bigint, Health_Camp_ID bigint, Outcome double")
    numbers = spark.createDataFrame([(0.5,)], "auc double")
    with pytest.raises(ValueError, match="no finished run"):
        files.read_predictions(spark, folder, "r")
    files.open_run(spark, folder, "r")
    for model in ("model1", "model2"):
        files.write_predictions(rows, numbers, folder, "r", model)
    with pytest.raises(ValueError, match="not finished"):
        ensemble_run(spark, folder, "r", f"{folder}/mean", ["Patient_ID"])
    files.close_run(spark, folder, "r", ["model1", "model2"])
    assert files.read_predictions(spark, folder, "r").count() == 2
    files.open_run(spark, folder, "r")
    files.write_predictions(rows.withColumn("Outcome", F.lit(0.6)), numbers, folder, "r", "model1")
    with pytest.raises(ValueError, match="no predictions of model3"):
        files.close_run(spark, folder, "r", ["model1", "model3"])
    files.close_run(spark, folder, "r", ["model1"])
    assert [(r["model"], r["Outcome"]) for r in files.read_predictions(spark, folder, "r").collect()] == [("model1", 0.6)]
    files.write_predictions(rows.union(rows), numbers, folder, "r", "model1")
    with pytest.raises(ValueError, match="differ from the manifest"):
        files.read_predictions(spark, folder, "r")


def test_files_of_several_headers_are_stacked_by_name(spark, tmp_path):
    folder = str(tmp_path / "csv")
    write_csv(f"{folder}/81_model1.csv", ["Patient_ID", "Health_Camp_ID", "Outcome"], [[1, 5, 0.2], [2, 5, 0.4]])
    write_csv(f"{folder}/82_model2.csv", ["Outcome", "Patient_ID", "Health_Camp_ID"], [[0.4, 1, 5], [0.8, 2, 5]])
    write_csv(f"{folder}/83_model3.csv", ["Outcome", "note, quoted", "Health_Camp_ID", "Patient_ID"], [[0.6, "a,b", 5, 1]])
    write_csv(f"{folder}/84_model4.csv", ["Patient_ID", "Health_Camp_ID", "Outcome"], [[2, 5, 0.6]])
    assert len(files.file_headers(spark, folder, "*model*")) == 3
    target = str(tmp_path / "mean")
    ensemble_files(spark, folder, target, "parquet")
    got = {r["Patient_ID"]: r["Outcome"] for r in spark.read.parquet(target).collect()}
    assert got == {1: pytest.approx(0.4), 2: pytest.approx(0.6)}
    write_csv(f"{folder}/85_model5.csv", ["Patient_ID", "Outcome"], [[2, 0.6]])
    with pytest.raises(ValueError, match="no column Health_Camp_ID"):
        files.read_prediction_files(spark, folder)


def test_broken_records_are_set_apart(spark, tmp_path):
    path = str(tmp_path / "in" / "a.csv")
    rows = [["1", "2.5", "2005-09-10", "x"], ["two", "1.0", "2005-09-10", "x"], ["3", "1.5"], ["4", "", "10.09.2005", "y"], ["5", "", "", ""]]
    write_csv(path, ["k", "v", "d", "other"], rows)
    checked = read_checked(spark, path, {"k": "bigint", "v": "double"}, ["d"], "row_id")
    assert [tuple(r) for r in checked.rows.orderBy("row_id").collect()] == [
        (0, 1, 2.5, dt.datetime(2005, 9, 10), "x"),
        (4, 5, None, None, None),
    ]
    got = sorted((r["record"], r["reason"]) for r in checked.rejects.collect())
    assert got == [("3,1.5", "fields or types"), ("4,,10.09.2005,y", "date of d"), ("two,1.0,2005-09-10,x", "fields or types")]
    assert {r["file"] for r in checked.rejects.collect()} == {"a.csv"}
    assert (checked.n_rows, checked.n_rejected) == (2, 3)
    with pytest.raises(ValueError, match="has no column z"):
        read_checked(spark, path, {"k": "bigint"}, required=["z"])
    with pytest.raises(ValueError, match="too many rejected records"):
        write_rejects(spark, {"t": checked}, str(tmp_path / "rejected"), 0.1)
    assert spark.read.parquet(str(tmp_path / "rejected")).groupBy("table").count().collect()[0]["count"] == 3
    write_rejects(spark, {"t": checked}, str(tmp_path / "rejected"), 0.9)
    empty = str(tmp_path / "in" / "none.csv")
    write_csv(empty, ["k", "v", "d", "other"], [])
    assert read_checked(spark, empty, {"k": "bigint"}, ["d"], "row_id").rows.count() == 0


def test_assembly_goes_on_without_broken_records(spark, camp_files, tmp_path):
    import shutil

    folder = str(tmp_path / "camps")
    shutil.copytree(camp_files, folder)
    with open(f"{folder}/Train/Train.csv", "a") as f:
        f.write("not a number,6570,10-Sep-05,1,0,1,2\n5,6570\n")
    assemble_files(spark, folder, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out" / "train")).count() == 900
    assert spark.read.parquet(str(tmp_path / "out" / "rejected")).count() == 2
    with pytest.raises(ValueError, match="too many rejected"):
        assemble_files(spark, folder, str(tmp_path / "out2"), most_rejected=0.001)
