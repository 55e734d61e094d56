"""Step 1: join registrations with camps, patients and attendance, and derive the target."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.operators.columns import prefix_columns
from visitlens.operators.copies import most_per_key, number_duplicates, spread_ids, wide_ids
from visitlens.operators.history import Visits
from visitlens.operators.skew import HeavyKeys, find_heavy_keys, left_join
from visitlens.sources.checked import Checked, read_checked, write_rejects
from visitlens.sources.files import write_table

SCORE_1 = "F_Health_Score"
SCORE_2 = "S_Health_Score"
STALLS = "T_Number_of_stall_visited"

# File of each table, its date columns, and whether its rows are numbered.
FILES = {
    "train": ("Train/Train.csv", ("Registration_Date",), True),
    "test": ("Test_D7W1juQ.csv", ("Registration_Date",), True),
    "camps": ("Train/Health_Camp_Detail.csv", ("Camp_Start_Date", "Camp_End_Date"), False),
    "patients": ("Train/Patient_Profile.csv", ("First_Interaction",), False),
    "first": ("Train/First_Health_Camp_Attended.csv", (), False),
    "second": ("Train/Second_Health_Camp_Attended.csv", (), False),
    "third": ("Train/Third_Health_Camp_Attended.csv", (), False),
}

# Types of the columns that the steps name, and of the known others; dates are read by layout.
_PAIR = {"Patient_ID": "bigint", "Health_Camp_ID": "bigint"}
_REGISTRATION = {**_PAIR, "Registration_Date": "string", **{f"Var{i}": "bigint" for i in range(1, 6)}}
TYPES = {
    "train": _REGISTRATION,
    "test": _REGISTRATION,
    "camps": {
        "Health_Camp_ID": "bigint",
        "Camp_Start_Date": "string",
        "Camp_End_Date": "string",
        "Category1": "string",
        "Category2": "string",
        "Category3": "bigint",
    },
    "patients": {
        "Patient_ID": "bigint",
        "Online_Follower": "bigint",
        "LinkedIn_Shared": "bigint",
        "Twitter_Shared": "bigint",
        "Facebook_Shared": "bigint",
        "First_Interaction": "string",
    },
    "first": {**_PAIR, "Donation": "double", "Health_Score": "double"},
    "second": {**_PAIR, "Health Score": "double"},
    "third": {**_PAIR, "Number_of_stall_visited": "bigint", "Last_Stall_Visited_Number": "bigint"},
}
ATTENDANCE = ("first", "second", "third")

#: Share of a file's records that may be rejected before the job fails.
MOST_REJECTED = 0.01

# The unnamed fifth column of the first attendance file, as different readers call it.
STRAY_COLUMNS = ("Unnamed: 4", "_c4")


def prefixed(tables: dict[str, DataFrame], v: Visits = Visits()) -> dict[str, DataFrame]:
    """Give every side table its prefix; the second attendance table also gets its score renamed."""
    second = tables["second"].withColumnRenamed("Health Score", "Health_Score")
    pair = [v.entity, v.group]
    return {
        "camps": prefix_columns(tables["camps"], "CD_", [v.group]),
        "patients": prefix_columns(tables["patients"], "PD_", [v.entity]),
        "first": prefix_columns(tables["first"], "F_", pair),
        "second": prefix_columns(second, "S_", pair),
        "third": prefix_columns(tables["third"], "T_", pair),
    }


def join_dimensions(
    df: DataFrame, camps: DataFrame, patients: DataFrame, v: Visits = Visits(), heavy: dict | None = None
) -> DataFrame:
    """Registration with its camp and its patient profile."""
    heavy = heavy or {}
    with_camp = left_join(df, camps, [v.group], heavy.get(v.group), v.row_id)
    return left_join(with_camp, patients, [v.entity], heavy.get(v.entity), v.row_id)


def join_attendance(
    df: DataFrame, tables: list[DataFrame], v: Visits = Visits(), heavy: HeavyKeys | None = None
) -> DataFrame:
    """Registration with the attendance tables; a repeated key on the right repeats the row."""
    pair = [v.entity, v.group]
    return reduce(lambda left, right: left_join(left, right, pair, heavy, v.row_id), tables, df)


def target() -> Column:
    """1 if a score was given in either format or at least one stall was visited, else 0."""
    attended = F.col(SCORE_1).isNotNull() | F.col(SCORE_2).isNotNull() | F.coalesce(F.col(STALLS) >= 1, F.lit(False))
    return F.when(attended, 1.0).otherwise(0.0)


def heavy_visit_keys(df: DataFrame, v: Visits = Visits(), **options) -> dict[str, HeavyKeys]:
    """Heavy entities, groups, time stamps and (entity, group) pairs, found in one pass."""
    found = find_heavy_keys(df, [v.entity], [v.group], [v.time], [v.entity, v.group], **options)
    return dict(zip((v.entity, v.group, v.time, "pair"), found))


def assemble(
    train: DataFrame,
    test: DataFrame,
    tables: dict[str, DataFrame],
    v: Visits = Visits(),
    heavy: dict[str, HeavyKeys] | None = None,
    unique_pairs: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The joined training table with its target, and the joined test table without attendance.

    A (entity, group) pair that stands several times in an attendance table repeats its registrations; row ids
    of both results are then spread so that every copy has its own (``operators.copies``). ``unique_pairs``
    says that there are no such pairs, and saves the look.
    """
    side = prefixed(tables, v)
    if heavy is None:
        keys = [v.entity, v.group, v.time]
        heavy = heavy_visit_keys(train.select(*keys).unionByName(test.select(*keys)), v)
    pair = [v.entity, v.group]
    attended = [side[name] for name in ATTENDANCE]
    most = [1] * len(attended) if unique_pairs else most_per_key(attended, pair)
    numbered = [number_duplicates(t, pair, f"_copy_{name}", n) for t, name, n in zip(attended, ATTENDANCE, most)]
    joined = join_dimensions(train, side["camps"], side["patients"], v, heavy)
    joined = join_attendance(joined, [n.df for n in numbered], v, heavy.get("pair"))
    joined = spread_ids(joined, v.row_id, numbered)
    joined_test = join_dimensions(wide_ids(test, v.row_id, numbered), side["camps"], side["patients"], v, heavy)
    return joined.withColumn("target", target()), joined_test


def after_train(train: DataFrame, test: DataFrame, v: Visits = Visits()) -> DataFrame:
    """The test table with its row ids, counted from 0, moved behind those of the training table."""
    offset = train.agg(F.coalesce(F.max(v.row_id) + 1, F.lit(0)).alias("n")).scalar()
    return test.withColumn(v.row_id, F.col(v.row_id) + offset)


def read_files(spark: SparkSession, folder: str, types: dict[str, dict[str, str]] | None = None) -> dict[str, Checked]:
    """The seven CSV files with declared types, each with its rejected records.

    ``types`` adds types of columns, by entry of ``FILES``, to those declared in ``TYPES``; other columns are text.
    """
    v = Visits()
    return {
        name: read_checked(
            spark,
            f"{folder}/{path}",
            {**TYPES[name], **(types or {}).get(name, {})},
            dates,
            v.row_id if numbered else None,
            required=[c for c in (v.entity, v.group) if c in TYPES[name]],
        )
        for name, (path, dates, numbered) in FILES.items()
    }


def assemble_files(
    spark: SparkSession,
    folder: str,
    target_folder: str,
    types: dict[str, dict[str, str]] | None = None,
    most_rejected: float = MOST_REJECTED,
) -> None:
    """Read the seven CSV files, assemble them, and write ``train`` and ``test`` as Parquet.

    Records that do not fit their declared types or date layouts are written to ``rejected`` (table, file, line,
    reason). If a file loses more than the share ``most_rejected`` of its records, the job fails after that.
    """
    v = Visits()
    checked = read_files(spark, folder, types)
    write_rejects(spark, checked, f"{target_folder}/rejected", most_rejected)
    frames = {name: c.rows for name, c in checked.items()}
    stray = [c for c in STRAY_COLUMNS if c in frames["first"].columns]
    frames["first"] = frames["first"].drop(*stray)
    train, test = assemble(frames.pop("train"), frames.pop("test"), frames, v)
    write_table(train, f"{target_folder}/train")
    stored = train.sparkSession.read.parquet(f"{target_folder}/train")
    write_table(after_train(stored, test, v), f"{target_folder}/test")
