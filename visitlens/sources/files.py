"""CSV and Parquet sources and sinks, row numbering at ingest, prediction folders."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Date layouts tried in turn when a CSV column is read as a date.
DATE_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "dd-MMM-yy")

PREDICTION_SCHEMA = "Patient_ID bigint, Health_Camp_ID bigint, Outcome double"


def read_csv(
    spark: SparkSession,
    path: str,
    dates: Sequence[str] = (),
    schema: T.StructType | str | None = None,
    row_id: str | None = None,
    formats: Sequence[str] = DATE_FORMATS,
) -> DataFrame:
    """Read a CSV with a header; ``dates`` become time stamps without zone.

    ``schema`` declares the types (date columns as string); without it all columns are text. Types
    are never inferred from the data. ``row_id`` names a column that numbers the rows in file order.
    ``checked.read_checked`` sets records that do not fit apart.
    """
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader
    df = reader.csv(path)
    if row_id is not None:
        df = number_file_rows(df, row_id)
    return parse_dates(df, dates, formats)


def parse_dates(df: DataFrame, columns: Sequence[str], formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """First layout that fits wins, read without a zone; an empty text is null, one that fits none fails the job."""
    parsed = {}
    for c in columns:
        kind = df.schema[c].dataType
        if isinstance(kind, T.StringType):
            unknown = F.raise_error(F.concat(F.lit(f"no date layout fits {c}: "), F.col(c))).cast("timestamp_ntz")
            found = F.coalesce(*[without_zone(c, f) for f in formats])
            parsed[c] = F.when(found.isNotNull() | (F.trim(c) == "") | F.col(c).isNull(), found).otherwise(unknown)
        else:
            parsed[c] = F.col(c).cast("timestamp_ntz")
    return df.withColumns(parsed) if parsed else df


def without_zone(column: str, layout: str) -> Column:
    """The text read in a layout as a time stamp without zone; null where it does not fit."""
    fields = F.from_csv(F.col(column), F.lit("t timestamp_ntz"), {"timestampNTZFormat": layout, "sep": "\x01"})
    return fields["t"]


def number_file_rows(df: DataFrame, name: str = "row_id", file: str | None = None) -> DataFrame:
    """Number the rows of a file scan from 0 in file order; ``file`` adds the name of each row's file.

    A file block is read front to back by one task, so the running id orders the rows
    inside a block whatever else the task reads. Blocks are bounded in size, and only
    one row per block enters the offsets.
    """
    block = df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_seen"),
    )
    sizes = block.groupBy("_file", "_start").agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_file", "_start")) - F.col("_rows")
    offsets = sizes.select("_file", "_start", before.alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_file", "_start").orderBy("_seen")) - 1
    numbered = block.withColumn("_inside", inside).join(offsets, ["_file", "_start"])
    named = [F.element_at(F.split("_file", "/"), -1).alias(file)] if file else []
    return numbered.select((F.col("_before") + F.col("_inside")).alias(name), *df.columns, *named)


def write_table(
    df: DataFrame, path: str, kind: str = "parquet", partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    """Overwrite ``path`` with the table; CSV gets a header and no index column."""
    writer = df.write.mode(mode).format(kind)
    if kind == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def auc_digits(auc: float) -> str:
    """The digits behind the decimal point, as carried in prediction file names."""
    return str(auc).split(".")[1]


def write_predictions(
    predictions: DataFrame, metrics: DataFrame, folder: str, run_id: str, model: str
) -> None:
    """Store one model's predictions and its metrics row under (run_id, model)."""
    tagged = {"run_id": F.lit(run_id), "model": F.lit(model)}
    for name, df in (("predictions", predictions), ("metrics", metrics)):
        target = f"{folder}/{name}/run_id={run_id}/model={model}"
        write_table(df.drop(*tagged), target)


MANIFEST = "model string, n_rows bigint"


def open_run(spark: SparkSession, folder: str, run_id: str) -> None:
    """Say that a run has begun: until ``close_run`` its predictions are refused by readers."""
    write_table(spark.createDataFrame([], MANIFEST), _manifest(folder, run_id))


def close_run(spark: SparkSession, folder: str, run_id: str, models: Sequence[str]) -> None:
    """Write the run's manifest, the models that belong to it with their rows; the last thing a run writes.

    Predictions that an earlier run of the same name has left are not listed and so no longer read.
    """
    wanted = spark.createDataFrame([(m,) for m in models], "model string")
    found = _stored_predictions(spark, folder).where(F.col("run_id") == run_id).groupBy("model").agg(F.count(F.lit(1)).alias("n_rows"))
    listed = wanted.join(found, "model", "left").fillna(0, ["n_rows"])
    if absent := [r["model"] for r in listed.where(F.col("n_rows") == 0).collect()]:
        raise ValueError(f"run {run_id} has no predictions of {', '.join(sorted(absent))}")
    write_table(listed, _manifest(folder, run_id))


def _manifest(folder: str, run_id: str) -> str:
    return f"{folder}/manifest/run_id={run_id}"


def _stored_predictions(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/predictions").withColumns({c: F.col(c).cast("string") for c in ("run_id", "model")})


def read_predictions(spark: SparkSession, folder: str, run_id: str | None = None) -> DataFrame:
    """The predictions that manifests list, of one run (or of every finished run).

    A run without a finished manifest, or with other rows than its manifest says, is refused.
    """
    try:
        manifest = spark.read.parquet(f"{folder}/manifest").withColumn("run_id", F.col("run_id").cast("string"))
    except AnalysisException as none:
        raise ValueError(f"{folder} has no finished run") from none
    stored = _stored_predictions(spark, folder)
    if run_id is not None:
        manifest, stored = (df.where(F.col("run_id") == run_id) for df in (manifest, stored))
    listed = {(r["run_id"], r["model"]): r["n_rows"] for r in manifest.collect()}
    if not listed:
        raise ValueError(f"run {run_id or '(any)'} is not finished")
    found = {(r["run_id"], r["model"]): r["n"] for r in stored.groupBy("run_id", "model").agg(F.count(F.lit(1)).alias("n")).collect()}
    if wrong := sorted(key for key, n in listed.items() if found.get(key) != n):
        raise ValueError(f"predictions differ from the manifest: {wrong}")
    return stored.join(F.broadcast(manifest.select("run_id", "model")), ["run_id", "model"], "left_semi")


def file_headers(spark: SparkSession, folder: str, glob: str) -> dict[tuple[str, ...], list[str]]:
    """The files of each header, read from the first lines in one job."""
    lines = spark.read.option("pathGlobFilter", glob).text(folder)
    placed = lines.select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("seen"),
    )
    first = placed.where(F.col("start") == 0).groupBy("path").agg(F.min_by("value", "seen").alias("header"))
    layouts = first.groupBy("header").agg(F.array_sort(F.collect_list("path")).alias("paths")).orderBy("header").collect()
    return {tuple(next(csv.reader([r["header"].lstrip("\ufeff")]), [])): r["paths"] for r in layouts}


def read_prediction_files(
    spark: SparkSession, folder: str, name_part: str = "model", schema: str = PREDICTION_SCHEMA
) -> DataFrame:
    """Every CSV in ``folder`` whose name contains ``name_part``, with its model name and AUC digits.

    Files are grouped by header and each layout is scanned once with its own column order; the layouts are
    stacked by name. Columns that ``schema`` does not name are left out; a layout that lacks one fails the job.
    """
    named = T.StructType.fromDDL(schema)
    kinds = {f.name: f.dataType for f in named}
    parts = F.split(F.regexp_replace(F.col("_metadata.file_name"), r"\.csv$", ""), "_", 2)
    scans = []
    for header, paths in file_headers(spark, folder, f"*{name_part}*").items():
        if lacking := [c for c in named.names if c not in header]:
            raise ValueError(f"no column {', '.join(lacking)} in {', '.join(paths)}")
        layout = T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in header])
        scan = spark.read.option("header", True).option("enforceSchema", False).schema(layout).csv(paths)
        scans.append(scan.select(*named.names, parts[0].alias("auc_digits"), parts[1].alias("model")))
    if not scans:
        raise ValueError(f"no file in {folder} has {name_part} in its name")
    return reduce(DataFrame.unionByName, scans)
