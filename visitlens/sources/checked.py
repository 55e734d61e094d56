"""CSV files read with declared types, with a channel for the records that do not fit.

The header of a file gives the order of its columns, a declaration their types; nothing is inferred from
the data. A record with too few or too many fields, with a value that is not of its declared type, or with a
date that fits no layout is set apart with its text and the reason, and counted; the others go on.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlens.session import cut_lineage
from visitlens.sources.files import DATE_FORMATS, number_file_rows, without_zone, write_table

RECORD, FILE, REASON = "_record", "_file", "_reason"
REJECTED = "file string, record string, reason string"


@dataclass(frozen=True)
class Checked:
    """The rows that fit, the records that do not (file, record, reason), and how many there are of either."""

    rows: DataFrame
    rejects: DataFrame
    n_rows: int
    n_rejected: int

    @property
    def share(self) -> float:
        return self.n_rejected / max(1, self.n_rows + self.n_rejected)


def declared_schema(header: Sequence[str], types: dict[str, str], other: str = "string") -> T.StructType:
    """The columns of a header in their order, with their declared types."""
    kinds = {name: T.StructType.fromDDL(f"x {types.get(name, other)}")["x"].dataType for name in header}
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


def read_checked(
    spark: SparkSession,
    path: str,
    types: dict[str, str],
    dates: Sequence[str] = (),
    row_id: str | None = None,
    formats: Sequence[str] = DATE_FORMATS,
    required: Sequence[str] = (),
) -> Checked:
    """Read one CSV layout once; ``dates`` become time stamps without zone.

    A header without one of the ``required`` columns or dates fails at once. ``row_id`` numbers all records in file order, so
    the ids of rejected records stay unused. The checked records are stored, since rows and rejects both read them.
    """
    header = spark.read.option("header", True).csv(path).columns
    if missing := sorted({*required, *dates} - set(header)):
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    schema = declared_schema(header, {**types, **dict.fromkeys(dates, "string")})
    reader = spark.read.option("header", True).option("enforceSchema", True).option("mode", "PERMISSIVE")
    reader = reader.option("columnNameOfCorruptRecord", RECORD).schema(schema.add(RECORD, "string"))
    scan = reader.csv(path)
    raw = number_file_rows(scan, row_id, FILE) if row_id is not None else scan.withColumn(FILE, F.col("_metadata.file_name"))
    parsed = {c: F.coalesce(*[without_zone(c, f) for f in formats]) for c in dates}
    unread = {c: parsed[c].isNull() & (F.trim(c) != "") for c in dates}
    reasons: list[Column] = [F.when(F.col(RECORD).isNotNull(), F.lit("fields or types"))]
    reasons += [F.when(unread[c], F.lit(f"date of {c}")) for c in dates]
    fields = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in header]
    whole = F.coalesce(F.col(RECORD), F.concat_ws(",", *fields))
    checked = cut_lineage(raw.withColumns({REASON: F.coalesce(*reasons), RECORD: whole, **{f"_date_{i}": parsed[c] for i, c in enumerate(dates)}}))
    made = {c: F.col(f"_date_{i}") for i, c in enumerate(dates)}
    columns = [*([row_id] if row_id is not None else []), *header]
    rows = checked.where(F.col(REASON).isNull()).select(*[made[c].alias(c) if c in made else F.col(f"`{c}`") for c in columns])
    rejects = checked.where(F.col(REASON).isNotNull())
    n_rejected = rejects.count()
    named = rejects.select(F.col(FILE).alias("file"), F.col(RECORD).alias("record"), F.col(REASON).alias("reason"))
    return Checked(rows, named, checked.count() - n_rejected, n_rejected)


def write_rejects(spark: SparkSession, checked: dict[str, Checked], path: str, most: float) -> None:
    """Write the rejected records of all tables, then fail if a table lost more than the share ``most``."""
    tables = [c.rejects.withColumn("table", F.lit(name)) for name, c in checked.items() if c.n_rejected]
    nothing = spark.createDataFrame([], f"{REJECTED}, table string")
    write_table(reduce(DataFrame.unionByName, tables, nothing), path)
    lost = {name: c.n_rejected for name, c in checked.items() if c.share > most}
    if lost:
        raise ValueError(f"too many rejected records: {lost}; see {path}")
