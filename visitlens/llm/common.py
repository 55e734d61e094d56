"""What the operators of this subpackage share."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from visitlens.session import cut_lineage
from visitlens.session import on_workers as on_workers

#: Separators of words and characters stripped from lines: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
#: What may be broadcast, in rows of some 40 to 100 bytes.
SMALL_ROWS = 100_000
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def packed(df: DataFrame, *columns: str | Column) -> DataFrame:
    """The given columns, and all columns as a struct ``doc``, so that no other name can clash."""
    return df.select(*columns, F.struct("*").alias("doc"))


def located(df: DataFrame, *columns: str, whole: bool = False) -> DataFrame:
    """The named columns with ``_file`` and ``_row``, where each row's content is found again.

    ``whole`` adds all columns as the struct ``doc``. A frame that does not come straight from files
    is stored first.
    """
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    wanted = [*columns, *([F.struct("*").alias("doc")] if whole else []), *place]
    try:
        return df.select(*wanted)
    except AnalysisException:
        return cut_lineage(df).select(*wanted)


def stored(df: DataFrame) -> tuple[DataFrame, int]:
    """``df`` written once, and its rows, counted while it is written."""
    seen = Observation()
    written = cut_lineage(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return written, seen.get["n"]


def if_small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df``, for broadcast if it has no more than SMALL_ROWS of its narrow rows; else for Spark to shuffle.

    ``rows`` is their number where it is known.
    """
    rows = df.limit(SMALL_ROWS + 1).count() if rows is None else rows
    return F.broadcast(df) if rows <= SMALL_ROWS else df


def words(text: Column) -> Column:
    """The words of a text; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character left alone."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def sha256_hex(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it.

    A column that a lambda refers to may be inlined and computed anew for every element; the
    variable of a lambda is not.
    """
    return F.get(F.transform(F.array(value), body), 0)

