"""Session settings and lineage cutting shared by the library, the tests and the bench."""

from __future__ import annotations

import os
from pathlib import Path
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def remove_intermediate(spark: SparkSession) -> None:
    """Delete what this session has written to the shared folder; results read from it are gone, too."""
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder is not None:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def build_session(cpus: int | str = "*", app: str = "visitlens", **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(cores),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables that the session names in ``spark.checkpoint.dir``.

    Where that is unset it is a folder below the session's warehouse, which all executors share, too.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or f"{warehouse}/_intermediate")
    return context.getCheckpointDir()


def on_workers(df: DataFrame) -> DataFrame:
    """``df``, with this package importable by Python workers of a local session.

    A cluster gets the package from --py-files or its installation, as any library.
    """
    context = df.sparkSession.sparkContext
    if context.master.startswith("local["):
        folder = Path(__file__).resolve().parent
        if not any(f.endswith(f"/{folder.name}") for f in context.listFiles):
            context.addFile(str(folder), recursive=True)
    return df


def cut_lineage(df: DataFrame, schema: StructType | None = None) -> DataFrame:
    """Write ``df`` to the shared folder once and go on from the written table.

    Later passes read only the columns they need, and a lost executor costs no more
    than reading its part again. ``schema`` reads it with user-defined types in place of their fields.
    """
    path = f"{shared_folder(df.sparkSession)}/table-{uuid4()}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema or df.schema).parquet(path)
