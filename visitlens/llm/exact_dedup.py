"""Exact deduplication with state on disk.

Fingerprints (digest, document id, content locator) are written once and then read as a stream.
A streaming aggregation keyed by digest holds, in RocksDB and without expiry, the
number of documents and the one that stays (largest id, then last locator). A later run
with the same ``state`` folder goes on from there: its documents are held against all earlier ones, whose
fingerprints lie beside the state. The state is read back as a table. On
hits the whole texts of the document that stays and of the others are compared byte by byte, where the one that stays
is of an earlier run by reading it again from its locator (a row of a Parquet file that must still be there);
texts that differ in spite of equal digests are grouped by their bytes, with those of their own run.
A run returns rows of its own documents; decisions of earlier runs are not revised.

Texts are equal when identical after lower-casing A-Z.

Defined cases: a null text is empty; a null doc_id is the smallest; of rows with equal
doc_id and text the last in the input stays, so exactly one row of a group does; an empty
table gives an empty result. Other columns are ignored or, in ``keep_one_each``, kept.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm.common import located, lower_ascii, sha256_hex
from visitlens.session import cut_lineage, shared_folder

STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # else each of many small stores reserves megabytes of disk
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    # all stores of an executor share this much memory
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "4",
    # stores of ended streams are closed soon
    "spark.sql.streaming.stateStore.maintenanceInterval": "10s",
}
PLACE = ["_file", "_row"]


def normalised(text: Column) -> Column:
    return lower_ascii(F.coalesce(text, F.lit("")))


def fingerprints(docs: DataFrame, digest: Callable[[Column], Column] = sha256_hex) -> DataFrame:
    """doc_id, digest and locator of located documents."""
    return docs.select("doc_id", digest(normalised(F.col("text"))).alias("digest"), *PLACE)


@contextmanager
def _disk_backed(spark: SparkSession):
    before = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def ingest(spark: SparkSession, prints: DataFrame, folder: str, state: str, batch: int = 16 << 30) -> None:
    """Feed the fingerprint files of ``folder`` that are new to the state into it."""
    stream = spark.readStream.schema(prints.schema).option("maxBytesPerTrigger", str(batch)).parquet(folder)
    groups = stream.groupBy("digest").agg(
        F.max(F.struct("doc_id", *PLACE)).alias("keep"), F.count(F.lit(1)).alias("group_size")
    )
    with _disk_backed(spark):
        query = (
            groups.writeStream.outputMode("update").format("noop")
            .option("checkpointLocation", state).trigger(availableNow=True).start()
        )
        query.awaitTermination()


def held_groups(spark: SparkSession, state: str) -> DataFrame:
    """digest, keep (doc_id and locator) and group_size as the state holds them."""
    with _disk_backed(spark):
        held = spark.read.format("statestore").load(state)
    keep, size = (F.col(f"value.`{f.name}`") for f in held.schema["value"].dataType.fields)
    return held.select(F.col("key.digest"), keep.alias("keep"), size.alias("group_size"))


def decide(docs: DataFrame, digest: Callable[[Column], Column] = sha256_hex, state: str | None = None) -> DataFrame:
    """One row per document: doc_id, locator, digest, keep_id, group_size, kept.

    Documents that carry their locators (``located``) already are taken as they are.
    """
    spark = docs.sparkSession
    docs = docs if set(PLACE) <= set(docs.columns) else located(docs, "doc_id", "text")
    state, run = state or f"{shared_folder(spark)}/state-{uuid4()}", str(uuid4())
    folder = f"{state.rstrip('/')}-prints"
    fresh = fingerprints(docs, digest).withColumn("_run", F.lit(run))
    fresh.write.mode("append").parquet(folder)
    prints = spark.read.schema(fresh.schema).parquet(folder).where(F.col("_run") == run).drop("_run")
    if prints.isEmpty():
        groups = prints.select("digest", F.struct("doc_id", *PLACE).alias("keep"), F.lit(1).cast("long").alias("group_size"))
    else:
        ingest(spark, fresh, folder, state)
        groups = held_groups(spark, state)
    groups = groups.withColumnRenamed("digest", "_digest")
    rows = prints.join(groups, F.col("digest") == F.col("_digest")).drop("_digest")
    rows = cut_lineage(rows.withColumn("kept", F.struct("doc_id", *PLACE).eqNullSafe(F.col("keep"))))
    differing = _differing(docs, rows)
    if not differing.isEmpty():
        rows = _regroup(rows, differing)
    return rows.select("doc_id", *PLACE, "digest", F.col("keep.doc_id").alias("keep_id"), "group_size", "kept")


def _differing(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Locator, digest and text of hits whose bytes differ from the document that stays; stored."""
    hits = rows.where(F.col("group_size") > 1).select(
        *[F.col(c).alias(f"_hit{c}") for c in PLACE], "digest", "keep", "kept"
    )
    texts = docs.select("doc_id", *PLACE, normalised(F.col("text")).alias("body"))
    found = cut_lineage(texts.join(hits, (F.col("_file") == F.col("_hit_file")) & (F.col("_row") == F.col("_hit_row"))))
    stays = found.where("kept").select(*[F.col(c).alias(f"_keep{c}") for c in PLACE], F.col("body").alias("_kept_body"))
    earlier = rows.select("keep.*").join(rows.where("kept").select(*PLACE), PLACE, "left_anti")
    if files := [r["_file"] for r in earlier.select("_file").distinct().collect()]:  # names of files, as a scan lists them
        again = located(docs.sparkSession.read.parquet(*files), "text").withColumnsRenamed({c: f"_keep{c}" for c in PLACE})
        wanted = earlier.distinct().select(*[F.col(c).alias(f"_wanted{c}") for c in PLACE])
        on = (F.col("_keep_file") == F.col("_wanted_file")) & (F.col("_keep_row") == F.col("_wanted_row"))
        again = again.join(wanted, on, "left_semi").withColumn("_kept_body", normalised(F.col("text")))
        stays = stays.unionByName(again.select(*stays.columns))
    others = found.where(~F.col("kept"))
    on = (F.col("keep._file") == F.col("_keep_file")) & (F.col("keep._row") == F.col("_keep_row"))
    differs = others.join(stays, on).where(F.col("body") != F.col("_kept_body"))
    return cut_lineage(differs.select("doc_id", *PLACE, "digest", "body"))


def _regroup(rows: DataFrame, differing: DataFrame) -> DataFrame:
    """Groups by bytes for texts that share a digest with another text."""
    own = differing.groupBy("digest", "body").agg(
        F.max(F.struct("doc_id", *PLACE)).alias("keep"), F.count(F.lit(1)).alias("group_size")
    )
    apart = differing.join(own, ["digest", "body"]).select("doc_id", "digest", *PLACE, "keep", "group_size")
    apart = apart.withColumn("kept", F.struct("doc_id", *PLACE).eqNullSafe(F.col("keep")))
    fewer = differing.groupBy("digest").agg(F.count(F.lit(1)).alias("_apart"))
    rest = rows.join(differing.select(*PLACE), PLACE, "left_anti").join(fewer, "digest", "left")
    rest = rest.withColumn("group_size", F.col("group_size") - F.coalesce("_apart", F.lit(0)))
    return rest.select(apart.columns).union(apart)


def keep_one_each(docs: DataFrame) -> DataFrame:
    """The documents without copies."""
    docs = located(docs, "doc_id", "text", whole=True)
    kept = decide(docs.select("doc_id", "text", *PLACE)).where("kept").select(*PLACE)
    return docs.join(kept, PLACE, "left_semi").select("doc.*")


def digest_rows(docs: DataFrame) -> DataFrame:
    return decide(located(docs, "doc_id", "text")).select(
        "doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), "kept", F.col("digest").alias("text_sha256")
    )


SQL = """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
           FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(body) AS text_sha256
FROM n WINDOW w AS (PARTITION BY body)
"""
