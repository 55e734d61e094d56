"""Lines that many documents share are removed from all documents but one.

Keys of lines are hashed to 128 bits, cut into ranges by (hash, document) with a secondary
sort by document (largest first) and position, and stored. Range borders fall between
documents, so a hash that a third of all documents holds spreads over many ranges. A scan of each
range in its order sees a hash's first occurrence, which stays, and the first of every further document that holds
it, which counts; hashes that go on across borders (at most two per range) get their counts and first
occurrence from a table of the borders. No line is joined by its hash. What comes back per document is a
run-length encoded bitmap of the lines that stay, not text.

Defined cases: a null or empty text is one empty line. Rows with equal doc_id count as one
document when holders are counted; a null doc_id counts as the smallest id. Keys shorter than
``min_chars`` are never touched, so empty texts keep their line. Equal rows are treated alike
and all come back. Other columns of the input, whatever their names, are ignored or, in
``drop_lines``, kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlens.llm.common import SPACES, let, lower_ascii, packed, sha256_hex
from visitlens.session import cut_lineage

NO_ID = -(1 << 63)


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_table(docs: DataFrame, min_chars: int) -> DataFrame:
    """Hash, document and position of every line whose key is long enough, in range order, stored."""
    lines = docs.select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"),
        F.xxhash64("text").alias("body"),
        F.posexplode(split_lines(F.col("text"))).alias("pos", "line"),
    )
    keyed = lines.withColumn("key", F.btrim("line", F.lit(SPACES))).where(F.char_length("key") >= min_chars)
    keyed = keyed.withColumn("key", lower_ascii(F.col("key")))
    hashed = keyed.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), F.col("key")).alias("h2"), "doc", "body", "pos")
    order = [F.col("h1"), F.col("h2"), F.col("doc").desc()]
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = hashed.repartitionByRange(partitions, *order).sortWithinPartitions(*order, "body", "pos")
    return cut_lineage(ranged.withColumn("slice", F.spark_partition_id()))


def border_keys(lines: DataFrame) -> DataFrame:
    """(h1, h2, all_docs, all_keeper) of the first and last hash of every range, over all ranges; two rows a range at most."""
    ends = lines.groupBy("slice").agg(F.min(F.struct("h1", "h2")).alias("lo"), F.max(F.struct("h1", "h2")).alias("hi"))
    edges = ends.select(F.col("slice").alias("_slice"), F.explode(F.array_distinct(F.array("lo", "hi"))).alias("_edge"))
    at_edge = (F.col("slice") == F.col("_slice")) & (F.struct("h1", "h2") == F.col("_edge"))
    held = lines.join(F.broadcast(edges), at_edge, "left_semi").groupBy("slice", "h1", "h2", "doc").agg(F.lit(1).alias("one"))
    # ranges do not share (hash, document) pairs, so their counts add up
    return held.groupBy(F.col("h1").alias("_h1"), F.col("h2").alias("_h2")).agg(
        F.sum("one").alias("all_docs"), F.max("doc").alias("all_keeper")
    )


def repeated_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """The lines that go: of hashes that ``min_docs`` documents hold, all but those of the first document in order."""
    in_hash = Window.partitionBy("slice", "h1", "h2")
    in_order = in_hash.orderBy(F.col("doc").desc(), "body", "pos")
    before = F.lag("doc").over(in_order)
    scanned = lines.withColumn("first", F.when(before.isNull() | (before != F.col("doc")), 1).otherwise(0))
    scanned = scanned.withColumns({"docs": F.sum("first").over(in_hash), "keeper": F.max("doc").over(in_hash)})
    borders = F.broadcast(border_keys(lines))
    whole = scanned.join(borders, (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")), "left")
    return whole.where(
        (F.coalesce("all_docs", "docs") >= min_docs) & (F.col("doc") != F.coalesce("all_keeper", "keeper"))
    ).select("doc", "body", "pos")


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``doc``, ``body`` (hash of the text) and the positions that go, for documents that lose lines."""
    gone = repeated_lines(line_table(docs, min_chars), min_docs)
    per_doc = gone.groupBy("doc", "body").agg(F.sort_array(F.collect_set("pos")).alias("gone"))
    return per_doc.withColumn("runs", kept_runs("gone")).select("doc", "body", "runs")


def kept_runs(gone: str) -> Column:
    """The bitmap of lines that stay, as (start, length) runs; the last run is open (length null)."""
    starts = F.concat(F.array(F.lit(0)), F.transform(F.col(gone), lambda p: p + 1))
    ends = F.concat(F.col(gone), F.array(F.lit(None).cast("int")))
    runs = F.arrays_zip(starts.alias("start"), ends.alias("stop"))
    runs = F.transform(
        runs, lambda r: F.struct(r["start"].alias("start"), (r["stop"] - r["start"]).alias("length"))
    )
    return F.filter(runs, lambda r: r["length"].isNull() | (r["length"] > 0))


def drop_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """The documents as structs ``doc``, with n_lines (before), n_kept (lines that stay) and kept_text."""
    bitmaps = keep_bitmaps(docs, min_chars, min_docs)
    bitmaps = bitmaps.select(F.col("doc").alias("losing"), "body", "runs")
    on = (F.coalesce("doc_id", F.lit(NO_ID)) == F.col("losing")) & (F.col("own") == F.col("body"))
    out = packed(docs, "doc_id", F.xxhash64("text").alias("own")).join(bitmaps, on, "left")

    def stay(lines: Column) -> Column:
        runs = F.transform("runs", lambda r: F.slice(lines, r["start"] + 1, F.coalesce(r["length"], F.size(lines))))
        left = F.when(F.col("runs").isNull(), lines).otherwise(F.flatten(runs))
        return let(left, lambda k: F.struct(F.size(lines), F.size(k), F.array_join(k, "\n")))

    out = out.select("doc", let(split_lines(F.col("doc.text")), stay).alias("done"))
    names = dict(zip(("n_lines", "n_kept", "kept_text"), ("done.col1", "done.col2", "done.col3")))
    return out.select("doc", *[F.col(at).alias(name) for name, at in names.items()])


def digest(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    out = drop_lines(docs.select("doc_id", "text"), min_chars, min_docs)
    return out.select(
        "doc.doc_id",
        F.col("n_lines").cast("long").alias("n_lines"),
        (F.col("n_lines") - F.col("n_kept")).cast("long").alias("n_dropped"),
        sha256_hex(F.col("kept_text")).alias("kept_sha256"),
    )


SQL = r"""
WITH lines AS (
  SELECT doc_id, coalesce(text, '') AS text, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
flagged AS (
  SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.keeper AS gone FROM keyed k LEFT JOIN shared s ON k.key = s.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM flagged GROUP BY doc_id
"""
