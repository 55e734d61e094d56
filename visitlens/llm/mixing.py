"""Mixing sources to target weights with weighted sampling without replacement.

Targets: sources in code point order (null last) weigh 5, 2, 1, repeating; they share
``share`` times all words by weight; none exceeds ``cap`` times its own words, and the excess is
shared again. A source's target is first met with complete epochs, all documents once each;
the rest goes to a prefix of the documents in the order of exponential keys -ln(u)/weight
(Efraimidis and Spirakis), where u depends on the document id alone and the weight is the
document's quality. The document at the end of the prefix gives only the words still missing,
so a source's taken words are its target, rounded.

Order and prefix sums run over stored ranges of (source, key), so one source may hold any
share of the rows.

Defined cases: a null text has no words; a source without words gets the target 0; null is a
source of its own; documents without a quality weigh 1; equal rows tie and share one result up
to order; an empty table gives an empty result. Other columns are ignored or, in ``mix_rows``, kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import packed, words
from visitlens.operators.slices import running_sums, store_sliced
from visitlens.session import cut_lineage

WEIGHTS = (5, 2, 1)


def uniform(doc_id: Column, seed: int) -> Column:
    """A number in (0, 1) made of 52 bits of the id's hash."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    bits = F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("bigint")
    return (bits + F.lit(0.5)) / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, cap: float) -> DataFrame:
    """``_src``, ``source_size``, ``target`` for each source of (source, size)."""
    sums = sizes.groupBy("source").agg(F.coalesce(F.sum("size"), F.lit(0)).alias("source_size"))
    ranked = running_sums(
        store_sliced(sums.withColumn("one", F.lit(1)), ["source"]), {"place": "one"}, ["source"]
    )
    table = F.array(*[F.lit(w) for w in weights])
    weighed = cut_lineage(
        ranked.select(
            F.col("source").alias("_src"),
            "source_size",
            F.get(table, (F.col("place") % len(weights)).cast("int")).alias("weight"),
            (F.col("source_size") * F.lit(cap)).alias("most"),
        )
    )
    level = water_level(weighed, share)
    return weighed.select("_src", "source_size", F.least(F.col("weight") * F.lit(level), "most").alias("target"))


def water_level(weighed: DataFrame, share: float) -> float:
    """Words per unit of weight: sources above their cap are set to it and the rest shared anew."""
    total, weight = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    if not total:
        return 0.0
    level, capped = total * share / weight, 0
    while True:
        full = weighed.where(F.col("most") <= F.col("weight") * F.lit(level))
        words_full, weight_full = full.agg(F.sum("most"), F.sum("weight")).first()
        if weight_full in (None, capped, weight):
            return level
        capped, level = weight_full, (total * share - words_full) / (weight - weight_full)


def mix(
    docs: DataFrame,
    quality: DataFrame | None = None,
    weights: Sequence[int] = WEIGHTS,
    share: float = 1.5,
    cap: float = 2.0,
    seed: int = 0,
) -> DataFrame:
    """doc_id, source, body (hash of the text), size, source_size, target, taken; one row per document.

    ``quality`` has one row per doc_id with a positive ``weight``.
    """
    sized = docs.select(
        "doc_id", "source", F.xxhash64("text").alias("body"), F.size(words(F.col("text"))).cast("long").alias("size")
    )
    if quality is not None:
        heavy = quality.select(F.col("doc_id").alias("_id"), F.col("weight").alias("_weight"))
        sized = sized.join(heavy, F.col("doc_id") == F.col("_id"), "left").drop("_id")
    else:
        sized = sized.withColumn("_weight", F.lit(1.0))
    key = -F.log(uniform(F.col("doc_id"), seed)) / F.coalesce("_weight", F.lit(1.0))
    order = ["key", "doc_id", "body"]
    stored = store_sliced(sized.select("doc_id", "source", "body", "size", key.alias("key")), ["source", *order])
    targets = source_targets(stored, weights, share, cap)
    placed = running_sums(stored, {"before": "size"}, order, ["source"])
    out = placed.join(targets, F.col("source").eqNullSafe(F.col("_src")), "left")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    wanted = F.floor(F.col("target") - epochs * F.col("source_size") + F.lit(0.5)).cast("long")
    part = F.least(F.greatest(wanted - F.col("before"), F.lit(0)), F.col("size"))
    taken = (epochs * F.col("size") + part).cast("long").alias("taken")
    return out.select("doc_id", "source", "body", "size", "source_size", "target", taken)


def quality_weights(labels: DataFrame, good: float = 2.0, bad: float = 0.5) -> DataFrame:
    """Sampling weights of labelled documents, one row per id; of several labels the best counts."""
    best = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("best"))
    weight = F.when(F.col("best") == 1, good).when(F.col("best") == 0, bad).otherwise(1.0)
    return best.select("doc_id", weight.alias("weight"))


def mix_rows(docs: DataFrame, quality: DataFrame | None = None, **options) -> DataFrame:
    """The documents of the mix, each as often as it is taken; a document taken in part comes whole."""
    copies = F.when(F.col("taken") > 0, F.ceil(F.col("taken") / F.col("size"))).otherwise(0)
    # equal rows share one entry: each of them gets the mean of their copies, rounded up
    each = F.ceil(F.sum(copies) / F.count(F.lit(1))).cast("int").alias("_copies")
    counts = mix(docs, quality, **options).groupBy("doc_id", "source", "body").agg(each).where(F.col("_copies") > 0)
    whole = packed(docs, "doc_id", "source", F.xxhash64("text").alias("body"))
    on = (
        whole["doc_id"].eqNullSafe(counts["doc_id"])
        & whole["source"].eqNullSafe(counts["source"])
        & (whole["body"] == counts["body"])
    )
    repeated = whole.join(counts, on).select("doc", F.explode(F.sequence(F.lit(1), "_copies")).alias("copy"))
    return repeated.select("doc.*")


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    out = mix(docs, quality_weights(labels))
    return out.select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
WITH best AS (SELECT doc_id, max(quality) AS q FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
sized AS (
  SELECT d.doc_id, d.source, coalesce(len(regexp_extract_all(d.text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         -ln((('0x' || substr(sha256('0:' || coalesce(d.doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5::DOUBLE)
             / 4503599627370496.0::DOUBLE)
           / (CASE b.q WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 ELSE 1.0 END)::DOUBLE AS key
  FROM documents d LEFT JOIN best b ON d.doc_id = b.doc_id),
sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight,
         2.0::DOUBLE * source_size AS most
  FROM sums),
levels AS (
  SELECT *, row_number() OVER w0 AS place, coalesce(sum(most) OVER w, 0) AS full_words, coalesce(sum(weight) OVER w, 0) AS full_weight,
         sum(weight) OVER () AS weight_all, sum(source_size) OVER () AS words_all
  FROM weighed
  WINDOW w AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         w0 AS (ORDER BY most / weight, source NULLS LAST)),
level AS (
  SELECT arg_min((1.5::DOUBLE * words_all - full_words) / (weight_all - full_weight), place) AS level
  FROM levels WHERE (1.5::DOUBLE * words_all - full_words) / (weight_all - full_weight) <= most / weight),
targets AS (
  SELECT source, source_size, least(weight * coalesce(level, 0), most)::DOUBLE AS target FROM weighed, level),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS epochs
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (epochs * size + least(greatest(floor(target - epochs * source_size + 0.5) - before, 0), size))::BIGINT AS taken
FROM placed
"""
