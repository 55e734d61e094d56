"""Language identification by the nearest of several centroids per language.

A text becomes the counts of its character 1- to 3-grams (lower case, everything but letters as
a space), hashed into ``DIMENSION`` features, damped by log, weighted by inverse document
frequency over all training texts and scaled to length 1. Each language's vectors are clustered
into up to ``clusters`` centroids, from at most ``SAMPLE_PER_LANGUAGE`` training texts chosen by
hash (the documented bound of the fit). A text gets the language of the centroid with the
largest cosine. It is rejected if that cosine is below the language's bound for texts of its length: ``slack``
times the cosine that all but the share ``quantile`` of the sampled texts of like length (half to
twice as many grams, more where fewer than ``LIKE`` are known) reach, each measured against centroids
without itself. One odd training text so cannot open a language to everything. The bound is at least ``LEAST``, or less
for texts of fewer than ``FULL_GRAMS`` grams, whose cosines are small by nature, with the square root of their
number. Rejection is a column of its own.

Only ``text`` and ``lang`` of training rows are learned from, only ``text`` decides.

Defined cases: a text that is null or without letters is ``und`` with score 0 and rejected; so
is every text if no language was learned. Rows with a null lang are not learned from. Equal rows
are treated alike. Texts of any length are read whole. Other columns are ignored or, in
``identify``, kept inside the struct.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlens.llm.common import if_small, on_workers, packed, remainder

DIMENSION = 1 << 13
BLOCK = 256  # texts that are compared with the centroids at once
SAMPLE_PER_LANGUAGE = 1_000
FULL_GRAMS = 600
LIKE = 50
FEW = 5  # texts of a language from which its bounds are learned
LEAST = 0.3
LENGTHS = 32  # classes of length, by the power of two of the number of grams
UNKNOWN = "und"
_MIX = (np.uint32(2654435761), np.uint32(2246822519), np.uint32(3266489917))


def _letters() -> np.ndarray:
    """For each code point of the basic plane: itself if it is a letter, else a space."""
    return np.array([c if chr(c).isalpha() else 32 for c in range(1 << 16)], dtype=np.uint32)


_TABLE: list[np.ndarray] = []


def code_points(text: str) -> np.ndarray:
    """Lower-case letters of a text; everything else is a space."""
    if not _TABLE:
        _TABLE.append(_letters())
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    if len(points) and points.max() >= 1 << 16:
        high = points >= 1 << 16
        points = points.copy()
        points[high] = [c if chr(c).isalpha() else 32 for c in points[high]]
        low = ~high
        points[low] = _TABLE[0][points[low]]
        return points
    return _TABLE[0][points]


def gram_counts(text: str | None) -> np.ndarray | None:
    """Counts of hashed 1- to 3-grams, or None for a text without letters."""
    points = code_points(text or "")
    if not len(points) or not (points != 32).any():
        return None
    space = np.uint32([32])
    points = np.concatenate([space, points, space])
    one = points * _MIX[0]
    two = (one[:-1] ^ (one[:-1] >> np.uint32(15))) * _MIX[1] + points[1:]
    three = (two[:-1] ^ (two[:-1] >> np.uint32(13))) * _MIX[2] + points[2:]
    counts = np.zeros(DIMENSION)
    for k, hashed in enumerate((one, two * _MIX[0], three * _MIX[0])):
        counts += np.bincount((hashed ^ np.uint32(k * 40503)) >> np.uint32(19), minlength=DIMENSION)
    return counts


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Damped, weighted rows of length 1."""
    rows = np.log1p(counts).astype(np.float32) * idf
    return rows / np.maximum(np.linalg.norm(rows, axis=-1, keepdims=True), 1e-9)


def weighed_texts(texts: Sequence[str | None], idf: np.ndarray) -> tuple[np.ndarray, list[int], np.ndarray]:
    """Weighed rows of the texts with letters, the places of these texts, and their numbers of grams.

    Counts are weighed text by text, so that a text takes no more memory than its row.
    """
    rows, places, grams = np.empty((len(texts), DIMENSION), np.float32), [], []
    for i, text in enumerate(texts):
        counts = gram_counts(text)
        if counts is not None:
            rows[len(places)] = weigh(counts, idf)
            places.append(i)
            grams.append(float(counts.sum()))
    return rows[: len(places)], places, np.array(grams)


def sum_of(rows: np.ndarray, members: np.ndarray) -> np.ndarray:
    """Sum of some rows in their order, without a copy of them."""
    total = np.zeros(rows.shape[1], rows.dtype)
    for i in members:
        total += rows[i]
    return total


def length_class(grams: np.ndarray | float) -> np.ndarray | int:
    classes = np.minimum(np.log2(np.maximum(grams, 1)), LENGTHS - 1).astype(np.int64)
    return classes if np.ndim(grams) else int(classes)


def cosines_without_self(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Each row's best cosine with a centroid, its own taken without the row."""
    cosines = rows @ centers.T
    nearest = cosines.argmax(axis=1)
    for k in range(len(centers)):
        members = np.flatnonzero(nearest == k)
        total = sum_of(rows, members)
        for start in range(0, len(members), BLOCK // 8):
            some = members[start : start + BLOCK // 8]
            others = total - rows[some]
            norms = np.linalg.norm(others, axis=1)
            own = (others * rows[some]).sum(axis=1) / np.maximum(norms, 1e-9)
            cosines[some, k] = np.where(norms > 1e-6, own, 0.0)
    return cosines.max(axis=1)


def bounds(cosines: np.ndarray, grams: np.ndarray, quantile: float, slack: float) -> np.ndarray:
    """The least cosine accepted, per class of length; lengths shorter or longer than all known ask for nothing."""
    classes, out = length_class(grams), np.zeros(LENGTHS)
    if len(cosines) < FEW:
        return out
    for c in range(int(classes.min()), int(classes.max()) + 1):
        width = 1
        while (near := np.abs(classes - c) <= width).sum() < min(LIKE, len(classes)):
            width += 1
        out[c] = slack * np.quantile(cosines[near], quantile)
    return out


@dataclass(frozen=True)
class LanguageModel:
    idf: np.ndarray
    languages: list[str]
    centroids: np.ndarray
    reach: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        names, scores, rejected = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
        if not self.languages:
            return names, scores, rejected
        for start in range(0, len(texts), BLOCK):
            rows, places, grams = weighed_texts(texts[start : start + BLOCK], self.idf)
            if not places:
                continue
            cosines = rows @ self.centroids.T
            best = cosines.argmax(axis=1)
            for place, n, b, row in zip(places, grams.tolist(), best, cosines):
                i = start + place
                names[i] = self.languages[b]
                scores[i] = float(min(max(row[b], 0.0), 1.0))
                least = LEAST * min(1.0, (n / FULL_GRAMS) ** 0.5)
                rejected[i] = bool(row[b] < max(least, self.reach[b, length_class(n)]))
        return names, scores, rejected


def document_frequencies(training: DataFrame) -> tuple[int, np.ndarray]:
    """Training texts with letters, and in how many of them each feature occurs."""

    def count(batches):
        seen = np.zeros(DIMENSION + 1, dtype=np.int64)
        for batch in batches:
            for text in batch.column("text"):
                counts = gram_counts(text.as_py())
                if counts is not None:
                    seen[:-1] += counts > 0
                    seen[-1] += 1
        held = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(seen[held])], names=["feature", "n"])

    found = training.select("text").mapInArrow(count, "feature long, n long").groupBy("feature").agg(F.sum("n")).collect()
    total = np.zeros(DIMENSION + 1, dtype=np.int64)
    for feature, n in found:
        total[feature] = n
    return int(total[-1]), total[:-1]


def bounded_sample(training: DataFrame, per_language: int) -> DataFrame:
    """At most ``per_language`` texts of each language, those with the smallest hashes."""
    sizes = training.groupBy("lang").agg(F.count(F.lit(1)).alias("_n")).withColumnRenamed("lang", "_lang")
    draw = (F.xxhash64("text", "doc_id").bitwiseAND((1 << 30) - 1) / float(1 << 30)).alias("_draw")
    thinned = training.select("lang", "text", draw).join(if_small(sizes), F.col("lang") == F.col("_lang"))
    thinned = thinned.where(F.col("_draw") <= F.lit(4.0 * per_language) / F.col("_n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("_draw", "text"))
    return thinned.withColumn("_place", place).where(F.col("_place") <= per_language).select("lang", "text")


def cluster(rows: np.ndarray, clusters: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means; starts from rows far from each other. Returns unit centroids."""
    chosen = [0]
    while len(chosen) < min(clusters, len(rows)):
        chosen.append(int((rows @ rows[chosen].T).max(axis=1).argmin()))
    centers = rows[chosen].copy()
    for _ in range(rounds):
        nearest = (rows @ centers.T).argmax(axis=1)
        for k in range(len(centers)):
            members = np.flatnonzero(nearest == k)
            if len(members):
                mean = sum_of(rows, members) / len(members)
                centers[k] = mean / max(float(np.linalg.norm(mean)), 1e-9)
    return centers


def fit(
    docs: DataFrame,
    is_training: Column,
    clusters: int = 4,
    slack: float = 0.8,
    quantile: float = 0.005,
    per_language: int = SAMPLE_PER_LANGUAGE,
) -> LanguageModel:
    """Learn from rows for which ``is_training`` holds; centroids and bounds from ``per_language`` of them at most."""
    training = on_workers(docs).where(is_training & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    n, seen = document_frequencies(training)
    idf = (np.log((n + 1.0) / (seen + 1.0)) + 1.0).astype(np.float32)

    def centroids(pdf: pd.DataFrame) -> pd.DataFrame:
        rows, places, grams = weighed_texts(sorted(pdf["text"]), idf)
        if not places:
            return pd.DataFrame({"lang": [], "centroid": [], "reach": []})
        centers = cluster(rows, clusters)
        reach = bounds(cosines_without_self(rows, centers), grams, quantile, slack).tobytes()
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "centroid": [c.astype(np.float32).tobytes() for c in centers], "reach": [reach] * len(centers)})

    sample = bounded_sample(training, per_language)
    found = sample.groupBy("lang").applyInPandas(centroids, "lang string, centroid binary, reach binary").collect()
    found.sort(key=lambda r: (r["lang"], bytes(r["centroid"])))
    vectors = [np.frombuffer(bytes(r["centroid"]), dtype=np.float32) for r in found]
    return LanguageModel(
        idf, [r["lang"] for r in found],
        np.stack(vectors) if vectors else np.zeros((0, DIMENSION), np.float32),
        np.stack([np.frombuffer(bytes(r["reach"])) for r in found]) if found else np.zeros((0, LENGTHS)),
    )


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The documents as structs ``doc``, with lang_pred, score and rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    whole = packed(on_workers(docs))

    def add(batches):
        for batch in batches:
            texts = pc.struct_field(batch.column(0), "text")
            blocks = [shared.value.predict(texts.slice(start, BLOCK).to_pylist()) for start in range(0, len(texts), BLOCK)]
            names, scores, rejected = ([x for block in blocks for x in block[c]] for c in range(3))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                names=["doc", "lang_pred", "score", "rejected"],
            )

    schema = T.StructType([*whole.schema.fields]).add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return whole.mapInArrow(add, schema)


def digest(docs: DataFrame) -> DataFrame:
    held_out = remainder(F.col("doc_id"), 4) == 2
    model = fit(docs, ~held_out)
    out = identify(docs.select("doc_id", "text"), model).select("doc.doc_id", "lang_pred", "score", "rejected")
    return out.withColumn("held_out", held_out)
