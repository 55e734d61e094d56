"""Interpolated modified Kneser-Ney bigram model: counted in Spark, memory-mapped for scoring.

Counting. Tasks count the word pairs of their texts chunk by chunk and deal the counts out in
compressed arrays by the pair's first word; the few words so frequent that they would make a
bucket uneven are dealt by the whole pair. Each bucket adds up its pairs and writes one shard: sorted
64-bit pair hashes with counts, and for each first word how many different words follow it
once, twice or more often. What it knows of second words (pairs, occurrences) goes on to the
bucket of that word, which writes a second shard: sorted word hashes with occurrences and numbers of
different predecessors. Totals and counts of counts, a few rows per bucket, reach the driver.

Scoring. Workers map the shards of the shared folder into memory (a folder without a local path is
copied to the worker's own temporary folder once) and look whole chunks up by binary search.
p(w|u) = (c(uw) - D)/c(u) + backoff(u) p(w); p(w) = (n(w) - D')/n + rest/(V+1), where n counts
different predecessors and D, D' are the three discounts of each level.

Shards are written under a temporary name and renamed, with contents that depend on the data
alone, so a task that runs again writes the same file.

Defined cases: a null text is empty and has the end as its only token; without training texts
every probability is 1/(0+1), so all scores are 0; words never seen get the share of one unseen
word; equal rows are treated alike; other columns are ignored.
"""

from __future__ import annotations

import io
import os
import tempfile
from dataclasses import dataclass, field
from functools import lru_cache
from urllib.parse import urlsplit
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import on_workers, remainder
from visitlens.llm.word_hashes import BEGIN, END, mix, word_hashes
from visitlens.session import shared_folder

CHUNK_TOKENS = 1_500_000
SMALL = 255


def pair_hash(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    return mix(mix(u) + v * np.uint64(0x9E3779B97F4A7C15))


def tokens_of(text: str | None) -> np.ndarray:
    """Hashes of the words of a text, then of the end."""
    return np.append(word_hashes(text), END)


def chunks_of_texts(batches, column: str):
    """(batch, first row, hashes per text) with about ``CHUNK_TOKENS`` tokens each."""
    for batch in batches:
        texts, held, size, start = batch.column(batch.schema.get_field_index(column)), [], 0, 0
        for row, text in enumerate(texts):
            held.append(tokens_of(text.as_py()))
            size += len(held[-1])
            if size >= CHUNK_TOKENS or row + 1 == len(texts):
                yield batch, start, held
                held, size, start = [], 0, row + 1


def contexts_of(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All tokens of a chunk and what stands before each of them."""
    v = np.concatenate(held)
    u = np.empty_like(v)
    u[1:] = v[:-1]
    u[np.cumsum([0] + [len(h) for h in held[:-1]])] = BEGIN
    return u, v


def add_up(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct keys in order, the place of the first of each, and sums of the values."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    sums = [np.add.reduceat(x[order], starts) if len(starts) else x[:0] for x in values]
    return key[starts], order[starts], sums


def pack(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return zstandard.ZstdCompressor(level=1).compress(out.getvalue())


def unpack(blob: bytes) -> dict[str, np.ndarray]:
    return dict(np.load(io.BytesIO(zstandard.ZstdDecompressor().decompress(blob))))


def narrow(counts: np.ndarray) -> np.ndarray:
    top = int(counts.max()) if len(counts) else 0
    return counts.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.int64)


class Folder:
    """Files of a shared folder, which may be local, mounted or in a store."""

    def __init__(self, uri: str):
        parts = urlsplit(uri)
        self.local = parts.scheme in ("", "file")
        self.path = parts.path if self.local else None
        self.uri = uri

    def write(self, name: str, data: bytes) -> None:
        if self.local:
            os.makedirs(self.path, exist_ok=True)
            partial = f"{self.path}/.{name}-{uuid4()}"
            with open(partial, "wb") as out:
                out.write(data)
            os.replace(partial, f"{self.path}/{name}")
        else:
            store, path = arrow_fs.FileSystem.from_uri(self.uri)
            with store.open_output_stream(f"{path}/{name}") as out:
                out.write(data)

    def mapped(self, name: str) -> np.ndarray:
        path = f"{self.path}/{name}"
        if not self.local:
            kept = f"{tempfile.gettempdir()}/{self.uri.rsplit('/', 1)[-1]}"
            path = f"{kept}/{name}"
            if not os.path.exists(path):
                os.makedirs(kept, exist_ok=True)
                store, there = arrow_fs.FileSystem.from_uri(self.uri)
                arrow_fs.copy_files(f"{there}/{name}", f"{path}-{os.getpid()}", source_filesystem=store)
                os.replace(f"{path}-{os.getpid()}", path)
        return np.memmap(path, dtype=np.uint8, mode="r")


def shard_bytes(arrays: list[np.ndarray]) -> bytes:
    """Lengths in bytes, then the arrays, each from a multiple of 8 on."""
    head = np.array([len(arrays), *[a.nbytes for a in arrays]], dtype=np.int64).tobytes()
    return head + b"".join(a.tobytes() + b"\0" * (-a.nbytes % 8) for a in arrays)


def shard_arrays(data: np.ndarray, kinds: list[type]) -> list[np.ndarray]:
    sizes = data[8 : 8 + 8 * len(kinds)].view(np.int64)
    out, at = [], 8 + 8 * len(kinds)
    for kind, size in zip(kinds, sizes):
        out.append(data[at : at + int(size)].view(kind))
        at += int(size) + (-int(size) % 8)
    return out


PAIR_SHARD = [np.uint64, np.uint8, np.int64, np.int64, np.uint64, np.uint32, np.uint32, np.uint32]
WORD_SHARD = [np.uint64, np.int64, np.uint32]


def bucket_of_words(words: np.ndarray, buckets: int) -> np.ndarray:
    return ((mix(words) >> np.uint64(20)) % np.uint64(buckets)).astype(np.int32)


def bucket_of_pairs(u: np.ndarray, v: np.ndarray, frequent: np.ndarray, buckets: int) -> np.ndarray:
    out = bucket_of_words(u, buckets)
    if len(frequent):
        hot = frequent[np.minimum(np.searchsorted(frequent, u), len(frequent) - 1)] == u
        out[hot] = bucket_of_words(pair_hash(u[hot], v[hot]), buckets)
    return out


def frequent_words(training: DataFrame, buckets: int, every: int = 32) -> np.ndarray:
    """Words that are more than 1/(8 buckets) of the tokens in one of ``every`` texts.

    They only steer how pairs are dealt out, not what is counted.
    """

    def count(batches):
        for _, _, held in chunks_of_texts(batches, "text"):
            word, _, (n,) = add_up(np.concatenate(held), np.ones(sum(map(len, held)), np.int64))
            keep = n * 16 * buckets >= n.sum()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(word[keep], 0).view(np.int64)), pa.array(np.append(n[keep], n.sum()))], names=["word", "n"]
            )

    part = training.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0).select("text")
    found = part.mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    rows = {w: n for w, n in found.collect()}
    total = rows.pop(0, 0)
    hot = [w for w, n in rows.items() if n * 8 * buckets >= total]
    return np.sort(np.array(hot, dtype=np.int64).view(np.uint64))


def discounts(n: np.ndarray) -> tuple[float, float, float]:
    """Discounts of counts 1, 2 and 3 or more from how often counts 1 to 4 occur.

    At least 0.1, since small samples may give 0, which would leave nothing for unseen pairs.
    """
    n1, n2, n3, n4 = (float(x) for x in n[:4])
    y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    raw = [k - (k + 1) * y * b / a if a else k / 2 for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return tuple(min(max(d, 0.1), float(k)) for k, d in enumerate(raw, 1))


def counts_of_counts(counts: np.ndarray) -> np.ndarray:
    return np.bincount(np.minimum(counts, 5).astype(np.int64), minlength=6)[1:6]


@dataclass
class KneserNey:
    """Totals of a model; the arrays stay in the shards of ``folder``."""

    folder: str
    buckets: int
    frequent: np.ndarray
    followers: np.ndarray  # per frequent word: different next words seen once, twice, more often
    texts: int
    tokens: int
    types: int
    pairs: int
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    word_rest: float
    _open: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"_open": {}}

    def _shard(self, kind: str, bucket: int, kinds: list[type]) -> list[np.ndarray]:
        key = (kind, bucket)
        if key not in self._open:
            self._open[key] = shard_arrays(Folder(self.folder).mapped(f"{kind}-{bucket}"), kinds)
        return self._open[key]

    def _each_bucket(self, buckets: np.ndarray, keys: np.ndarray):
        """(bucket, places) with the places sorted by key, so that lookups walk along the arrays."""
        order = np.lexsort((keys, buckets))
        cuts = np.searchsorted(buckets[order], np.arange(self.buckets + 1))
        for b in np.flatnonzero(cuts[1:] > cuts[:-1]):
            yield int(b), order[cuts[b] : cuts[b + 1]]

    def words(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences and different predecessors of distinct words."""
        count, before = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        for b, at in self._each_bucket(bucket_of_words(words, self.buckets), words):
            keys, counts, predecessors = self._shard("words", b, WORD_SHARD)
            place, hit = locate(keys, words[at])
            count[at[hit]], before[at[hit]] = counts[place], predecessors[place]
        return count, before

    def pair_counts(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        out, keys = np.zeros(len(u), np.int64), pair_hash(u, v)
        for b, at in self._each_bucket(bucket_of_pairs(u, v, self.frequent, self.buckets), keys):
            hashes, small, large_at, large = self._shard("pairs", b, PAIR_SHARD)[:4]
            place, hit = locate(hashes, keys[at])
            found = small[place].astype(np.int64)
            over = np.flatnonzero(found == SMALL)
            if len(over):
                found[over] = large[np.searchsorted(large_at, place[over])]
            out[at[hit]] = found
        return out

    def follower_kinds(self, words: np.ndarray) -> np.ndarray:
        """Per distinct word: different next words seen once, twice, more often."""
        out = np.zeros((len(words), 3), np.int64)
        for b, at in self._each_bucket(bucket_of_words(words, self.buckets), words):
            keys, *kinds = self._shard("pairs", b, PAIR_SHARD)[4:]
            place, hit = locate(keys, words[at])
            out[at[hit]] = np.stack([k[place] for k in kinds], axis=1)
        if len(self.frequent):
            place, hit = locate(self.frequent, words)
            out[hit] = self.followers[place]
        return out

    def score(self, held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: known tokens, add-one score and model score (log10)."""
        u, v = contexts_of(held)
        starts = np.cumsum([0] + [len(h) for h in held[:-1]])
        distinct, back = np.unique(v, return_inverse=True)
        count, before = self.words(distinct)
        kinds = self.follower_kinds(np.append(distinct, BEGIN))
        occurrences = count[back]
        of_context = np.empty(len(v), np.int64)
        context = np.empty(len(v), np.int64)
        of_context[1:], context[1:] = occurrences[:-1], back[:-1]
        of_context[starts], context[starts] = self.texts, len(distinct)
        base = np.log10((occurrences + 1.0) / (self.tokens + (self.types + 1.0)))

        low = discounted(before, self.word_discounts) / max(self.pairs, 1) + self.word_rest / (self.types + 1.0)
        p = low[back] if self.pairs else np.full(len(v), 1.0 / (self.types + 1.0))
        seen = np.flatnonzero(of_context > 0)
        if len(seen):
            keys = pair_hash(u[seen], v[seen])
            _, first, again = np.unique(keys, return_index=True, return_inverse=True)
            pair = self.pair_counts(u[seen][first], v[seen][first])[again]
            backoff = (kinds[context[seen]] * np.array(self.pair_discounts)).sum(axis=1)
            p[seen] = (discounted(pair, self.pair_discounts) + backoff * p[seen]) / of_context[seen]
        known = np.add.reduceat((occurrences > 0).astype(np.int64), starts)
        return known, np.add.reduceat(base, starts), np.add.reduceat(np.log10(p), starts)


def locate(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the sorted ``keys`` of those wanted that exist, and which these are."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place = np.searchsorted(keys, wanted)
    hit = np.flatnonzero(keys[np.minimum(place, len(keys) - 1)] == wanted)
    return place[hit], hit


def discounted(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return counts - np.array([0.0, *d])[np.minimum(counts, 3)]


def fit(docs: DataFrame, is_training: Column, buckets: int | None = None) -> KneserNey:
    """Count the pairs of training texts and write the shards of the model."""
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = f"{shared_folder(spark)}/bigrams-{uuid4()}"
    training = on_workers(docs).where(is_training).select("doc_id", "text")
    frequent = frequent_words(training, buckets)

    def count(batches):
        for _, _, held in chunks_of_texts(batches, "text"):
            u, v = contexts_of(held)
            _, first, (n,) = add_up(pair_hash(u, v), np.ones(len(u), np.int64))
            u, v = u[first], v[first]
            bucket = bucket_of_pairs(u, v, frequent, buckets)
            order = np.lexsort((u, bucket))
            bucket, u, v, n = bucket[order], u[order], v[order], n[order]
            cuts = np.searchsorted(bucket, np.arange(buckets + 1))
            held_buckets = np.flatnonzero(cuts[1:] > cuts[:-1])
            blobs = []
            for b in held_buckets:
                part = slice(cuts[b], cuts[b + 1])
                heads = np.flatnonzero(np.concatenate([[True], u[part][1:] != u[part][:-1]]))
                runs = np.diff(np.append(heads, cuts[b + 1] - cuts[b]))
                blobs.append(pack(u=u[part][heads], runs=narrow(runs), v=v[part], n=narrow(n[part])))
            yield pa.RecordBatch.from_arrays([pa.array(held_buckets, pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "blob"])

    def merge_pairs(pdf: pd.DataFrame) -> pd.DataFrame:
        """One bucket of pairs: write its shard; pass on second words, counts of counts and frequent first words."""
        parts = [unpack(b) for b in pdf["blob"]]
        u = np.concatenate([np.repeat(p["u"], p["runs"]) for p in parts])
        v = np.concatenate([p["v"] for p in parts])
        n = np.concatenate([p["n"].astype(np.int64) for p in parts])
        del parts
        hashes, first, (n,) = add_up(pair_hash(u, v), n)
        u, v = u[first], v[first]
        kinds = [(n == 1).astype(np.int64), (n == 2).astype(np.int64), (n > 2).astype(np.int64)]
        heads, _, kinds = add_up(u, *kinds)
        large = np.flatnonzero(n >= SMALL)
        is_hot = np.zeros(len(heads), bool)
        is_hot[locate(frequent, heads)[1]] = True
        own = [heads[~is_hot], *[k[~is_hot].astype(np.uint32) for k in kinds]]
        data = shard_bytes([hashes, np.minimum(n, SMALL).astype(np.uint8), large, n[large], *own])
        Folder(folder).write(f"pairs-{int(pdf['bucket'].iloc[0])}", data)
        words, _, (times, before) = add_up(v, n, np.ones(len(v), np.int64))
        to = bucket_of_words(words, buckets)
        order = np.argsort(to, kind="stable")
        cuts = np.searchsorted(to[order], np.arange(buckets + 1))
        rows = [
            (int(b), pack(w=words[at], c=narrow(times[at]), n=narrow(before[at])))
            for b in np.flatnonzero(cuts[1:] > cuts[:-1])
            for at in [order[cuts[b] : cuts[b + 1]]]
        ]
        hot = np.flatnonzero(is_hot)
        rows.append((-1, pack(bucket=pdf["bucket"].to_numpy()[:1], kinds=counts_of_counts(n), texts=np.array([n[u == BEGIN].sum()]),
                              hot=heads[hot], followers=np.stack([k[hot] for k in kinds], axis=1))))
        return pd.DataFrame(rows, columns=["bucket", "blob"])

    def merge_words(pdf: pd.DataFrame) -> pd.DataFrame:
        """One bucket of words: write its shard and give its totals; the summaries of pairs are only added up."""
        bucket = int(pdf["bucket"].iloc[0])
        parts = [unpack(b) for b in pdf["blob"]]
        if bucket < 0:
            hot, _, kinds = add_up(
                np.concatenate([p["hot"] for p in parts]),
                *[np.concatenate([p["followers"][:, k] for p in parts]) for k in range(3)],
            )
            blob = pack(bucket=np.concatenate([p["bucket"] for p in parts]), kinds=sum(p["kinds"] for p in parts), texts=sum(p["texts"] for p in parts),
                        hot=hot, followers=np.stack(kinds, axis=1))
            return pd.DataFrame([(bucket, blob)], columns=["bucket", "blob"])
        words, _, (times, before) = add_up(
            np.concatenate([p["w"] for p in parts]),
            *[np.concatenate([p[k].astype(np.int64) for p in parts]) for k in "cn"],
        )
        Folder(folder).write(f"words-{bucket}", shard_bytes([words, times, before.astype(np.uint32)]))
        totals = np.array([times.sum(), len(words), before.sum()])
        return pd.DataFrame([(bucket, pack(totals=totals, kinds=counts_of_counts(before)))], columns=["bucket", "blob"])

    schema = "bucket int, blob binary"
    pairs = training.select("text").mapInArrow(count, schema).groupBy("bucket").applyInPandas(merge_pairs, schema)
    found = {r["bucket"]: unpack(r["blob"]) for r in pairs.groupBy("bucket").applyInPandas(merge_words, schema).collect()}
    return _assemble(folder, buckets, frequent, found)


def _assemble(folder: str, buckets: int, frequent: np.ndarray, found: dict[int, dict[str, np.ndarray]]) -> KneserNey:
    nothing = {"bucket": np.zeros(0, np.int32), "kinds": np.zeros(5, np.int64), "texts": np.zeros(1, np.int64), "hot": frequent[:0], "followers": np.zeros((0, 3), np.int64)}
    of_pairs = found.pop(-1, nothing)
    followers = np.zeros((len(frequent), 3), np.int64)
    if len(of_pairs["hot"]):
        followers[np.searchsorted(frequent, of_pairs["hot"])] = of_pairs["followers"]
    tokens, types, pairs = (int(sum(f["totals"][k] for f in found.values())) for k in range(3))
    kinds = sum((f["kinds"] for f in found.values()), np.zeros(5, np.int64))
    d = discounts(kinds)
    rest = (d[0] * kinds[0] + d[1] * kinds[1] + d[2] * kinds[2:].sum()) / pairs if pairs else 1.0
    home = Folder(folder)
    for kind, kinds_of, written in (("pairs", PAIR_SHARD, set(of_pairs["bucket"].tolist())), ("words", WORD_SHARD, set(found))):
        for b in set(range(buckets)) - written:  # buckets that no row fell into
            home.write(f"{kind}-{b}", shard_bytes([np.zeros(0, k) for k in kinds_of]))
    return KneserNey(
        folder, buckets, frequent, followers, int(of_pairs["texts"][0]), tokens, types, pairs,
        discounts(of_pairs["kinds"]), d, float(rest),
    )


def score(docs: DataFrame, model: KneserNey) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches):
        for batch, start, held in chunks_of_texts(batches, "text"):
            known, base, own = shared.value.score(held)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(start, len(held)), pa.array([len(h) for h in held], pa.int64()),
                 pa.array(known), pa.array(base), pa.array(own)],
                names=["doc_id", "n_tokens", "n_known", "base_score", "score"],
            )

    schema = "doc_id long, n_tokens long, n_known long, base_score double, score double"
    return on_workers(docs).select("doc_id", "text").mapInArrow(rows, schema)


def perplexity(score_column: Column, n_tokens: Column) -> Column:
    return F.pow(F.lit(10.0), -score_column / n_tokens)


def digest(docs: DataFrame) -> DataFrame:
    held_out = remainder(F.col("doc_id"), 7) == 2
    model = fit(docs, ~held_out)
    out = score(docs, model)
    return out.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score", "score", perplexity(F.col("score"), F.col("n_tokens")).alias("perplexity"),
    )
