"""Alignment of two tokenizers over a corpus: A is byte-level BPE, B is SentencePiece.

Texts are shuffled whole, so that each distinct text is tokenised and aligned once, whatever the number of
its copies. Both token sequences cover the bytes of space + text; byte offsets where tokens of A and of B
both end cut them into groups, and an A token is linked with every B token whose byte range overlaps its own.

How often two ids are linked in the corpus is counted in steps that each hold bounded data: a worker takes
texts in chunks of some MB, keeps per text the places of its pairs in the chunk's own sorted list of distinct
pairs, and emits that list once, weighted by the copies of the texts. Spark sums the lists by pair, finds
the highest count of each B id and sends every chunk the totals of its own list. The measures of the distinct
texts are then joined to the documents by the text's digest; texts with very many copies are spread
over several tasks by their known number of copies.

Defined cases: null and empty texts, and texts whose joined token bytes (of A or of B) differ from space +
text, have no tokens: zeros and an empty hash. Equal rows are treated alike; other columns are ignored; an
empty table gives an empty one. Whole texts are aligned; one longer than a chunk is a chunk of its own.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import on_workers
from visitlens.operators.skew import heavy_from_counts, left_join
from visitlens.session import cut_lineage

#: Bytes of text in a chunk.
CHUNK_BYTES = 8 << 20
MARK = "▁"
#: A pair of ids is one number: id of A times this plus id of B.
SPAN = 1 << 31
#: A run of white space from this length on is left to the tokenizers library, as the other one recurses on it.
LONG_SPACE = re.compile(r"\s{2000}")

MEASURES = ("n_a", "n_b", "n_groups", "n_links")


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary, and that byte.

    Printable bytes of Latin-1 stand for themselves, the others for the characters from U+0100 on, in order.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteTokens:
    """Ids of a byte-level BPE file, and the bytes of each id.

    Where the file is plain byte-level BPE whose merges stand in the order of their ids, the faster tiktoken
    library encodes with the same ranks; else the tokenizers library does.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True
        spec = json.loads(self.slow.to_str())
        alphabet = byte_alphabet()
        self.bytes_of: dict[int, bytes] = {}
        for token, i in spec["model"]["vocab"].items():
            self.bytes_of[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        for added in spec.get("added_tokens", []):
            self.bytes_of[added["id"]] = added["content"].encode()
        self.fast = tiktoken.Encoding("own", **plain) if (plain := self._plain(spec)) else None

    def _plain(self, spec: dict) -> dict | None:
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model.get("merges", [])]
        ids = [model["vocab"].get(m) for m in merged]
        plain = (
            model.get("type") == "BPE" and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
            and not spec.get("normalizer") and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
            and None not in ids and ids == sorted(set(ids)) and len(model["vocab"]) == 256 + len(ids)
        )
        if not plain:
            return None
        # Fixed value: the pattern of plain byte-level pre-tokenisation.
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        ranks = {self.bytes_of[i]: i for i in model["vocab"].values()}
        return {"pat_str": pattern, "mergeable_ranks": ranks, "special_tokens": {}}

    def encode(self, text: str) -> list[int]:
        if self.fast is None or LONG_SPACE.search(text):
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class PieceTokens:
    """Ids of a SentencePiece model, and the bytes of each id."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        self.bytes_of = {i: self._bytes(i, self.model.id_to_piece(i)) for i in range(size)}

    def _bytes(self, i: int, piece: str) -> bytes:
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace(MARK, " ").encode()

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text)


def _ends(ids: np.ndarray, bytes_of: dict[int, bytes], lengths: np.ndarray, whole: bytes) -> np.ndarray | None:
    """Byte offsets at which the tokens end; None if their bytes are not ``whole``."""
    if b"".join(map(bytes_of.__getitem__, ids.tolist())) != whole:
        return None
    return np.cumsum(lengths[ids])


class Aligner:
    """Both tokenizers, and what is derived from their tokens."""

    def __init__(self, byte_file: str, piece_file: str):
        self.a, self.b = ByteTokens(byte_file), PieceTokens(piece_file)
        self.lengths = [self._lengths(t.bytes_of) for t in (self.a, self.b)]
        self.shown = [[f"{i}{sep}" for i in range(max(len(x) for x in self.lengths))] for sep in (",", "|", ";")]
        self.shown = self.shown[0] + self.shown[1] + self.shown[2]
        self.size = len(self.shown) // 3

    @staticmethod
    def _lengths(bytes_of: dict[int, bytes]) -> np.ndarray:
        out = np.zeros(max(bytes_of) + 1, dtype=np.int64)
        for i, raw in bytes_of.items():
            out[i] = len(raw)
        return out

    def align(self, text: str | None) -> Aligned | None:
        """The tokens of a text, or None where it has none."""
        if not text:
            return None
        whole = b" " + text.encode("utf-8", "surrogatepass")
        a, b = (np.array(t.encode(x), dtype=np.int64) for t, x in ((self.a, f" {text}"), (self.b, text)))
        ends = [_ends(ids, t.bytes_of, n, whole) for ids, t, n in zip((a, b), (self.a, self.b), self.lengths)]
        return None if ends[0] is None or ends[1] is None else Aligned(a, b, *ends)

    def groups_text(self, x: Aligned) -> str:
        """``a1,a2|b1;a3|b2,b3``: the ids of every group, A before B."""
        last_a, last_b = np.append(x.group_a[1:] != x.group_a[:-1], True), np.append(x.group_b[1:] != x.group_b[:-1], True)
        count_a, count_b = np.bincount(x.group_a, minlength=x.n_groups), np.bincount(x.group_b, minlength=x.n_groups)
        order = np.empty(len(x.a) + len(x.b), dtype=np.int64)
        order[np.arange(len(x.a)) + (np.cumsum(count_b) - count_b)[x.group_a]] = x.a + np.where(last_a, self.size, 0)
        order[np.arange(len(x.b)) + np.cumsum(count_a)[x.group_b]] = x.b + np.where(last_b, 2 * self.size, 0)
        return "".join(map(self.shown.__getitem__, order.tolist()))[:-1]


class Aligned:
    """Token ids of a text, the group of every token, and the linked pairs."""

    def __init__(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray):
        self.a, self.b = a, b
        at = np.searchsorted(ends_b, ends_a)  # the B token that holds the last byte of each A token
        both = ends_b[at] == ends_a
        ends_group = np.zeros(len(b), dtype=bool)
        ends_group[at[both]] = True
        self.group_a, self.group_b = np.cumsum(both) - both, np.cumsum(ends_group) - ends_group
        self.n_groups = int(both.sum())
        # a range shared by two tokens ends where the A token ends, or with a B token inside of it
        inner = np.flatnonzero(~ends_group)
        over = np.searchsorted(ends_a, ends_b[inner])
        self.pairs = np.concatenate([a * SPAN + b[at], a[over] * SPAN + b[inner]])

    def measures(self) -> tuple[int, int, int, int]:
        return len(self.a), len(self.b), self.n_groups, len(self.pairs)


class Chunk:
    """Texts whose pairs share one list."""

    def __init__(self):
        self.rows: list[tuple] = []
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.copies: list[int] = []
        self.bytes = 0

    def add(self, key: bytes, copies: int, size: int, aligned: Aligned, groups: str) -> None:
        pairs, times = np.unique(aligned.pairs, return_counts=True)
        self.rows.append((key, copies, *aligned.measures(), hashlib.sha256(groups.encode()).hexdigest()))
        self.pairs.append(pairs)
        self.times.append(times)
        self.copies.append(copies)
        self.bytes += size

    def tables(self, number: int) -> Iterator[pa.RecordBatch]:
        """One row per text, and one with the chunk's distinct pairs and their weighted counts."""
        sizes = np.array([len(p) for p in self.pairs])
        listed, place = np.unique(np.concatenate(self.pairs), return_inverse=True)
        weights = np.concatenate(self.times) * np.repeat(np.array(self.copies, dtype=np.int64), sizes)
        counts = np.zeros(len(listed), dtype=np.int64)
        np.add.at(counts, place, weights)
        offsets = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
        n = len(self.rows)
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (place, np.concatenate(self.times))]
        columns = [pa.array(c, f.type) for c, f in zip(zip(*self.rows), TEXT_FIELDS)]
        none = pa.nulls(n, pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array([number] * n, pa.int64()), *columns, *lists, none, none], schema=CHUNK_SCHEMA)
        nothing = [pa.nulls(1, f.type) for f in CHUNK_SCHEMA][1:-2]
        lists = [pa.array([x], pa.list_(pa.int64())) for x in (listed, counts)]
        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *nothing, *lists], schema=CHUNK_SCHEMA)


TEXT_FIELDS = [
    pa.field("key", pa.binary()),
    pa.field("copies", pa.int64()),
    *[pa.field(m, pa.int64()) for m in MEASURES],
    pa.field("groups_sha256", pa.string()),
]
CHUNK_SCHEMA = pa.schema(
    [pa.field("chunk", pa.int64()), *TEXT_FIELDS]
    + [pa.field(n, pa.list_(pa.int32())) for n in ("places", "times")]
    + [pa.field(n, pa.list_(pa.int64())) for n in ("pairs", "counts")]
)
CHUNK_DDL = (
    "chunk long, key binary, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string,"
    " places array<int>, times array<int>, pairs array<long>, counts array<long>"
)


@lru_cache(maxsize=2)
def load(byte_file: str, piece_file: str) -> Aligner:
    return Aligner(byte_file, piece_file)


def align_texts(texts: DataFrame, byte_file: str, piece_file: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Distinct texts (key, text, copies), aligned in chunks; stored. Texts without tokens are left out."""

    def rows(batches):
        aligner, chunk, number = load(byte_file, piece_file), Chunk(), TaskContext.get().partitionId() << 32
        for batch in batches:
            for key, text, copies in zip(*(batch.column(c) for c in ("key", "text", "copies"))):
                text = text.as_py()
                aligned = aligner.align(text)
                if aligned is None:
                    continue
                chunk.add(key.as_py(), copies.as_py(), len(text), aligned, aligner.groups_text(aligned))
                if chunk.bytes >= chunk_bytes:
                    yield from chunk.tables(number)
                    chunk, number = Chunk(), number + 1
        if chunk.rows:
            yield from chunk.tables(number)

    return cut_lineage(on_workers(texts).mapInArrow(rows, CHUNK_DDL))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, total, best): corpus-wide links of every pair, and whether no pair of its B id has more."""
    listed = aligned.where(F.col("key").isNull()).select(F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("counts").alias("n"))))
    totals = cut_lineage(listed.groupBy("pair").agg(F.sum("n").alias("total")).withColumn("b", F.col("pair") % SPAN))
    highest = totals.groupBy("b").agg(F.max("total").alias("highest"))
    return totals.join(highest, "b").select("pair", "total", (F.col("total") == F.col("highest")).alias("best"))


def _weigh(texts: pa.Table, pairs: pa.Table) -> pa.Table:
    """n_best and count_sum of a chunk's texts from the totals of its pairs."""
    if not len(texts):
        return WEIGHED.empty_table()
    total = np.zeros(len(pairs), dtype=np.int64)
    best = np.zeros(len(pairs), dtype=np.int64)
    at = pairs["place"].to_numpy()
    total[at], best[at] = pairs["total"].to_numpy(), pairs["best"].to_numpy()
    places, times = (texts[c].combine_chunks() for c in ("places", "times"))
    place, n = (x.flatten().to_numpy().astype(np.int64) for x in (places, times))
    starts = np.append(0, np.cumsum(places.value_lengths().to_numpy()))[:-1]
    sums = [np.add.reduceat(n * x[place], starts) for x in (best, total)]
    return pa.Table.from_arrays([texts["key"], *(pa.array(s, pa.int64()) for s in sums)], schema=WEIGHED)


WEIGHED = pa.schema([("key", pa.binary()), ("n_best", pa.int64()), ("count_sum", pa.int64())])


def text_measures(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """All measures of the distinct texts, by key."""
    listed = aligned.where(F.col("key").isNull()).select("chunk", F.posexplode("pairs").alias("place", "pair"))
    sent = listed.join(counts, "pair").select(F.col("chunk").alias("of_chunk"), "place", "total", "best")
    texts = aligned.where(F.col("key").isNotNull())
    weighed = texts.select("chunk", "key", "places", "times").groupBy("chunk").cogroup(sent.groupBy("of_chunk"))
    sums = weighed.applyInArrow(_weigh, "key binary, n_best long, count_sum long")
    return texts.select("key", *MEASURES, "groups_sha256").join(sums, "key")


def align(
    docs: DataFrame, byte_file: str, piece_file: str, chunk_bytes: int = CHUNK_BYTES
) -> tuple[DataFrame, DataFrame]:
    """(doc_id, key of the text, measures) with a row per document, and the links of every pair of ids."""
    has_text = F.length("text") > 0
    key = F.unhex(F.sha2(F.encode("text", "UTF-8"), 256))
    texts = docs.where(has_text).groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    aligned = align_texts(texts.select(key.alias("key"), "text", "copies"), byte_file, piece_file, chunk_bytes)
    counts = cut_lineage(pair_counts(aligned))
    keyed = docs.select("doc_id", F.when(has_text, key).alias("key"))
    return _spread_join(keyed, aligned, text_measures(aligned, counts)), counts


def _spread_join(keyed: DataFrame, aligned: DataFrame, measures: DataFrame) -> DataFrame:
    """The documents with the measures of their texts, those of frequent texts over several tasks."""
    copies = aligned.where(F.col("key").isNotNull()).select("key", "copies")
    without = keyed.count() - (copies.agg(F.sum("copies")).first()[0] or 0)
    heavy = heavy_from_counts(copies, ["key"], "copies", without)
    placed = keyed.withColumn("_place", F.monotonically_increasing_id())
    return left_join(placed, cut_lineage(measures), ["key"], heavy, "_place").drop("_place")


def digest(docs: DataFrame, byte_file: str, piece_file: str) -> DataFrame:
    """One row per document: doc_id, its measures and the digest of its groups; zeros without tokens."""
    names = [*MEASURES, "n_best", "count_sum"]
    rows, _ = align(docs, byte_file, piece_file)
    zeros = [F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n) for n in names]
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), *zeros, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
