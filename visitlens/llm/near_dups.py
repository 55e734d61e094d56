"""Near-duplicates by consistent weighted sampling over TF-IDF shingles.

Weights. A document is the bag of its five-word shingles (A-Z lower-cased, hashed to 64 bits; a
shorter one is one shingle of all its words). A shingle weighs its count times an inverse
document frequency: ln(N/df), no more than ln(1/RARE), mapped linearly to [1 - SPREAD, 1]. The
spread is bounded because a group of copies may hold a third of all documents, and the text its
members share must then still decide; with it, weighted and plain similarity differ by about
two points at most. Shingles in fewer than RARE of the documents all weigh 1, so only frequent ones
need their exact frequency; there are at most (mean length / RARE) of them whatever the input's size.
They are found in two passes: a shingle with df >= RARE * N must be that frequent in some
chunk, up to half; the candidates are then counted exactly.

Samples. Improved consistent weighted sampling draws for each (shingle, k) r and c from
Gamma(2, 1) and b from U(0, 1), all functions of their hash; t = floor(ln w / r + b); the
sample k is the (shingle, t) with the least ln c - r (t - b + 1). Two documents agree in a
sample with a probability equal to their weighted Jaccard similarity.

Links. Texts with equal words are one node. Nodes that agree in all samples of a band share a
bucket. The members of each bucket meet a hub and their neighbours in the order of the next bands, which
gathers most of a group of near copies into one component at linear cost. Then all pairs of members of a
bucket that still lie in different components are decided: their nodes get longer rows of samples, these are
compared tile by tile, and pairs that agree in enough of them are verified by weighted Jaccard on whole
texts. So the classes are the components of all similar pairs that share a bucket, whatever the
hubs were. Components are found in Spark, and later links only merge components found before.

Defined cases: a null text or one without words is never linked and is its own class. Rows with
equal doc_id and text stay or go together. Null ids are the smallest of a class. Other columns
are ignored or, in ``keep_one_each``, kept.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitlens.llm.common import if_small, on_workers, stored
from visitlens.llm.components import counted_components
from visitlens.llm.kneser_ney import add_up, locate, narrow, pack, unpack
from visitlens.llm.word_hashes import mix, word_hashes
from visitlens.operators.slices import SLICE, running_sums, store_sliced
from visitlens.session import cut_lineage

WIDTH = 5
RARE = 1e-3
SPREAD = 0.1
BANDS = 12
ROWS = 4
SAMPLES = BANDS * ROWS
AGREEING = 26  # of 48 samples; a pair of similarity 0.8 has fewer with a chance of about 1 in 75,000
LONG = 256  # samples of nodes whose pairs are all decided
LONG_AGREEING = 176  # of 256; a pair of similarity 0.8 has fewer with a chance of about 1 in 100,000
TILE = 256  # members of a bucket in a tile at most, and bytes of their texts
TILE_BYTES = 8 << 20
CHUNK = 2_000_000
_PLACES = np.arange(1, WIDTH + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)


def shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of the shingles of a text, from hashes of its words."""
    width = min(WIDTH, len(words))
    if not width:
        return words
    count = len(words) - width + 1
    total = np.full(count, width, dtype=np.uint64)
    for k in range(width):
        placed = words[k : k + count] * _PLACES[k]
        total += placed ^ (placed >> np.uint64(29))
    return mix(total)


def run_lengths(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a sorted array and how often each occurs."""
    if len(ordered) < 2:
        return ordered, np.ones(len(ordered), np.int64)
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    return ordered[starts], np.diff(np.append(starts, len(ordered)))


def bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of a text and their counts."""
    return run_lengths(np.sort(shingles(word_hashes(text))))


def _bags(batches, chunk: int):
    """(batch, first row, bags) with about ``chunk`` shingles each."""
    for batch in batches:
        texts, held, size, start = batch.column(batch.schema.get_field_index("text")), [], 0, 0
        for row, text in enumerate(texts):
            held.append(bag(text.as_py()))
            size += len(held[-1][0])
            if size >= chunk or row + 1 == len(texts):
                yield batch, start, held
                held, size, start = [], 0, row + 1


class Weights:
    """Inverse document frequencies of frequent shingles; all others weigh 1."""

    def __init__(self, keys: np.ndarray, frequencies: np.ndarray, documents: int):
        self.keys = keys
        share = np.log(documents / frequencies) / math.log(1 / RARE) if len(keys) else np.zeros(0)
        self.idf = 1 - SPREAD * (1 - np.clip(share, 0, 1))

    def of(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        out = counts.astype(np.float64)
        place, hit = locate(self.keys, keys)
        out[hit] *= self.idf[place]
        return out


def frequent_shingles(docs: DataFrame) -> Weights:
    """Exact document frequencies of all shingles in at least RARE of the documents."""
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = on_workers(docs).select("text")

    def locally_frequent(batches):
        for _, _, held in _bags(batches, CHUNK):
            keys, n = run_lengths(np.sort(np.concatenate([k for k, _ in held])))
            keep = n >= RARE * len(held) / 2
            keys, n = keys[keep], n[keep]
            bucket = (keys >> np.uint64(32)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            some = np.flatnonzero(cuts[1:] > cuts[:-1])
            parts = [order[cuts[b] : cuts[b + 1]] for b in some]
            blobs = [pack(k=keys[p], n=narrow(n[p])) for p in parts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array(blobs, pa.binary()), pa.array([0] * len(some), pa.int64())],
                names=["bucket", "blob", "documents"],
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array([-1], pa.int32()), pa.array([b""], pa.binary()), pa.array([len(held)], pa.int64())],
                names=["bucket", "blob", "documents"],
            )

    local = cut_lineage(texts.mapInArrow(locally_frequent, "bucket int, blob binary, documents long"))
    documents = local.agg(F.sum("documents")).first()[0] or 0

    def candidates(pdf):
        parts = [unpack(b) for b in pdf["blob"]]
        keys, _, (n,) = add_up(np.concatenate([p["k"] for p in parts]), np.concatenate([p["n"].astype(np.int64) for p in parts]))
        return pd.DataFrame({"key": keys[n >= RARE * documents / 2].view(np.int64)})

    # Arrow arrays: where texts are few, every shingle is frequent, and a Python object for each would fill the driver
    found = local.where(F.col("bucket") >= 0).groupBy("bucket").applyInPandas(candidates, "key long").toArrow()
    wanted = np.sort(found["key"].to_numpy().view(np.uint64))
    if not len(wanted):
        return Weights(wanted, wanted, documents)
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def count(batches):
        n = np.zeros(len(shared.value), np.int64)
        for _, _, held in _bags(batches, CHUNK):
            for keys, _ in held:
                n[locate(shared.value, keys)[0]] += 1
        held_keys = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(held_keys), pa.array(n[held_keys])], names=["place", "n"])

    total = np.zeros(len(wanted), np.int64)
    counts = texts.mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    total[counts["place"].to_numpy()] = counts["n"].to_numpy()
    often = total >= RARE * documents
    return Weights(wanted[often], total[often], documents)


class Sampler:
    """Consistent weighted samples of bags; draws come from tables indexed by bits of a hash."""

    BITS = 12  # of the hash for each draw: tables that stay in the processor's nearest cache
    #: Added to every ln a, which keeps them positive: positive floats are ordered as their bits are.
    ABOVE = np.float32(64)

    def __init__(self, seed: int = 7, samples: int = SAMPLES):
        rng = np.random.default_rng(seed)
        size = 1 << self.BITS
        self.count = samples
        self.r = rng.gamma(2.0, 1.0, size).astype(np.float32)
        self.one_by_r = (1 / self.r).astype(np.float32)
        self.ln_c = np.log(rng.gamma(2.0, 1.0, size)).astype(np.float32) + self.ABOVE
        self.rest = (1 - np.arange(size) / size).astype(np.float32)  # 1 - b
        self.odd = rng.integers(0, 1 << 63, samples, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def block(self, keys: np.ndarray, weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Samples (bags x count) as 32-bit hashes of (shingle, t)."""
        n, mask = len(keys), (1 << self.BITS) - 1
        other = np.flatnonzero(weights != 1)  # a shingle of weight 1 has t = 0, whatever is drawn
        ln_w = np.log(weights[other]).astype(np.float32)
        low = (keys >> np.uint64(7)).astype(np.uint32)
        held = np.empty((n, 2), dtype=np.uint32)  # as one number: ln a above the hash of what is sampled
        ordered, ln_a = held.view(np.uint64)[:, 0], held.view(np.float32)[:, 1]
        z, place = np.empty(n, np.uint64), np.empty(n, np.int64)
        ln_c, r, rest = (np.empty(n, np.float32) for _ in range(3))
        out = np.empty((len(starts), self.count), dtype=np.uint32)
        for k in range(self.count):
            np.multiply(keys, self.odd[k], out=z)
            z ^= z >> np.uint64(31)
            for shift, table, drawn in ((50, self.r, r), (37, self.ln_c, ln_c), (24, self.rest, rest)):
                np.right_shift(z.view(np.int64), shift, out=place)
                np.bitwise_and(place, mask, out=place)
                np.take(table, place, out=drawn, mode="clip")
                if len(other) and table is self.r:
                    one_by_r = self.one_by_r.take(place[other])
            held[:, 0] = low
            np.subtract(ln_c, r * rest, out=ln_a)
            if len(other):
                some = rest[other]
                t = np.floor(ln_w * one_by_r + np.float32(1) - some)
                held[other, 0] += t.astype(np.int32).view(np.uint32) * np.uint32(0x9E3779B1)
                ln_a[other] = np.maximum(ln_c[other] - r[other] * (t + some), 0)
            out[:, k] = np.minimum.reduceat(ordered, starts).astype(np.uint32)
        return out

    def samples(self, bags: list[tuple[np.ndarray, np.ndarray]], block: int = 16_384) -> np.ndarray:
        """Rows of samples for bags (shingles, weights) that are not empty."""
        out, at = np.empty((len(bags), self.count), dtype=np.uint32), 0
        while at < len(bags):
            stop, size = at, 0
            while stop < len(bags) and (stop == at or size + len(bags[stop][0]) <= block):
                size += len(bags[stop][0])
                stop += 1
            keys, weights = (np.concatenate([b[j] for b in bags[at:stop]]) for j in (0, 1))
            starts = np.cumsum([0] + [len(b[0]) for b in bags[at : stop - 1]])
            out[at:stop] = self.block(keys, weights, starts)
            at = stop
        return out


def band_hashes(samples: np.ndarray) -> np.ndarray:
    """One 64-bit hash per band and document."""
    parts = samples.astype(np.uint64).reshape(len(samples), BANDS, ROWS)
    out = np.tile(mix(np.arange(1, BANDS + 1, dtype=np.uint64)), (len(samples), 1))
    for j in range(ROWS):
        out = mix(out + parts[:, :, j] * np.uint64(0x9E3779B97F4A7C15))
    return out


def signatures(docs: DataFrame, weights: Weights) -> DataFrame:
    """doc_id, body, node (hash of the words; null without words), bands and samples; stored."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def sign(batches):
        sampler = Sampler()
        for batch, start, held in _bags(batches, CHUNK // 8):
            texts = batch.column(batch.schema.get_field_index("text")).slice(start, len(held))
            full = [i for i, (keys, _) in enumerate(held) if len(keys)]
            bags = [(held[i][0], shared.value.of(*held[i])) for i in full]
            samples = sampler.samples(bags)
            bands, nodes = [None] * len(held), [None] * len(held)
            short = [None] * len(held)
            for i, band, row in zip(full, band_hashes(samples).view(np.int64), samples.astype(np.uint16)):
                bands[i], short[i] = band, row.tobytes()
                nodes[i] = hashlib.blake2b(b" ".join(texts[i].as_py().encode("utf-8", "replace").lower().split()), digest_size=16).digest()
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)).slice(start, len(held)) for c in ("doc_id", "body")),
                 pa.array(nodes, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(short, pa.binary())],
                names=["doc_id", "body", "node", "bands", "samples"],
            )

    rows = on_workers(docs).select("doc_id", F.xxhash64("text").alias("body"), "text")
    return cut_lineage(rows.mapInArrow(sign, "doc_id long, body long, node binary, bands array<long>, samples binary"))


def shared_buckets(nodes: DataFrame) -> DataFrame:
    """Rows of buckets with two nodes or more, stored.

    bucket, node, the node's hashes in the next two bands (``then``, ``next``), and its weight:
    the rows of all its buckets.
    """
    after = lambda i, k: F.get("bands", F.pmod(i + F.lit(k), F.lit(BANDS)))
    entry = F.transform("bands", lambda b, i: F.struct(b.alias("bucket"), after(i, 1).alias("then"), after(i, 2).alias("next")))
    rows = nodes.select("node", F.inline(entry))
    several = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    met = rows.join(several, "bucket").groupBy("node").agg(
        F.sum("n").alias("weight"), F.collect_list(F.struct("bucket", "then", "next")).alias("all")  # one per band at most
    )
    return cut_lineage(met.select("node", "weight", F.inline("all")))


def neighbours(buckets: DataFrame) -> DataFrame:
    """Pairs (a < b) of nodes that follow each other in a bucket sorted by the hashes of the next bands.

    Nodes that agree in further bands stand together, so in a large bucket each node meets the
    ones most like it. Buckets are cut into stored ranges; none has to fit into a task. The last
    row of each range meets the first of the next.
    """
    order = ["bucket", "then", "next", "node"]
    before = F.lag("node").over(Window.partitionBy(SLICE, "bucket").orderBy(*order[1:]))
    stored = store_sliced(buckets.select(*order), order)
    inside = stored.select("node", before.alias("before")).where(F.col("before").isNotNull())
    ends = stored.groupBy(SLICE).agg(F.min(F.struct(*order)).alias("first"), F.max(F.struct(*order)).alias("last"))
    ends = ends.withColumn("left", F.lag("last").over(Window.orderBy(SLICE)))  # one row per range
    across = ends.where(F.col("left.bucket") == F.col("first.bucket")).select("first.node", F.col("left.node").alias("before"))
    met = inside.union(across)
    return met.select(F.least("node", "before").alias("a"), F.greatest("node", "before").alias("b")).distinct()


def candidate_pairs(buckets: DataFrame) -> DataFrame:
    """Pairs (a < b) of members of a bucket and its hub.

    The hub is the node with the largest buckets: the centre of a group of near copies is in most of them.
    """
    heads = buckets.groupBy("bucket").agg(F.max_by("node", F.struct("weight", "node")).alias("hub"))
    met = buckets.join(heads, "bucket").where(F.col("node") != F.col("hub"))
    return met.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


@dataclass(frozen=True)
class Roots:
    """The components of nodes with links (node, root), stored, with their number; other nodes are their own."""

    table: DataFrame
    count: int

    @staticmethod
    def of(links: DataFrame, rows: int | None = None) -> Roots:
        return Roots(*counted_components(links, rows=rows))

    def after(self, links: DataFrame, rows: int | None = None) -> Roots:
        """The components after linking some of them (root_a, root_b)."""
        changes = Roots.of(links.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")), rows)
        moved = changes.on(self.table, "root", "new").select("node", F.col("new").alias("root"))
        return Roots(*stored(moved.union(changes.table.select("node", "root"))))

    def on(self, rows: DataFrame, node: str, root: str) -> DataFrame:
        """``rows`` with the component of a column's nodes in the column ``root``."""
        named = self.table.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
        met = rows.join(if_small(named, self.count), F.col(node) == F.col("_node"), "left")
        kept = [c for c in rows.columns if c != root]
        return met.select(*kept, F.coalesce("_root", node).alias(root))


def agreeing(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many samples each row of ``left`` shares with each row of ``right``."""
    if len(left) * len(right) <= 1_024:
        return (left[:, None, :] == right[None, :, :]).sum(axis=2)
    out = np.zeros((len(left), len(right)), np.uint16)
    for k in range(left.shape[1]):
        out += left[:, k][:, None] == right[:, k][None, :]
    return out


def open_members(buckets: DataFrame, roots: Roots) -> DataFrame:
    """(bucket, node, root) of the buckets whose members lie in different components, stored.

    Buckets of two are left out: their only pair met as hub and member.
    """
    rows = roots.on(buckets.select("bucket", "node"), "node", "root")
    several = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("root").alias("lo"), F.max("root").alias("hi"))
    several = several.where((F.col("size") > 2) & (F.col("lo") != F.col("hi"))).select("bucket")
    return cut_lineage(rows.join(several, "bucket"))


def long_samples(held: DataFrame, nodes: DataFrame, members: DataFrame, weights: Weights) -> DataFrame:
    """(node, bands, text, long) of the members, with LONG samples drawn apart from those of the bands; stored."""
    shared = held.sparkSession.sparkContext.broadcast(weights)
    names = if_small(*stored(members.select(F.col("node").alias("_member")).distinct()))
    banded = nodes.join(names, F.col("node") == F.col("_member")).select(F.col("node").alias("_wanted"), "bands")
    wanted = if_small(*stored(banded))

    def sign(batches):
        sampler = Sampler(11, LONG)
        for batch, start, bags in _bags(batches, CHUNK // 32):
            samples = sampler.samples([(keys, shared.value.of(keys, counts)) for keys, counts in bags]).astype(np.uint16)
            kept = [batch.column(batch.schema.get_field_index(c)).slice(start, len(bags)) for c in ("node", "bands", "text")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array([row.tobytes() for row in samples], pa.binary())], names=["node", "bands", "text", "long"])

    texts = held.join(wanted, F.col("node") == F.col("_wanted")).select("node", "bands", "text")
    return cut_lineage(texts.mapInArrow(sign, "node binary, bands array<long>, text string, long binary"))


def open_links(members: DataFrame, sampled: DataFrame, weights: Weights, similarity: float) -> tuple[DataFrame, int]:
    """Links (root_a, root_b) between components, from all similar pairs of members of a bucket that lie in different ones.

    The members of a bucket stand in order of their components and are cut into tiles of bounded bytes; all pairs of tiles
    meet but those within one component, so a bucket of any size is spread over tasks. In a unit of two tiles, pairs
    that agree in enough of LONG samples are verified on whole texts, the likeliest first, but for those whose components
    have been linked in the unit before. A pair that shares several buckets is decided in the least of them.
    Stored, and counted.
    """
    shared = members.sparkSession.sparkContext.broadcast(weights)
    size = F.greatest(F.octet_length("text"), F.lit(TILE_BYTES // TILE)).cast("long").alias("size")
    sizes = sampled.select(F.col("node").alias("_node"), size)
    ranges = store_sliced(members.join(sizes, F.col("node") == F.col("_node")).drop("_node"), ["bucket", "root", "node"])
    placed = running_sums(ranges, {"place": "size"}, ["root", "node"], ["bucket"])
    placed = cut_lineage(placed.select("bucket", "node", "root", F.floor(F.col("place") / TILE_BYTES).cast("int").alias("tile")))

    tiles = placed.groupBy("bucket", "tile").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    one, two = (tiles.select("bucket", F.col("tile").alias(c), F.col("lo").alias(f"lo_{c}"), F.col("hi").alias(f"hi_{c}")) for c in ("i", "j"))
    units = one.join(two, "bucket").where("i <= j AND NOT (lo_i = hi_i AND lo_j = hi_j AND lo_i = lo_j)")
    units = units.select("bucket", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("tile"))
    sampled = sampled.withColumnRenamed("node", "_node")
    dealt = placed.join(units, ["bucket", "tile"]).join(sampled, F.col("node") == F.col("_node"))
    dealt = dealt.select("bucket", "i", "j", "tile", "root", "bands", "long", "text")
    dealt = dealt.repartition(F.col("bucket"), F.col("i"), F.col("j")).sortWithinPartitions("bucket", "i", "j", "tile")

    def compare(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table]).combine_chunks()
            keys = np.stack([table.column(c).to_numpy() for c in ("bucket", "i", "j")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            starts = [0, *cuts.tolist()]
            for start, stop in zip(starts, starts[1:]):
                yield linked(table.slice(start, stop - start))
            rest = table.slice(starts[-1])  # a unit may go on in the next batch
        if rest is not None and rest.num_rows:
            yield linked(rest)

    def linked(unit):
        root, text = unit.column("root").to_pylist(), unit.column("text")
        bucket, first = unit.column("bucket")[0].as_py(), unit.column("i")[0].as_py()
        held = np.frombuffer(b"".join(unit.column("long").to_pylist()), np.uint16).reshape(-1, LONG)
        bands = np.array(unit.column("bands").to_pylist(), dtype=np.int64)
        component = np.unique(np.array(root, dtype=object), return_inverse=True)[1]
        middle = int((unit.column("tile").to_numpy() == first).sum())
        alike = middle == len(root)  # a tile with itself
        other = 0 if alike else middle
        n = agreeing(held[:middle], held[other:])
        near = (n >= LONG_AGREEING) & (component[:middle][:, None] != component[other:][None, :])
        x, y = np.nonzero(np.triu(near) if alike else near)
        common = np.where(bands[x] == bands[other + y], bands[x], np.iinfo(np.int64).max)
        mine = common.min(axis=1, initial=np.iinfo(np.int64).max) == bucket
        x, y = x[mine], y[mine]
        order = np.argsort(-n[x, y].astype(np.int64), kind="stable")
        bags: dict[int, tuple] = {}
        parent = list(range(int(component.max()) + 1))
        links = set()

        def weighed(k: int) -> tuple:
            if k not in bags:
                keys, counts = bag(text[k].as_py())
                bags[k] = (keys, shared.value.of(keys, counts))
            return bags[k]

        def find(c: int) -> int:
            while parent[c] != c:
                parent[c] = c = parent[parent[c]]
            return c

        for p, q in zip(x[order].tolist(), (other + y[order]).tolist()):
            low, high = find(component[p]), find(component[q])
            if low != high and weighted_jaccard(weighed(p), weighed(q)) >= similarity - 1e-9:
                parent[high] = low
                links.add((root[p], root[q]))
        columns = list(zip(*sorted(links))) or [[], []]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], names=["root_a", "root_b"])

    return stored(dealt.mapInArrow(compare, "root_a binary, root_b binary").distinct())


def weighted_jaccard(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of smaller weights over sum of larger weights of two bags."""
    place, hit = locate(left[0], right[0])
    common = float(np.minimum(left[1][place], right[1][hit]).sum())
    both = float(left[1].sum() + right[1].sum())
    return common / (both - common) if both > common else 1.0


def verified(pairs: DataFrame, held: DataFrame, weights: Weights, similarity: float) -> tuple[DataFrame, int]:
    """Stored pairs that agree in enough samples and whose whole texts are similar enough, stored and counted.

    ``held`` has samples and text of every node; only those in pairs are moved.
    """
    asked = if_small(*stored(pairs.select(F.explode(F.array("a", "b")).alias("_asked")).distinct()))
    held = cut_lineage(held.join(asked, F.col("node") == F.col("_asked")).drop("_asked"))
    left, right = (
        held.select(F.col("node").alias(c), F.struct("samples", "text").alias(f"of_{c}")) for c in ("a", "b")
    )
    shared = pairs.sparkSession.sparkContext.broadcast(weights)

    def check(batches):
        last: dict[str, tuple] = {}

        def weighed(side: str, text: str):
            if last.get(side, (None,))[0] != text:
                keys, counts = bag(text)
                last[side] = (text, (keys, shared.value.of(keys, counts)))
            return last[side][1]

        for batch in batches:
            keep = []
            for one, two in zip(*(batch.column(batch.schema.get_field_index(c)) for c in ("of_a", "of_b"))):
                agreeing = np.frombuffer(one["samples"].as_py(), np.uint16) == np.frombuffer(two["samples"].as_py(), np.uint16)
                keep.append(
                    int(agreeing.sum()) >= AGREEING
                    and weighted_jaccard(weighed("a", one["text"].as_py()), weighed("b", two["text"].as_py())) >= similarity - 1e-9
                )
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    met = pairs.join(left, "a").join(right, "b").select("a", "b", "of_a", "of_b")
    return stored(met.mapInArrow(check, pairs.schema))


def classes(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """doc_id, body (hash of the text), class_id (its smallest doc_id) and class_size; one row per document."""
    docs = docs.select("doc_id", "text")
    weights = frequent_shingles(docs)
    signed = signatures(docs, weights)
    worded = signed.where(F.col("node").isNotNull())
    nodes = cut_lineage(
        worded.groupBy("node").agg(
            F.min(F.struct("doc_id", "body")).alias("first"), F.first("bands").alias("bands"), F.first("samples").alias("samples")
        )
    )
    buckets = shared_buckets(nodes)
    near, n = stored(candidate_pairs(buckets).union(neighbours(buckets)).distinct())
    if not n:  # no bucket has two nodes
        return _members(signed, None)
    held = node_texts(docs, nodes, buckets)
    roots = Roots.of(*verified(near, held, weights, similarity))
    members = open_members(buckets, roots)
    links, n = open_links(members, long_samples(held, nodes, members, weights), weights, similarity)
    return _members(signed, roots.after(links, n) if n else roots)


def node_texts(docs: DataFrame, nodes: DataFrame, buckets: DataFrame) -> DataFrame:
    """Samples and one text of each node that shares a bucket, stored."""
    sharing = if_small(*stored(buckets.select(F.col("node").alias("_met")).distinct()))
    met = nodes.join(sharing, F.col("node") == F.col("_met"))
    held, n = stored(met.select("node", "samples", F.col("first.doc_id").alias("_id"), F.col("first.body").alias("_body")))
    on = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_body"))
    found = docs.join(if_small(held, n), on).groupBy("node")
    return cut_lineage(found.agg(F.first("samples").alias("samples"), F.first("text").alias("text")))


def _members(signed: DataFrame, roots: Roots | None) -> DataFrame:
    rows = signed.select("doc_id", "body", "node")
    if roots is not None:
        named = roots.table.select(F.col("node").alias("_node"), "root")
        rows = rows.join(named, F.col("node") == F.col("_node"), "left").drop("_node")
    else:
        rows = rows.withColumn("root", F.lit(None).cast("binary"))
    rows = rows.withColumn("_class", F.coalesce("root", "node")).select("doc_id", "body", "_class")
    sizes = rows.where(F.col("_class").isNotNull()).groupBy("_class").agg(
        F.min(F.struct("doc_id", "body")).alias("_first"), F.count(F.lit(1)).alias("_size")
    )
    sizes = sizes.withColumnRenamed("_class", "_key")
    out = rows.join(sizes, F.col("_class") == F.col("_key"), "left")
    alone = F.col("_class").isNull()
    return out.select(
        "doc_id", "body",
        F.when(alone, F.col("doc_id")).otherwise(F.col("_first.doc_id")).alias("class_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("class_size"),
        (alone | (F.struct("doc_id", "body") == F.col("_first"))).alias("kept"),
    )


def keep_one_each(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """The documents, one of each class."""
    kept = classes(docs, similarity).where("kept").select(F.col("doc_id").alias("_id"), F.col("body").alias("_body")).distinct()
    on = docs["doc_id"].eqNullSafe(kept["_id"]) & (F.xxhash64(docs["text"]) == kept["_body"])
    return docs.join(kept, on, "left_semi")


def digest(docs: DataFrame) -> DataFrame:
    return classes(docs).drop("body")
