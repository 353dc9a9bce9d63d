"""Near-duplicate documents: banded MinHash, sequential Bayesian verification, exact confirmation.

Documents with the same shingle set form one class and go on as one. Bands of signatures give
buckets of candidate classes. A pair's signature is compared batch by batch: after ``n`` positions
with ``m`` matches, the posterior of its similarity (uniform prior, so Beta(m + 1, n - m + 1)) is at
least ``threshold`` with some probability; below ``miss`` the pair is given up. What remains is
confirmed on whole shingle sets.

A bucket is never turned into all its pairs. Its most popular class, whose band values are shared
most often, is compared with the other members, and links found so are contracted into components.
After that only members of different components are compared with each other, in tiles of
bounded size, a pair in the first bucket that it shares. No bucket is capped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from cohortflow.llm.common import MIX, ODD, drop_stage, mixed, slices, stage, texts_of, tidied, without, words_of
from cohortflow.llm.components import components

SHINGLE = 5
THRESHOLD = 75  # per cent
BANDS = 32
BAND_ROWS = 5
POSITIONS = 256
BATCH = 32
MISS = 1e-3
LEADER_ROUNDS = 1
BLOCK = 256
SLICE = 1 << 20

SKETCH = "doc_id bigint, n_shingles bigint, k1 bigint, k2 bigint, bands binary, signature binary"


def shingle_set(words: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``size``-word shingles; a shorter text is one shingle."""
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    size = min(size, len(words))
    rolled = hashes[: len(hashes) - size + 1]
    for k in range(1, size):
        rolled = mixed(rolled) + hashes[k : len(hashes) - size + 1 + k]
    return np.unique(mixed(rolled + np.uint64(size)))


@lru_cache(maxsize=4)
def multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers of the ``n`` hash functions, the same in every process."""
    seeds = mixed(np.arange(1, 2 * n + 1, dtype=np.uint64) * ODD)
    odd = (seeds >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    return odd[:n], odd[n:]


def signatures(sets: list[np.ndarray], n: int = POSITIONS) -> np.ndarray:
    """A row of ``n`` 32-bit minima for each non-empty set."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    low, high = flat.astype(np.uint32), (flat >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(sets), n), np.uint32)
    for i, (a, b) in enumerate(zip(*multipliers(n))):
        out[:, i] = np.minimum.reduceat(low * a + high * b, starts)
    return out


def low_bytes(minima: np.ndarray) -> np.ndarray:
    """One well-mixed byte of each minimum."""
    return ((minima * np.uint32(2654435761)) >> np.uint32(24)).astype(np.uint8)


def band_values(minima: np.ndarray, bands: int = BANDS, rows: int = BAND_ROWS) -> np.ndarray:
    """A 32-bit value of each band of ``rows`` minima."""
    parts = minima[:, : bands * rows].reshape(len(minima), bands, rows).astype(np.uint64)
    rolled = parts[:, :, 0]
    for k in range(1, rows):
        rolled = mixed(rolled) + parts[:, :, k]
    return (mixed(rolled) >> np.uint64(32)).astype(np.uint32)


def sketch(documents: DataFrame) -> DataFrame:
    """Per document: size of its shingle set, a 128-bit digest of the set, its band values and signature.

    A band value is a 32-bit hash of the band's minima. The signature keeps one byte of each minimum: bytes
    that agree by chance (1 of 256) only make a pair look more similar, so nothing is pruned for them.
    An empty set (null or blank text) has null digests and no signature.
    """

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                sets = [shingle_set(words_of(text)) for text in part.column("text").to_pylist()]
                full = [s for s in sets if len(s)]
                here = np.array([len(s) for s in sets])
                k1, k2 = np.zeros(len(sets), np.int64), np.zeros(len(sets), np.int64)
                rows: list[bytes | None] = [None] * len(sets)
                values: list[bytes | None] = [None] * len(sets)
                if full:
                    flat, at = np.concatenate(full), np.cumsum([0, *(len(s) for s in full[:-1])])
                    k1[here > 0] = np.add.reduceat(mixed(flat ^ MIX), at).view(np.int64)
                    k2[here > 0] = np.add.reduceat(mixed(flat + ODD), at).view(np.int64)
                    minima = signatures(full)
                    for row, signature, value in zip(np.flatnonzero(here), low_bytes(minima), band_values(minima)):
                        rows[row], values[row] = signature.tobytes(), value.tobytes()
                empty = here == 0
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(here, pa.int64()),
                        pa.array(k1, mask=empty),
                        pa.array(k2, mask=empty),
                        pa.array(values, pa.binary()),
                        pa.array(rows, pa.binary()),
                    ],
                    ["doc_id", "n_shingles", "k1", "k2", "bands", "signature"],
                )

    return texts_of(documents).mapInArrow(tidied(sketched), SKETCH)


def shingle_sets(documents: DataFrame) -> DataFrame:
    """``doc_id`` and the sorted hashes of its whole shingle set as bytes."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                sets = [shingle_set(words_of(text)).tobytes() for text in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sets, pa.binary())], ["doc_id", "payload"])

    return texts_of(documents).mapInArrow(tidied(made), "doc_id bigint, payload binary")


@lru_cache(maxsize=8)
def least_matches(total: int, threshold: int = THRESHOLD, miss: float = MISS, batch: int = BATCH) -> tuple[tuple[int, int], ...]:
    """(positions compared, matches needed to go on) after each batch.

    P(similarity >= t | m of n match) is the chance that Binomial(n + 1, t) is at most m.
    """
    t = threshold / 100
    steps = []
    for n in [*range(batch, total, batch), total]:
        chance = 0.0
        for m in range(n + 2):
            chance += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if chance >= miss:
                steps.append((n, m))
                break
    return tuple(steps)


def likely(one: np.ndarray, many: np.ndarray, threshold: int = THRESHOLD, miss: float = MISS) -> np.ndarray:
    """Rows of ``many`` whose similarity to ``one`` no batch of positions has ruled out."""
    alive = np.arange(len(many))
    matches = np.zeros(len(many), np.int64)
    before = 0
    for n, needed in least_matches(len(one), threshold, miss):
        matches = matches + (many[alive, before:n] == one[before:n]).sum(1)
        alive, matches = alive[matches >= needed], matches[matches >= needed]
        before = n
        if not len(alive):
            break
    return alive


def similar(a: np.ndarray, b: np.ndarray, threshold: int = THRESHOLD) -> bool:
    """100 * intersection >= threshold * union, on whole sets."""
    if 100 * min(len(a), len(b)) < threshold * max(len(a), len(b)):
        return False
    at = np.searchsorted(b, a)
    common = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * common >= threshold * (len(a) + len(b) - common)


def in_tiles(tiles: DataFrame, payloads: DataFrame, check: Callable) -> DataFrame:
    """Pairs (a, b) that ``check`` lets through, from tiles of bounded left sides.

    ``tiles`` has tile (long), side (0 or 1), node, component, band. A task gets its tiles sorted, keeps the
    left side of one tile and streams the right side past it; nodes of one component are not paired. ``check``
    gets a right payload, the left payloads as an array of bytes or a list, the rows to look at, and the band.
    """
    rows = (
        tiles.join(payloads, "node")
        .repartition("tile")
        .sortWithinPartitions("tile", "side", "node")
        .select("tile", "side", "node", "component", "band", "payload")
    )

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile = None
        nodes, parts, held, block = [], [], [], None
        for batch in batches:
            found: list[tuple[int, int]] = []
            columns = [batch.column(name).to_pylist() for name in ("tile", "side", "node", "component", "band", "payload")]
            for at, side, node, part, band, payload in zip(*columns):
                if at != tile:
                    tile, nodes, parts, held, block = at, [], [], [], None
                value = np.frombuffer(payload, np.uint8)
                if not side:
                    nodes.append(node)
                    parts.append(part)
                    held.append(value)
                    continue
                if block is None:
                    ids, of = np.array(nodes, np.int64), np.array(parts, np.int64)
                    block = np.stack(held) if len({len(x) for x in held}) == 1 else held
                if not nodes:
                    continue
                for row in check(value, block, np.flatnonzero((of != part) & (ids != node)), band):
                    found.append((min(node, nodes[row]), max(node, nodes[row])))
            if found:
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return rows.mapInArrow(tidied(paired), "a bigint, b bigint").distinct()


def by_signature(one: np.ndarray, many: np.ndarray, rows: np.ndarray, band: int) -> np.ndarray:
    """Candidates among ``rows`` that the posterior bound leaves; with a band, only if it is the first they share."""
    n = POSITIONS
    if band > 0 and len(rows):
        own, theirs = one[n : n + 4 * band].view(np.uint32), np.ascontiguousarray(many[rows, n : n + 4 * band]).view(np.uint32)
        rows = rows[~(theirs == own).any(1)]
    return rows[likely(one[:n], many[rows, :n])] if len(rows) else rows


def by_set(one: np.ndarray, many: np.ndarray | list[np.ndarray], rows: np.ndarray, band: int) -> list[int]:
    """Candidates among ``rows`` whose whole sets are similar."""
    own = one.view(np.uint64)
    return [row for row in rows if similar(own, many[row].view(np.uint64))]


def confirm(pairs: DataFrame, documents: DataFrame) -> DataFrame:
    """The pairs (a, b) of documents whose whole shingle sets are similar.

    Pairs are grouped under the end that has more of them, in blocks, so a large set is sent once per block.
    """
    sides = [pairs.groupBy(F.col(end).alias("node")).agg(F.count(F.lit(1)).alias("n")) for end in ("a", "b")]
    ends = stage(sides[0].unionByName(sides[1]).groupBy("node").agg(F.sum("n").alias("n")), "ends")
    sets = texts_of(documents).join(ends.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
    sets = stage(shingle_sets(sets).dropDuplicates(["doc_id"]), "sets")
    counted = pairs.join(ends.toDF("a", "n_a"), "a").join(ends.toDF("b", "n_b"), "b")
    first = F.col("n_a") >= F.col("n_b")
    turned = counted.select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("hub"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("other"), F.greatest("n_a", "n_b").alias("n"))
    dealt = stage(turned.select("hub", "other", F.xxhash64("hub", F.pmod(F.xxhash64("other"), F.ceil(F.col("n") / BLOCK))).alias("tile")), "dealt")
    zero = F.lit(0).cast("bigint")
    tiles = dealt.select("tile", F.lit(0).alias("side"), F.col("hub").alias("node"), zero.alias("component"), F.lit(-1).alias("band")).distinct()
    tiles = tiles.unionByName(dealt.select("tile", F.lit(1).alias("side"), F.col("other").alias("node"), (zero + 1).alias("component"), F.lit(-1).alias("band")))
    found = stage(in_tiles(tiles, sets.withColumnRenamed("doc_id", "node"), by_set), "links")
    for written in (sets, ends, dealt):
        drop_stage(written)
    return found


def buckets(classes: DataFrame, bands: int = BANDS) -> DataFrame:
    """``bucket`` (its band in the highest bits), ``node``, ``n`` (members) for buckets of at least two classes."""
    keys = F.array(*(F.xxhash64(F.lit(k), F.substring("bands", 1 + 4 * k, 4)) for k in range(bands)))
    members = classes.select("node", F.posexplode(keys).alias("band", "key")).withColumn("band", F.col("band").cast("bigint"))
    members = members.select("node", F.shiftleft("band", 56).bitwiseOR(F.shiftrightunsigned("key", 8)).alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return members.join(sizes, "bucket")


def led_pairs(members: DataFrame, popular: DataFrame, signed: DataFrame) -> DataFrame:
    """Candidates: in each bucket its leader against the members of other components.

    ``members``: bucket, node, component, main (whether of the bucket's largest component). The leader
    is the most popular member outside the main component where there is one.
    """
    ranked = members.join(popular, "node")
    rank = F.struct(~F.col("main"), F.col("popularity"), -F.col("node"))
    leaders = ranked.groupBy("bucket").agg(F.max_by(F.struct("node", "component"), rank).alias("leader"))
    pairs = (
        members.join(leaders, "bucket")
        .where("component <> leader.component")
        .select(F.col("leader.node").alias("hub"), F.col("leader.component").alias("hub_component"), "node", "component")
        .distinct()
    )
    sizes = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    dealt = pairs.join(sizes, "hub").withColumn("tile", F.xxhash64("hub", F.pmod(F.xxhash64("node"), F.col("blocks"))))
    hubs = dealt.select("tile", F.lit(0).alias("side"), F.col("hub").alias("node"), F.col("hub_component").alias("component")).distinct()
    others = dealt.select("tile", F.lit(1).alias("side"), "node", "component")
    return in_tiles(hubs.unionByName(others).withColumn("band", F.lit(-1)), signed, by_signature)


def crossing_pairs(members: DataFrame, signed: DataFrame) -> DataFrame:
    """Candidates: in each bucket every pair of members of different components, in tiles.

    Members outside the largest component (the rest) meet each other and the largest component.
    """
    sizes = members.groupBy("bucket").agg(F.count_if(~F.col("main")).alias("rest"), F.count_if("main").alias("most"))
    blocks = lambda n: F.greatest(F.ceil(F.col(n) / BLOCK), F.lit(1))
    rows = members.join(sizes, "bucket").withColumns({"rest": blocks("rest"), "most": blocks("most")})
    tile = F.xxhash64("bucket", "left", "right")
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    rest = rows.where("not main").withColumn("left", own("rest"))
    #: Right sides -1, -2, ... are blocks of the rest, 0, 1, ... blocks of the largest component.
    others = F.explode(F.sequence(-F.col("rest"), F.col("most") - 1))
    left = rest.select("bucket", "left", others.alias("right"), F.lit(0).alias("side"), "node", "component")
    right = rows.select(
        "bucket", upto("rest").alias("left"), F.when(F.col("main"), own("most")).otherwise(-1 - own("rest")).alias("right"), F.lit(1).alias("side"), "node", "component"
    )
    band = F.shiftright("bucket", 56).cast("int").alias("band")
    return in_tiles(left.unionByName(right).select(tile.alias("tile"), "side", "node", "component", band), signed, by_signature)


def unsettled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets that still hold more than one component, with ``component`` and ``main``.

    ``main`` marks the bucket's largest component, if that has more than one member.
    """
    placed = members.select("bucket", "node").join(labels, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component"))
    parts = placed.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("size"))
    largest = parts.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("parts"),
        F.max_by(F.struct("component", "size"), F.struct("size", -F.col("component"))).alias("top"),
    )
    main = (F.col("component") == F.col("top.component")) & (F.col("top.size") > 1)
    return placed.join(largest.where("parts > 1"), "bucket").select("bucket", "node", "component", main.alias("main"))


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable over links) and kept, a row per row.

    Two documents are linked if 100 * |intersection| >= 75 * |union| of their 5-word shingle sets. Empty
    sets are linked with nothing. Rows with the same doc_id are one document: same component, all kept
    or none. A row without doc_id is kept and linked with nothing. An empty table gives an empty result.
    """
    sketches = stage(sketch(documents), "sketches")
    classes = sketches.where("n_shingles > 0 and doc_id is not null").groupBy("k1", "k2").agg(F.min("doc_id").alias("node"), F.min_by(F.struct("bands", "signature"), "doc_id").alias("s")).select("k1", "k2", "node", "s.bands", "s.signature")
    classes = stage(classes, "classes")
    signed = classes.select("node", F.concat("signature", "bands").alias("payload"))
    members = stage(buckets(classes), "buckets")
    popular = stage(members.groupBy("node").agg(F.sum("n").alias("popularity")), "popular")

    links = None
    labels = None
    for step in range(LEADER_ROUNDS + 1):
        known = labels if labels is not None else members.select("node", F.col("node").alias("component")).limit(0)
        left = stage(unsettled(members, known), "unsettled")
        if left.isEmpty():
            break
        pairs = led_pairs(left, popular, signed) if step < LEADER_ROUNDS else crossing_pairs(left, signed)
        found = confirm(stage(pairs, "candidates"), documents)
        links = found if links is None else links.unionByName(found)
        labels = components(links)
        drop_stage(left)
    if labels is None:
        labels = classes.select("node", F.col("node").alias("component")).limit(0)

    rows = sketches.join(classes.select("k1", "k2", "node"), ["k1", "k2"], "left").join(labels, "node", "left")
    component = F.coalesce("component", "node", "doc_id")
    kept = F.coalesce(F.col("doc_id") == component, F.lit(True))
    return rows.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id"), kept.alias("kept"))


def keep_one(documents: DataFrame) -> DataFrame:
    """``documents`` with one document of each group of near-duplicates: the one with the smallest doc_id."""
    return without(documents, near_duplicates(documents).where("not kept"), "doc_id")
