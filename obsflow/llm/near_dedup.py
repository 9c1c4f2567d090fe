"""MinHash near-duplicates by an LSH forest (operator 3).

Each distinct set of word shingles gets a signature of MinHash values. The
forest is a number of sorted orders of all signatures, each beginning at
another place of the signature. Neighbours in an order share the longest
prefix with each other; they are candidates as soon as they share the first
value. So the depth adapts to the region: where few sets share a prefix, one
common value is enough; where many do, only those that agree much deeper stand
side by side, and the sets of such a region are sorted in further orders.
Sets that stand in a crowd in many orders, where two places may all go to
others, are at last compared exactly with each other, by a prefix filter on
their full sets. Candidates are confirmed on the full sets.

Equal sets are one class. Links inside what is already known to be one
component need no check, so a large group of near copies costs a few checks
per document, not one per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import forget, values, written
from .components import components

WORDS = 5
THRESHOLD = 75  # per cent of the union
VALUES = 128  # MinHash values of a signature
ORDERS = 32  # sorted orders of all sets
STEP = VALUES // ORDERS  # first values of an order that are not the first of another
MORE_ORDERS = 16  # further orders of the sets in dense regions
# Key of an order: a whole value, then one byte of each of the next ones.
DEPTH = 25
NEIGHBOURS = 2  # predecessors compared in each order
# First round: partners with which a set shares prefixes of so many values, over
# all orders in which they are neighbours; the best so many per set.
SURE, BEST = 12, 3
# Pairs between two components that are looked at after the further orders.
BETWEEN = 4
# Second round: candidates whose signatures agree in at least this share are
# confirmed. Five standard deviations (0.038) below the threshold.
LEAST_AGREEMENT = 0.56
# The same before the last, exact comparison: eight standard deviations (6e-16).
SURELY_UNLIKE = 0.44
# A component of this many sets is a dense region.
DENSE = 8
# In an order, a set is crowded if more sets share its first value than are all
# compared with each other. Two similar sets share the first values of fewer
# than CROWDED of the 32 orders with probability 4e-8, so a link can only be
# missed between two sets that are crowded in so many orders.
CROWDED = 10
# Else one of the two shares its first value with all it is compared with in more
# than 22 orders, and a similar set is among these in MET of them, but for a
# probability of 7e-10: pairs of less depth are no links.
MET = 4
# Bits of a set's parity map in the exact comparison.
PARITY_BITS = 1024
# Sets with one shingle in their prefixes that are compared in one piece.
BLOCK_SETS = 2_000
# Ids of sets to be confirmed are broadcast below this number (8 bytes each).
BROADCAST_IDS = 500_000
BLOCK = 1 << 22  # bytes of text hashed at once

_rng = np.random.Generator(np.random.PCG64(20240229))
_FACTORS = _rng.integers(0, 1 << 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TERMS = _rng.integers(0, 1 << 63, VALUES, dtype=np.uint64)
_BYTES = _rng.integers(0, 1 << 63, 256, dtype=np.uint64)
_PLACES = _rng.integers(0, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
# Places of the signature that make up each order: those of the first set of
# orders begin with values of their own, the rest is drawn at random.
_ORDERS = [np.r_[k * STEP : (k + 1) * STEP, _rng.permutation(np.delete(np.arange(VALUES), np.s_[k * STEP : (k + 1) * STEP]))][:DEPTH] for k in range(ORDERS)]
_MORE = [
    np.r_[first, _rng.permutation(np.delete(np.arange(VALUES), first))][:DEPTH]
    for first in _rng.choice(np.arange(0, VALUES, STEP), MORE_ORDERS, replace=False)
]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 ... base^(n-1) modulo 2^64."""
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out, dtype=np.uint64)


_UP, _DOWN = _powers(_BASE, 1 << 12), _powers(_BASE_INVERSE, 1 << 12)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(data: bytes) -> np.ndarray:
    """64-bit hash of each word of one block of bytes, by differences of one
    running sum of random byte values times powers."""
    global _UP, _DOWN
    b = np.frombuffer(data, np.uint8)
    if len(b) + 1 > len(_UP):
        _UP, _DOWN = _powers(_BASE, len(b) + 1), _powers(_BASE_INVERSE, len(b) + 1)
    inside = np.concatenate(([False], ~_SPACE[b], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[::2], edges[1::2]
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTES[b] * _UP[: len(b)], dtype=np.uint64)))
    return _mix((sums[end] - sums[start]) * _DOWN[start] + (end - start).astype(np.uint64))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles of five words; the
    whole sequence if there are fewer; nothing without words."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()  # lowers A-Z only
    parts, at = [], 0
    while at < len(data):
        end = at + BLOCK
        while end < len(data) and not _SPACE[data[end]]:
            end += 1
        parts.append(_word_hashes(data[at:end]))
        at = end
    words = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    if not len(words):
        return words
    n = min(WORDS, len(words))
    total = np.full(len(words) - n + 1, n, np.uint64)
    for k in range(n):
        total += words[k : len(words) - n + 1 + k] * _PLACES[k]
    return np.unique(_mix(total))


def signature(shingles: np.ndarray) -> bytes:
    """MinHash values of a non-empty set: the low byte of each, then the whole
    (unsigned 32-bit, big-endian) of those that an order can begin with."""
    least = np.full(VALUES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 512):
        part = shingles[at : at + 512]
        np.minimum(least, (part[:, None] * _FACTORS + _TERMS).min(0), out=least)
    whole = (least >> np.uint64(32)).astype(np.uint32)
    return whole.astype(np.uint8).tobytes() + whole[::STEP].astype(">u4").tobytes()


def order_keys(sig: bytes, orders: list[np.ndarray]) -> list[bytes]:
    """Sort key of the signature in each order: the order's number, a whole
    value, and the low bytes of the next ones."""
    low = np.frombuffer(sig, np.uint8, VALUES)
    first = [VALUES + 4 * (int(at[0]) // STEP) for at in orders]
    return [bytes([k]) + sig[f : f + 4] + low[at[1:]].tobytes() for k, (f, at) in enumerate(zip(first, orders, strict=True))]


def parity_map(shingles: np.ndarray) -> bytes:
    """For each place, whether an odd number of the set's shingles fall on it.
    The maps of two sets differ in no more places than the sets have shingles
    that are not in both."""
    at = (shingles >> np.uint64(32)) % np.uint64(PARITY_BITS)
    return np.packbits((np.bincount(at.astype(np.int64), minlength=PARITY_BITS) & 1).astype(bool)).tobytes()


def common_depth(a: bytes, b: bytes) -> int:
    """Number of values at the beginning of two keys that agree; 0 in
    different orders."""
    differ = int.from_bytes(a) ^ int.from_bytes(b)
    same = len(a) - (differ.bit_length() + 7) // 8
    return max(0, same - 4)


def signatures(df: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, h1, h2, sig`` of ``doc_id, text``: size, 128-bit
    hash and signature of each row's set; the last three null for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, h1, h2, sig = [], [], [], []
            for text in values(batch, "text"):
                s = shingle_set(text)
                n.append(len(s))
                if len(s):
                    h = xxhash.xxh3_128_digest(s.tobytes())
                    h1.append(int.from_bytes(h[:8], "big", signed=True))
                    h2.append(int.from_bytes(h[8:], "big", signed=True))
                    sig.append(signature(s))
                else:
                    h1.append(None), h2.append(None), sig.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(sig, pa.binary())],
                names=["doc_id", "n_shingles", "h1", "h2", "sig"],
            )

    return df.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, h1 long, h2 long, sig binary")


def neighbours(sets: DataFrame, orders: list[np.ndarray], with_parts: bool = False) -> DataFrame:
    """Candidate pairs ``a < b`` of ``sets`` (``id, part, sig``) that differ in
    ``part``, with their ``depth``: the values of the common prefixes, summed
    over the orders in which they are neighbours. Rows without ``b`` have the
    number of orders in which ``a`` is crowded, or may be, beside a partition's
    edge. ``with_parts``: also ``p_a, p_b``, the parts of a pair.

    The orders are sorted by range partitions, whose sizes do not depend on how
    many sets share a prefix.
    """

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                batch = whole.slice(at, 200)
                made = [k for s in values(batch, "sig") for k in order_keys(s, orders)]
                again = pa.array(np.repeat(np.arange(batch.num_rows), len(orders)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made, pa.binary()), batch.column("id").take(again), batch.column("part").take(again)], names=["key", "id", "part"]
                )

    parts = ["p_a", "p_b"] if with_parts else []

    def met(a: list, b: list, depth: list, p: list, q: list) -> pa.RecordBatch:
        ends = [pa.array(x, pa.int64()) for x in ((a, b, p, q) if with_parts else (a, b))]
        return pa.RecordBatch.from_arrays([*ends[:2], pa.array(depth, pa.int32()), *ends[2:]], names=["a", "b", "depth", *parts])

    def adjacent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list[tuple[bytes, int, int]] = []
        first, run, crowded = None, [], False  # sets of the present first value that are not marked
        for batch in batches:
            a, b, depth, p, q = [], [], [], [], []
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "id", "part")), strict=True):
                key, node, part = row
                for other, before, its_part in last:
                    if its_part != part and other[:5] == key[:5]:
                        a.append(min(before, node))
                        b.append(max(before, node))
                        depth.append(common_depth(other, key))
                        if with_parts:
                            p.append(its_part if before < node else part)
                            q.append(part if before < node else its_part)
                last = [*last, row][-NEIGHBOURS:]
                if key[:5] != first:
                    first, run, crowded = key[:5], [], first is None
                run.append(node)
                crowded = crowded or len(run) > NEIGHBOURS + 1
                if crowded:
                    a += run
                    depth += [1] * len(run)
                    for ends in (b, p, q):
                        ends += [None] * len(run)
                    run = []
            yield met(a, b, depth, p, q)
        alone = [None] * len(run)
        yield met(run, alone, [1] * len(run), alone, alone)

    rows = sets.select("id", "part", "sig").mapInArrow(keys, "key binary, id long, part long")
    in_order = rows.repartitionByRange("key", "id").sortWithinPartitions("key", "id")
    pairs = in_order.mapInArrow(adjacent, ", ".join(["a long, b long, depth int", *(f"{c} long" for c in parts)]))
    return pairs.groupBy("a", "b").agg(F.sum("depth").alias("depth"), *(F.min(c).alias(c) for c in parts))


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The ``pairs`` whose full sets are similar enough; ``texts`` is ``doc_id, text``."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(values(batch, "text_a"), values(batch, "text_b"), strict=True):
                s, t = shingle_set(x), shingle_set(y)
                both = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(100 * both >= THRESHOLD * (len(s) + len(t) - both))
            kept = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(kept), batch.column("b").filter(kept)], names=["a", "b"])

    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(check, "a long, b long")


def agreeing(pairs: DataFrame, sigs: DataFrame, least: float = LEAST_AGREEMENT) -> DataFrame:
    """The ``pairs`` whose signatures (one byte of each value) agree enough."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(values(batch, c)), np.uint8).reshape(-1, VALUES) for c in ("low_a", "low_b"))
            share = (x == y).mean(1)
            kept = pa.array((share - 1 / 256) / (1 - 1 / 256) >= least)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(kept), batch.column("b").filter(kept)], names=["a", "b"])

    low = sigs.select("doc_id", F.substring("sig", 1, VALUES).alias("low"))
    joined = pairs.select("a", "b").join(low.select(F.col("doc_id").alias("a"), F.col("low").alias("low_a")), "a")
    joined = joined.join(low.select(F.col("doc_id").alias("b"), F.col("low").alias("low_b")), "b")
    return joined.select("a", "b", "low_a", "low_b").mapInArrow(compare, "a long, b long")


def _across(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The ``pairs`` whose ends are not in one component yet, with their
    components ``c_a, c_b`` (null: in none)."""
    mark = lambda side: found.select(F.col("node").alias(side), F.col("component").alias(f"c_{side}"))
    joined = pairs.select("a", "b").join(mark("a"), "a", "left").join(mark("b"), "b", "left")
    return joined.where("c_a is null or c_b is null or c_a <> c_b").select("a", "b", "c_a", "c_b")


def _dense_regions(rest: DataFrame, found: DataFrame, sigs: DataFrame) -> DataFrame:
    """``id, part, sig`` of the sets in dense components and of those beside
    one (``rest``: the candidates across components); the part is the component.

    In a large group of near copies, a set with many changes may be similar
    enough to a few members only, and these need not be next to it in any of
    the first orders. More orders of these sets alone bring them together.
    """
    sizes = written(found.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= DENSE).select("component"), "near-dense")
    inside = found.join(sizes, "component").select("node", "component")
    ends = rest.select(F.col("a").alias("node"), "c_a", "c_b").union(rest.select("b", "c_b", "c_a"))
    beside = ends.join(sizes, F.col("c_b") == F.col("component")).select("node", F.coalesce("c_a", "node").alias("component"))
    chosen = written(inside.union(beside).groupBy("node").agg(F.min("component").alias("part")), "near-chosen")
    dense = written(chosen.join(sigs, chosen["node"] == sigs["doc_id"]).select(F.col("node").alias("id"), "part", "sig"), "near-dense")
    forget(sizes, chosen)
    return dense


def _shingle_rows(texts: DataFrame) -> DataFrame:
    """``id, h``: the full sets of ``doc_id, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 100):
                batch = whole.slice(at, 100)
                sets = [shingle_set(text).view(np.int64) for text in values(batch, "text")]
                ids = batch.column("doc_id").take(pa.array(np.repeat(np.arange(batch.num_rows), [len(s) for s in sets])))
                yield pa.RecordBatch.from_arrays([ids, pa.array(np.concatenate(sets))], names=["id", "h"])

    return texts.select("doc_id", "text").mapInArrow(run, "id long, h long")


def _parity_maps(texts: DataFrame) -> DataFrame:
    """``id, bits``: the parity maps of the full sets of ``doc_id, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = [parity_map(shingle_set(text)) for text in values(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(maps, pa.binary())], names=["id", "bits"])

    return texts.select("doc_id", "text").mapInArrow(run, "id long, bits binary")


def exact_candidates(texts: DataFrame, parts: DataFrame) -> DataFrame:
    """All pairs ``a < b`` of ``texts`` (``doc_id, text``) in different
    ``parts`` (``id, part``) that neither a prefix filter nor their parity maps
    can tell to be unlike.

    Each set is ordered by how many sets have a shingle, rare ones first. Two
    similar sets share a shingle in their prefixes, a quarter of each, and the
    first one they share leaves room for the overlap they need behind its
    places. Sets with a common shingle are dealt into blocks, and each pair of
    blocks is compared as a whole. Two similar sets have at most a seventh of
    their shingles, counted in both, not in common; a pair whose parity maps
    differ in more places is not made. This loses no similar pair and leaves
    few others, unless both sets are large.
    """
    counts = written(_shingle_rows(texts).groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "near-counts")
    ordered = _shingle_rows(texts).join(counts, "h", "left").groupBy("id").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(1)).alias("df"), "h"))).alias("s"))
    prefix = F.slice("s", F.lit(1), F.floor(F.size("s") * (100 - THRESHOLD) / 100).cast("int") + 1)
    rows = ordered.select("id", F.size("s").cast("long").alias("n"), F.posexplode(prefix).alias("pos", "x")).where("x.df > 1")
    known = parts.join(_parity_maps(texts), "id")
    rows = written(rows.join(known, "id").select("id", "part", "n", F.col("pos").cast("long").alias("pos"), "x.h", "bits"), "near-prefixes")
    shared = rows.groupBy("h").agg(F.count(F.lit(1)).alias("m"), F.min("part").alias("p"), F.max("part").alias("q")).where("p < q")
    blocks = shared.select("h", F.ceil(F.col("m") / BLOCK_SETS).cast("int").alias("blocks"))
    dealt = rows.join(blocks, "h").withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    groups = dealt.groupBy("h", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")).agg(
        F.collect_list(F.struct((F.col("block") > F.least("block", "other")).cast("long").alias("side"), "id", "part", "n", "pos", "bits")).alias("members")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members = batch.column("members")
            at = members.offsets.to_numpy() - members.offsets[0].as_py()
            *numbers, bits = members.flatten().flatten()
            side, node, part, n, pos = (c.to_numpy() for c in numbers)
            bits = np.frombuffer(b"".join(bits.to_pylist()), np.uint64).reshape(-1, PARITY_BITS // 64)
            room = (100 + THRESHOLD) * (n - pos) - THRESHOLD * n  # partners of more than this / THRESHOLD need more overlap
            need = THRESHOLD * n
            for k, same in enumerate(x == y for x, y in zip(batch.column("low"), batch.column("high"), strict=True)):
                own = np.arange(at[k], at[k + 1])
                left, right = (own, own) if same else (own[side[own] == 0], own[side[own] == 1])
                for start in range(0, len(left), 64):
                    x = left[start : start + 64]
                    fit = (room[x, None] >= need[right]) & (room[right] >= need[x, None]) & (part[x, None] != part[right])
                    if same:
                        fit &= node[x, None] < node[right]
                    i, j = np.nonzero(fit)
                    differ = np.bitwise_count(bits[x[i]] ^ bits[right[j]]).sum(1, dtype=np.int64)
                    near = (100 + THRESHOLD) * differ <= (100 - THRESHOLD) * (n[x[i]] + n[right[j]])
                    i, j = i[near], j[near]
                    if len(i):
                        a, b = node[x[i]], node[right[j]]
                        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    found = written(groups.select("low", "high", "members").mapInArrow(compare, "a long, b long").distinct(), "near-exact")
    forget(counts, rows)
    return found


def _best(pairs: DataFrame) -> DataFrame:
    """Of ``pairs`` (``a, b, depth``) those that are among the deepest BEST of one
    of their ends."""
    ends = pairs.select(F.col("a").alias("x"), F.col("b").alias("y"), "depth").union(pairs.select("b", "a", "depth"))
    rank = Window.partitionBy("x").orderBy(F.desc("depth"), "y")
    best = ends.withColumn("r", F.row_number().over(rank)).where(F.col("r") <= BEST)
    return best.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _merged(found: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more ``links``. Only the graph between the components
    before is worked on, so a late link costs as little as it joins."""
    mark = lambda side: found.select(F.col("node").alias(side), F.col("component").alias(f"c_{side}"))
    ends = links.join(mark("a"), "a", "left").join(mark("b"), "b", "left").select("a", "b", F.coalesce("c_a", "a").alias("p"), F.coalesce("c_b", "b").alias("q"))
    ends = written(ends, "near-ends")
    joined = written(components(ends.select(F.col("p").alias("a"), F.col("q").alias("b"))), "near-joined")
    new = ends.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(found, "node", "left_anti")
    nodes = found.select("node", "component").union(new.select("node", F.col("node").alias("component")))
    moved = joined.select(F.col("node").alias("component"), F.col("component").alias("into"))
    out = written(nodes.join(moved, "component", "left").select("node", F.coalesce("into", "component").alias("component")), "near-found")
    forget(ends, joined)
    return out


def _between_regions(found: DataFrame, rest: DataFrame, sigs: DataFrame) -> DataFrame:
    """Pairs ``a, b`` that meet in further orders of the dense regions.

    Pairs inside a component do not meet; between two components the deepest few
    are kept, and of these the deepest few of a set. The exact comparison at the end
    sees again what is passed over here.
    """
    dense = _dense_regions(rest, found, sigs)
    pairs = neighbours(dense, _MORE, with_parts=True).where("b is not null")
    rank = Window.partitionBy(F.least("p_a", "p_b"), F.greatest("p_a", "p_b")).orderBy(F.desc("depth"), "a", "b")
    few = written(pairs.withColumn("r", F.row_number().over(rank)).where(F.col("r") <= BETWEEN).select("a", "b", "depth"), "near-pairs")
    out = written(_best(few), "near-between")
    forget(dense, few)
    return out


def class_links(sigs: DataFrame, texts: DataFrame) -> DataFrame:
    """Components of the classes: ``node, component``."""
    met = written(neighbours(sigs.select(F.col("doc_id").alias("id"), F.col("doc_id").alias("part"), "sig"), _ORDERS), "near-pairs")
    crowd = written(met.where((F.col("b").isNull()) & (F.col("depth") >= CROWDED)).select(F.col("a").alias("doc_id")), "near-crowd")
    # Two sets that are both crowded are compared exactly at the end; here the
    # deepest of their pairs will do.
    of = lambda side: crowd.select(F.col("doc_id").alias(side), F.lit(True).alias(f"crowded_{side}"))
    known = met.where("b is not null").join(of("a"), "a", "left").join(of("b"), "b", "left")
    known = written(known.select("a", "b", "depth", F.expr("coalesce(crowded_a and crowded_b, false)").alias("both")).where(F.col("both") | (F.col("depth") >= MET)), "near-known")
    deep = known.join(_best(known.where("both")), ["a", "b"]).where("both")
    pairs = written(known.where("not both").union(deep).select("a", "b", "depth"), "near-pairs")
    # Only sets with a candidate are looked at again, by their texts.
    ids = written(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).union(crowd).distinct(), "near-ids")
    wanted = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    some = written(texts.join(wanted, "doc_id").dropDuplicates(["doc_id"]), "near-texts")
    first = written(_best(pairs.where(F.col("depth") >= SURE)), "near-first")
    links = written(confirmed(first, some), "near-links")
    found = written(components(links), "near-found")
    rest = written(_across(pairs, found), "near-rest")
    more_pairs = rest.select("a", "b").union(_between_regions(found, rest, sigs)).distinct()
    second = written(agreeing(more_pairs, sigs), "near-second")
    more = written(confirmed(second, some), "near-links")
    before = found
    found = _merged(before, more)
    forget(met, known, pairs, first, links, before, rest, more)
    crowded = written(some.join(crowd, "doc_id"), "near-crowd-texts")
    if not crowded.isEmpty():
        parts = crowded.join(found, crowded["doc_id"] == found["node"], "left").select(F.col("doc_id").alias("id"), F.coalesce("component", "doc_id").alias("part"))
        exact = exact_candidates(crowded, parts)
        third = written(agreeing(exact, sigs, SURELY_UNLIKE).join(second, ["a", "b"], "left_anti"), "near-third")
        last = written(confirmed(third, some), "near-links")
        before = found
        found = _merged(before, last)
        forget(before, exact, third, last)
    forget(crowd, ids, some, second, crowded)
    return found


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``.

    Words are what white space separates, with A-Z lower-cased; a set holds
    the distinct shingles of five words of the whole text, or the whole
    sequence if it is shorter. Rows without words (null and empty texts too)
    have size 0 and stand alone. Ids must be integers; rows that repeat an id
    are one document, the text of one of them being used to confirm. Other
    columns are not read; an empty table gives an empty result.
    """
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = written(signatures(docs), "near-rows")
    classes = written(rows.where("h1 is not null and doc_id is not null").groupBy("h1", "h2").agg(F.min("doc_id").alias("doc_id")), "near-classes")
    sigs = written(rows.join(classes, ["doc_id", "h1", "h2"]).select("doc_id", "sig").dropDuplicates(["doc_id"]), "near-sigs")
    found = class_links(sigs, docs)
    placed = written(
        classes.join(found, classes["doc_id"] == found["node"], "left").select("h1", "h2", F.coalesce("component", "doc_id").alias("component_id")),
        "near-placed",
    )
    out = rows.select("doc_id", "n_shingles", "h1", "h2").join(placed, ["h1", "h2"], "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
