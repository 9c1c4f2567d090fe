"""Hard negatives by segment summaries (operator 11).

Every vector is cut into segments, halved from level to level. Of each segment
its mean and its deviation (the length of what is left without the mean) are
stored. For two vectors

    | inner product - sum over segments (size * mean * mean') | <= sum of (deviation * deviation')

so the summaries bound a score from both sides. A pair that cannot reach what an
anchor already has is dropped at the first level that proves it; the others are
refined at the next, and only what no level drops is scored exactly.

Anchors are a stated query set. They are worked through in blocks of at most
``BLOCK_BYTES``: a block is broadcast and all rows are scanned where they lie,
each task keeping the best few of each anchor; these meet in one small shuffle. The
first scan finds the positives, the second the negatives between the bounds that
the positives set.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import forget, written

# Segments a level; a vector shorter than a level has segments of one component.
LEVELS = (4, 16)
# Bytes of a block of anchors, summaries included.
BLOCK_BYTES = 48 << 20
# Rows and anchors that meet at once.
ROWS_AT_ONCE = 4096
ANCHORS_AT_ONCE = 256
# Below this share of pairs left, pairs are looked at one by one.
SPARSE = 0.05
# Inner products below this are exact in double precision.
EXACT = 2.0**53
LONG_MAX = (1 << 63) - 1
MOST = 1.7976931348623157e308  # the largest double


@dataclass
class Block:
    """Vectors of one length with their summaries, one (mean * root of the
    segment's size, deviation) a level."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray]]

    def part(self, at) -> Block:
        return Block(self.ids[at], self.labels[at], self.vectors[at], [(m[at], d[at]) for m, d in self.levels])


def summaries(vectors: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """(mean * root of size, deviation) of each segment; the last one may be
    shorter."""
    n, dim = vectors.shape
    size = max(1, -(-dim // segments))
    starts = np.arange(0, max(dim, 1), size) if dim else np.empty(0, int)
    if not len(starts):
        return np.zeros((n, 0)), np.zeros((n, 0))
    sizes = np.diff(np.append(starts, dim))
    mean = np.add.reduceat(vectors, starts, axis=1) / sizes
    rest = vectors - np.repeat(mean, sizes, axis=1)
    return mean * np.sqrt(sizes), np.sqrt(np.add.reduceat(rest * rest, starts, axis=1))


def block_of(ids, labels, vectors: np.ndarray) -> Block:
    return Block(np.asarray(ids), np.asarray(labels), vectors, [summaries(vectors, s) for s in LEVELS])


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of ``a`` and ``b``. Scores that do not
    fit a long are set to the largest or smallest one."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if np.abs(a).max() * np.abs(b).max() * a.shape[1] < EXACT:
        return (a @ b.T).astype(np.int64)
    whole = [np.array([[int(x) for x in row] for row in m], object) for m in (a, b)]
    return np.clip(whole[0] @ whole[1].T, -LONG_MAX - 1, LONG_MAX).astype(np.int64)


def scored_pairs(anchors: Block, rows: Block, wanted: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of the pairs in ``wanted`` whose score may lie in
    ``least .. most`` (given for each anchor); some outside may be among them."""
    left = wanted
    for (ma, da), (mr, dr) in zip(anchors.levels, rows.levels, strict=True):
        share = left.mean() if left.size else 0.0
        if not share:
            break
        # The bounds are rounded; the slack is far above the rounding error.
        if share > SPARSE:
            mid, radius = ma @ mr.T, da @ dr.T
            slack = 1e-9 * (np.abs(mid) + radius) + 0.5
            left = left & (mid + radius + slack >= least[:, None]) & (mid - radius - slack <= most[:, None])
        else:
            i, j = np.nonzero(left)
            mid, radius = np.einsum("ij,ij->i", ma[i], mr[j]), np.einsum("ij,ij->i", da[i], dr[j])
            slack = 1e-9 * (np.abs(mid) + radius) + 0.5
            ok = (mid + radius + slack >= least[i]) & (mid - radius - slack <= most[i])
            left = np.zeros_like(left)
            left[i[ok], j[ok]] = True
    i, j = np.nonzero(left)
    if len(i) > SPARSE * wanted.size:
        return i, j, exact_scores(anchors.vectors, rows.vectors)[i, j]
    out = np.empty(len(i), np.int64)
    for at in range(0, len(i), 65_536):
        a, b = anchors.vectors[i[at : at + 65_536]], rows.vectors[j[at : at + 65_536]]
        if not a.size or np.abs(a).max() * np.abs(b).max() * a.shape[1] < EXACT:
            out[at : at + 65_536] = np.einsum("ij,ij->i", a, b)
        else:
            out[at : at + 65_536] = [exact_scores(x[None], y[None])[0, 0] for x, y in zip(a, b, strict=True)]
    return i, j, out


class Best:
    """The best ``size`` (score, row id) of each slot: higher scores first, ties
    by smaller id."""

    def __init__(self, slots: int, size: int):
        self.size = size
        self.slot = np.empty(0, np.int64)
        self.score = np.empty(0, np.int64)
        self.row = np.empty(0, np.int64)
        self.worst = np.full(slots, -np.inf)  # what a newcomer has to reach

    def add(self, slot, score, row) -> None:
        slot, score, row = (np.concatenate(x) for x in ((self.slot, slot), (self.score, score), (self.row, row)))
        order = np.lexsort((row, ~score, slot))
        slot, score, row = slot[order], score[order], row[order]
        first = np.searchsorted(slot, slot, "left")
        place = np.arange(len(slot)) - first
        keep = place < self.size
        full = place == self.size - 1
        self.worst[slot[full]] = score[full]
        self.slot, self.score, self.row = slot[keep], score[keep], row[keep]


def _blocks(batch: pa.RecordBatch) -> Iterator[Block]:
    """The rows of a batch by the length of their vectors."""
    ids, labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
    q = batch.column("q")
    sizes = np.diff(q.offsets.to_numpy())
    flat = q.flatten().to_numpy(zero_copy_only=False)
    starts = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    for dim in np.unique(sizes):
        at = np.flatnonzero(sizes == dim)
        vectors = flat[starts[at][:, None] + np.arange(dim)] if dim else np.zeros((len(at), 0))
        for k in range(0, len(at), ROWS_AT_ONCE):
            yield block_of(ids[at[k : k + ROWS_AT_ONCE]], labels[at[k : k + ROWS_AT_ONCE]], vectors[k : k + ROWS_AT_ONCE])


def prepared(df: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """``vec_id, label, q``: the rows that take part, one an id. ``q`` holds the
    integers floor(256 * x), as doubles, which hold them at any size."""
    v = F.col(vector_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))

    def whole(x: Column) -> Column:
        y = F.least(F.greatest(256 * x.cast("double"), F.lit(-MOST)), F.lit(MOST))
        return F.when(F.abs(y) < EXACT, F.floor(y).cast("double")).otherwise(y)

    rows = df.where(F.col(id_col).isNotNull() & v.isNotNull() & ~F.coalesce(bad, F.lit(True))).select(
        F.col(id_col).cast("long").alias("vec_id"), F.struct(label.cast("long").alias("label"), F.transform(v, whole).alias("q")).alias("row")
    )
    return rows.where("row.label is not null").groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.q")


def _anchor_blocks(rows: DataFrame, every: int) -> Iterator[dict[int, Block]]:
    """The anchors in blocks of bounded size, by vector length."""
    anchors = rows.where(F.pmod("vec_id", F.lit(every)) == 0)
    size = anchors.agg(F.sum(F.size("q") * 16 + 32 * sum(LEVELS) + 64)).first()[0] or 0
    n = max(1, -(-size // BLOCK_BYTES))
    for k in range(n):
        part = anchors.where(F.pmod(F.xxhash64("vec_id"), F.lit(n)) == k) if n > 1 else anchors
        found = part.orderBy("vec_id").toArrow().combine_chunks()
        out: dict[int, list[Block]] = {}
        for batch in found.to_batches():
            for b in _blocks(batch):
                out.setdefault(b.vectors.shape[1], []).append(b)
        yield {d: block_of(*(np.concatenate([getattr(b, f) for b in bs]) for f in ("ids", "labels", "vectors"))) for d, bs in out.items()}


def _scan(rows: DataFrame, found, names: list[str]) -> DataFrame:
    """All rows against what ``found`` holds; see ``positives`` and ``negatives``."""
    shared = rows.sparkSession.sparkContext.broadcast(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = {d: f() for d, f in shared.value.items()}
        for batch in batches:
            for block in _blocks(batch):
                if s := search.get(block.vectors.shape[1]):
                    s.meet(block)
        for s in search.values():
            columns = s.result()
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in names))


class PositiveSearch:
    """The best rows of an anchor's label, itself left out."""

    def __init__(self, anchors: Block, size: int):
        self.anchors, self.best = anchors, Best(len(anchors.ids), size)

    def __call__(self) -> PositiveSearch:
        return PositiveSearch(self.anchors, self.best.size)

    def meet(self, rows: Block) -> None:
        for at in range(0, len(self.anchors.ids), ANCHORS_AT_ONCE):
            a = self.anchors.part(slice(at, at + ANCHORS_AT_ONCE))
            wanted = (a.labels[:, None] == rows.labels) & (a.ids[:, None] != rows.ids)
            least = self.best.worst[at : at + ANCHORS_AT_ONCE]
            i, j, score = scored_pairs(a, rows, wanted, least, np.full(len(least), np.inf))
            ok = score >= least[i]
            self.best.add(i[ok] + at, score[ok], rows.ids[j[ok]])

    def result(self) -> list[np.ndarray]:
        b, a = self.best, self.anchors
        return [a.ids[b.slot], b.row, b.score]


class NegativeSearch:
    """The best rows of other labels between the bounds of each positive.
    ``owner``: the anchor of each positive, ascending; ``low``, ``high``: its bounds."""

    def __init__(self, anchors: Block, owner, positive, score, low, high, size: int):
        self.anchors, self.owner, self.positive, self.score, self.low, self.high = anchors, owner, positive, score, low, high
        self.best = Best(len(owner), size)

    def __call__(self) -> NegativeSearch:
        return NegativeSearch(self.anchors, self.owner, self.positive, self.score, self.low, self.high, self.best.size)

    def meet(self, rows: Block) -> None:
        n = len(self.anchors.ids)
        for at in range(0, n, ANCHORS_AT_ONCE):
            end = min(n, at + ANCHORS_AT_ONCE)
            first, last = np.searchsorted(self.owner, (at, end))
            if first == last:
                continue
            slots = np.arange(first, last)
            owner, need = self.owner[slots] - at, np.maximum(self.low[slots], self.best.worst[slots])
            least, most = np.full(end - at, np.inf), np.full(end - at, -np.inf)
            np.minimum.at(least, owner, need)
            np.maximum.at(most, owner, self.high[slots])
            a = self.anchors.part(slice(at, end))
            wanted = (a.labels[:, None] != rows.labels) & (least <= most)[:, None]
            i, j, score = scored_pairs(a, rows, wanted, least, most)
            # every positive of the anchor of each pair
            starts, counts = np.searchsorted(owner, i), np.bincount(owner, minlength=end - at)[i]
            pair = np.repeat(np.arange(len(i)), counts)
            slot = np.arange(len(pair)) - np.repeat(np.cumsum(counts) - counts, counts) + starts[pair]
            ok = (score[pair] >= need[slot]) & (score[pair] <= self.high[slots[slot]])
            self.best.add(slots[slot[ok]], score[pair[ok]], rows.ids[j[pair[ok]]])

    def result(self) -> list[np.ndarray]:
        b = self.best
        at = self.owner[b.slot]
        return [self.anchors.ids[at], self.positive[b.slot], self.score[b.slot], b.row, b.score]


def _ranked(found: DataFrame, keys: list[str], score: str, row: str, size: int) -> DataFrame:
    """The best of what the tasks found (each at most ``size`` for a key)."""
    order = Window.partitionBy(*keys).orderBy(F.desc(score), row)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


def _negative_search(anchors: dict[int, Block], top: pa.Table, low: int, high: int, size: int) -> dict[int, NegativeSearch]:
    """The second scan's state: every positive with the bounds it sets."""
    out = {}
    place = {i: (d, k) for d, b in anchors.items() for k, i in enumerate(b.ids.tolist())}
    held: dict[int, list[tuple]] = {}
    for i, p, s in zip(*(top.column(c).to_pylist() for c in ("anchor_id", "positive_id", "positive_score")), strict=True):
        d, k = place[i]
        held.setdefault(d, []).append((k, p, s, -(-low * s // 100), high * s // 100))
    for d, rows in held.items():
        columns = [np.array(c, np.int64) for c in zip(*sorted(rows), strict=True)]
        out[d] = NegativeSearch(anchors[d], *columns, size)
    return out


def hard_negatives(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label: Column | None = None,
    every: int = 50,
    n_positives: int = 5,
    n_negatives: int = 3,
    low: int = 50,
    high: int = 95,
) -> DataFrame:
    """For each anchor (id divisible by ``every``) and each of its first
    ``n_positives`` other rows of its label, the first ``n_negatives`` rows of other
    labels with ``low * positive <= 100 * negative <= high * positive``:
    ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    - rows with a null id, label or vector, or a null or non-finite component, take
      no part;
    - rows with one id are one row: the smallest by label, then vector;
    - vectors of different lengths have no score with each other;
    - scores are exact integers, whatever the components' size (those that do not
      fit a long are set to its ends);
    - an empty table, or one without anchors, gives an empty result;
    - other columns are not read, whatever their names.
    """
    rows = written(prepared(df, id_col, vector_col, F.col("label") if label is None else label), "negatives-rows")
    result = None
    for anchors in _anchor_blocks(rows, every):
        names = ["anchor_id", "positive_id", "positive_score"]
        found = _scan(rows, {d: PositiveSearch(b, n_positives) for d, b in anchors.items()}, names)
        # at most n_positives rows an anchor of the block
        top = _ranked(found, ["anchor_id"], "positive_score", "positive_id", n_positives).select(*names).toArrow()
        search = _negative_search(anchors, top, low, high, n_negatives)
        found = _scan(rows, search, [*names, "negative_id", "negative_score"])
        part = _ranked(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", n_negatives)
        part = written(part.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"), "negatives")
        result = part if result is None else result.unionByName(part)
    forget(rows)
    return result


def shifted_label(id_col: str = "vec_id", label_col: str = "label") -> Column:
    """The label, moved on by one of ten where the id is divisible by seven."""
    moved = F.pmod(F.col(label_col) + 1, F.lit(10))
    return F.when(F.pmod(F.col(id_col), F.lit(7)) == 0, moved).otherwise(F.col(label_col))
