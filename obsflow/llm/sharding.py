"""Sharding by k-d tree partitioning (operator 5).

The points of the tree are groups of equal texts, so copies stay in one shard.
The few groups that weigh a noticeable part of a leaf are dealt to the leaves first,
whole wherever one has room; only a group that fits nowhere is taken apart, into
as many parts as it must cover leaves. The tree fills the leaves up with the others:
a node is split at the weighted median (by bytes still wanted on either side) along
the dimension in which it is widest, until the leaves reach the target bytes.

Medians are found on executors: each pass sums weights in a bounded number of
buckets over all nodes of a level and narrows down to the bucket that holds the
median. Splits are joined to the points as a table, level by level, so neither the
plan nor the driver grows with the points, and with the leaves only by a few
numbers each.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import forget, written

# Buckets of one narrowing pass: at most so many a node, and over all nodes of a level.
NODE_BUCKETS, LEVEL_BUCKETS = 1 << 10, 1 << 18
COORD_BITS = 30  # resolution of a dimension
TIE_BITS = 32  # then a hash of the point orders equal coordinates
# A split may miss its share by this part of a leaf's bytes.
TOLERANCE = 1e-4
# A group of equal texts heavier than this part of a leaf is dealt by itself (but
# never more than MOST_HEAVY groups: the heaviest), and may overfill one by SLACK.
HEAVY, MOST_HEAVY, SLACK = 0.01, 20_000, 0.01
# Slices, by a hash of the id, of a group that is taken apart; over all such groups.
SLICES, MOST_SLICES = 1 << 10, 1 << 18
# Rows numbered together when slots are given.
SLOT_ROWS = 4_000


@dataclass
class Node:
    """A tree node over the leaves ``first_leaf ... first_leaf + leaves - 1``."""

    number: int
    leaves: int
    first_leaf: int
    dim: int = 0
    at: int = 0  # points with a key below this go left


def _key(dims: list[str]) -> Column:
    """Order of the points along the dimension ``dim`` of their node; ties by the
    point's hash."""
    return F.shiftleft(F.element_at(F.array(*dims), F.col("dim") + 1), TIE_BITS) + F.col("tie")


def _joined(points: DataFrame, rows: list[tuple], schema: str, how: str = "inner") -> DataFrame:
    """``points`` with some numbers of each node (at most one row a leaf)."""
    return points.join(F.broadcast(points.sparkSession.createDataFrame(rows, f"node long, {schema}")), "node", how)


def _split_level(points: DataFrame, nodes: list[Node], dims: list[str], room: list[float]) -> None:
    """Find dimension and median of each of ``nodes``; ``room`` holds the bytes
    that each leaf still wants."""
    stats = {
        r["node"]: r
        for r in points.groupBy("node")
        .agg(F.sum("weight").cast("double").alias("weight"), *[f(d).alias(f"{f.__name__}_{d}") for d in dims for f in (F.min, F.max)])
        .collect()
    }
    low, high, before, goal, leaf = {}, {}, {}, {}, {}
    open_ = [n for n in nodes if n.number in stats]  # without points any split will do
    for n in open_:
        k, s = n.number, stats[n.number]
        n.dim = max(range(len(dims)), key=lambda d: s[f"max_{dims[d]}"] - s[f"min_{dims[d]}"])
        low[k] = s[f"min_{dims[n.dim]}"] << TIE_BITS
        high[k] = (s[f"max_{dims[n.dim]}"] + 1) << TIE_BITS  # exclusive
        wanted = room[n.first_leaf : n.first_leaf + n.leaves]
        share = sum(wanted[: n.leaves // 2]) / sum(wanted) if sum(wanted) > 0 else (n.leaves // 2) / n.leaves
        before[k], goal[k], leaf[k] = 0.0, s["weight"] * share, s["weight"] / n.leaves
    while open_:
        buckets = max(8, min(NODE_BUCKETS, LEVEL_BUCKETS // len(open_)))
        width = {n.number: max(1, -(-(high[n.number] - low[n.number]) // buckets)) for n in open_}
        ranges = [(n.number, n.dim, low[n.number], width[n.number], high[n.number]) for n in open_]
        sums = (
            _joined(points, ranges, "dim int, start long, step long, end long")
            .select("node", "weight", _key(dims).alias("key"), "start", "step", "end")
            .where("key >= start and key < end")
            .groupBy("node", F.expr("(key - start) div step").alias("bucket"))
            .agg(F.sum("weight").cast("double").alias("weight"))
            .collect()
        )
        found: dict[int, list[tuple[int, float]]] = {n.number: [] for n in open_}
        for r in sums:
            found[r["node"]].append((r["bucket"], r["weight"]))
        still = []
        for n in open_:
            k, done = n.number, before[n.number]
            for bucket, weight in sorted(found[k]):
                if done + weight >= goal[k]:
                    break
                done += weight
            start_key = low[k] + bucket * width[k]
            if weight <= TOLERANCE * leaf[k] or width[k] == 1:
                # the nearer end of the bucket, which holds one point or little
                over = done + weight - goal[k]
                n.at = start_key + width[k] if over < goal[k] - done else start_key
            else:
                low[k], high[k], before[k] = start_key, min(high[k], start_key + width[k]), done
                still.append(n)
        open_ = still


def kd_leaves(points: DataFrame, dims: list[str], room: list[float]) -> DataFrame:
    """``points`` (``weight``, ``tie`` and integer columns ``dims`` below 2^30) with
    ``shard``, the leaf of a tree that gives each leaf its share of ``room``."""
    level = [Node(1, len(room), 0)]
    current, last = points.withColumn("node", F.lit(1).cast("long")), None
    while any(n.leaves > 1 for n in level):
        splits = [n for n in level if n.leaves > 1]
        _split_level(current, splits, dims, room)
        right = (_key(dims) >= F.col("at")).cast("long")
        moved = _joined(current, [(n.number, n.dim, n.at) for n in splits], "dim int, at long", "left")
        moved = moved.withColumn("node", F.when(F.col("dim").isNull(), F.col("node")).otherwise(2 * F.col("node") + right)).drop("dim", "at")
        current = written(moved, "shard-level")
        if last is not None:
            forget(last)
        last = current
        level = [
            c
            for n in level
            for c in (
                [n]
                if n.leaves == 1
                else [Node(2 * n.number, n.leaves // 2, n.first_leaf), Node(2 * n.number + 1, n.leaves - n.leaves // 2, n.first_leaf + n.leaves // 2)]
            )
        ]
    return _joined(current, [(n.number, n.first_leaf) for n in level], "shard int").drop("node")


def deal_groups(groups: list[tuple[int, float]], leaf: float, shards: int) -> tuple[dict[int, int], list[float], list[tuple[int, float]]]:
    """Whole groups (heaviest first, each to the emptiest leaf) -> (leaf of each group,
    load of each leaf, groups that fit into none)."""
    loads = [(0.0, k) for k in range(shards)]
    place, torn = {}, []
    for group, weight in sorted(groups, key=lambda g: (-g[1], g[0])):
        load, k = loads[0]
        if load + weight <= leaf * (1 + SLACK):
            heapq.heapreplace(loads, (load + weight, k))
            place[group] = k
        else:
            torn.append((group, weight))
    load = [0.0] * shards
    for x, k in loads:
        load[k] = x
    return place, load, torn


def deal_slices(slices: dict[int, list[tuple[int, float]]], load: list[float], leaf: float) -> dict[tuple[int, int], int]:
    """Slices ``(number, weight)`` of each group that is taken apart -> their leaves.
    Neighbouring slices fill the emptiest leaf, then the next one."""
    loads = [(x, k) for k, x in enumerate(load)]
    heapq.heapify(loads)
    place = {}
    for group, parts in slices.items():
        at = None
        for number, weight in sorted(parts):
            if at is None or at[0] + weight / 2 > leaf:
                if at is not None:
                    heapq.heappush(loads, at)
                at = heapq.heappop(loads)
            place[group, number] = at[1]
            at = (at[0] + weight, at[1])
        heapq.heappush(loads, at)
    for x, k in loads:
        load[k] = x
    return place


def _coordinate(col: Column, low: float, high: float) -> Column:
    scaled = (col - F.lit(low)) / F.lit(max(high - low, 1e-300)) * F.lit(float((1 << COORD_BITS) - 1))
    return F.coalesce(F.greatest(F.lit(0), scaled.cast("long")), F.lit(0)).cast("long")


def gapless_slots(rows: DataFrame, shard: str, order: list[str], total: int) -> DataFrame:
    """``rows`` with ``slot``, 0, 1, ... within each shard. Rows are numbered
    in hash buckets of a few thousand, whose offsets come from their counts,
    so that a shard is never sorted in one task."""
    per_shard = max(4, total // SLOT_ROWS)
    rows = rows.withColumn("slot_bucket", F.pmod(F.xxhash64(*order), F.lit(per_shard)))
    counts = rows.groupBy(shard, "slot_bucket").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(shard).orderBy("slot_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(shard, "slot_bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("slot_start"))
    within = F.row_number().over(Window.partitionBy(shard, "slot_bucket").orderBy(*order)) - 1
    numbered = rows.withColumn("slot_within", within)
    return numbered.join(counts, [shard, "slot_bucket"]).withColumn("slot", F.col("slot_start") + F.col("slot_within"))


def _heavy_groups(spark: SparkSession, rows: DataFrame, total: float, shards: int) -> tuple[DataFrame, list[float]]:
    """``group, slice, slices, heavy_shard`` of the groups that are dealt by
    themselves (at most MOST_HEAVY + MOST_SLICES rows), and the bytes each leaf
    has room for after that. A group of fewer rows than slices is taken apart row by
    row (``slices`` 0)."""
    leaf = total / shards
    least = max(HEAVY * leaf, total / MOST_HEAVY)
    heavy = rows.groupBy("group").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).where(F.col("bytes") > F.lit(least)).collect()
    place, load, torn = deal_groups([(r["group"], float(r["bytes"])) for r in heavy], leaf, shards)
    dealt = [(g, 0, 1, k) for g, k in place.items()]
    if torn:
        most, size = max(2, min(SLICES, MOST_SLICES // len(torn))), {r["group"]: r["n"] for r in heavy}
        n = {g: 0 if size[g] <= most else most for g, _ in torn}
        chosen = F.broadcast(spark.createDataFrame(list(n.items()), "group long, slices int"))
        parts = rows.join(chosen, "group").groupBy("group", _slice(F.col("slices")).alias("slice")).agg(F.sum("size").alias("bytes")).collect()
        slices: dict[int, list[tuple[int, float]]] = {g: [] for g, _ in torn}
        for r in parts:
            slices[r["group"]].append((r["slice"], float(r["bytes"])))
        dealt += [(g, x, n[g], k) for (g, x), k in deal_slices(slices, load, leaf).items()]
    table = spark.createDataFrame(dealt, "group long, slice long, slices int, heavy_shard int")
    return table, [max(0.0, leaf - x) for x in load]


def _slice(n: Column) -> Column:
    row = F.xxhash64("doc_id", "group")
    return F.when(n == 0, row).otherwise(F.pmod(row, F.nullif(n, F.lit(0))))


def kd_shards(
    df: DataFrame,
    dimensions: dict[str, Column],
    shards: int | None = None,
    target_bytes: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: ``doc_id, size, text_crc32, shard, slot``.

    ``dimensions`` are numeric expressions over ``df``; a null one counts as
    the lowest place. Give the number of shards or the bytes a leaf should
    reach. A null text has size 1 and counts as empty; equal texts share a
    shard unless together they fit into none; rows of one id and text always do;
    repeated rows get slots of their own; an empty table gives an empty result;
    fewer groups than shards leave shards empty.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    given = written(
        df.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("group"),
            *[c.cast("double").alias(f"d_{name}") for name, c in dimensions.items()],
        ),
        "shard-rows",
    )
    dims = [f"d_{name}" for name in dimensions]
    total = given.agg(
        F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"), *[f(d).alias(f"{f.__name__}_{d}") for d in dims for f in (F.min, F.max)]
    ).first()
    if shards is None:
        shards = max(1, -(-(total["bytes"] or 0) // target_bytes))
    rows = given.select(
        "doc_id", "size", "text_crc32", "group", *[_coordinate(F.col(d), total[f"min_{d}"] or 0.0, total[f"max_{d}"] or 0.0).alias(d) for d in dims]
    )
    heavy, room = _heavy_groups(df.sparkSession, rows, float(total["bytes"] or 0), shards)
    alone = F.broadcast(heavy.select("group").distinct())
    points = written(
        rows.join(alone, "group", "left_anti")
        .groupBy("group")
        .agg(F.sum("size").alias("weight"), *[F.min(d).alias(d) for d in dims])
        .withColumn("tie", F.xxhash64("group").bitwiseAND(F.lit((1 << TIE_BITS) - 1))),
        "shard-points",
    )
    light = rows.select("doc_id", "size", "text_crc32", "group").join(kd_leaves(points, dims, room).select("group", "shard"), "group")
    kept = ["doc_id", "size", "text_crc32", "shard"]
    by_slice = (F.col("group") == F.col("g")) & (_slice(F.col("slices")) == F.col("slice"))
    dealt = rows.join(F.broadcast(heavy.withColumnRenamed("group", "g")), by_slice).withColumn("shard", F.col("heavy_shard"))
    placed = written(light.select(*kept).unionByName(dealt.select(*kept)), "shard-placed")
    forget(given, points)
    return gapless_slots(placed, "shard", ["doc_id", "text_crc32"], total["rows"]).select("doc_id", "size", "text_crc32", "shard", "slot")


def document_shards(df: DataFrame, shards: int = 8) -> DataFrame:
    """Documents in ``shards`` shards of nearly equal bytes (law ``bytes``),
    by size, language, source and id."""
    n_bytes = F.octet_length(F.coalesce(F.col("text"), F.lit("")))
    dimensions = {
        "size": F.log2(n_bytes + 1),
        "lang": F.crc32(F.col("lang").cast("binary")) % 1024,
        "source": F.crc32(F.col("source").cast("binary")) % 1024,
        "id": F.col("doc_id"),
    }
    return kd_shards(df, dimensions, shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
