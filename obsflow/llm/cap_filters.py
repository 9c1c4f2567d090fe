"""Embedding near-duplicates by spherical-cap filters (operator 4).

Filter directions are the words of a random product code: after a random
rotation a vector is cut into blocks, each block has its own random codewords,
and a direction is one codeword per block. A vector goes to every direction on
which it exceeds a threshold; these are list-decoded from the blocks' inner
products without looking at the other directions. Vectors that share a
direction are candidates, whose cosine is verified in double precision.
Several codes are used, as many as the recall asks for that is measured on
random pairs at exactly the wanted cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import values, written
from .components import components

COSINE = 0.93
RECALL = 0.999  # of random pairs at exactly the wanted cosine
TRIALS = 2_000  # such pairs tried when the number of codes is chosen
# Two blocks: the more blocks, the more the lists of vectors differ in length.
BLOCKS, CODEWORDS = 2, 512
BLOCK_DIMS = 24  # least dimensions of a block; vectors with fewer than two such have one
# Directions of one code that a random vector exceeds on average, and the most
# codes; longer lists are tried if these are not enough.
LISTS = (48, 96, 192)
MOST_CODES = 16


@dataclass
class ProductCode:
    rotation: np.ndarray  # dimension x padded dimension
    words: np.ndarray  # block x codeword x dimension of a block
    threshold: float

    def decode(self, unit: np.ndarray) -> np.ndarray:
        """Numbers of all directions that a unit vector exceeds."""
        blocks, n, _ = self.words.shape
        parts = np.einsum("bnd,bd->bn", self.words, (unit @ self.rotation).reshape(blocks, -1)) / np.sqrt(blocks)
        # the blocks are joined from the left; a part is dropped once the best
        # words of the blocks to come cannot lift it over the threshold
        rest = np.append(np.cumsum(parts.max(1)[::-1])[::-1], 0.0)
        score, number = np.zeros(1), np.zeros(1, np.int64)
        for k in range(blocks):
            score = (score[:, None] + parts[k]).ravel()
            number = (number[:, None] * n + np.arange(n)).ravel()
            good = score >= self.threshold - rest[k + 1]
            score, number = score[good], number[good]
        return number


def decode(codes: tuple[ProductCode, ...], unit: np.ndarray) -> np.ndarray:
    """Directions of all codes; those of different codes differ."""
    return np.concatenate([c.decode(unit) + (k << 40) for k, c in enumerate(codes)])


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


@lru_cache(maxsize=8)
def product_codes(dim: int, cosine: float = COSINE) -> tuple[ProductCode, ...]:
    """So many codes that the wanted recall is reached; the same on every
    machine, as all choices come from a fixed seed."""
    rng = np.random.Generator(np.random.PCG64([7, dim]))
    if dim == 1:  # only the sign counts
        return (ProductCode(np.ones((1, 1)), np.array([[[1.0], [-1.0]]]), 0.5),)
    blocks = BLOCKS if dim >= BLOCKS * BLOCK_DIMS else 1
    padded = -(-dim // blocks) * blocks
    x, z = _unit(rng.standard_normal((TRIALS, dim))), rng.standard_normal((TRIALS, dim))
    z -= (z * x).sum(1, keepdims=True) * x
    pairs = list(zip(x, cosine * x + np.sqrt(1 - cosine**2) * _unit(z), strict=True))
    for size in LISTS:
        codes, left = [], pairs
        while len(codes) < MOST_CODES:
            rotation = np.linalg.qr(rng.standard_normal((padded, padded)))[0][:dim]
            words = _unit(rng.standard_normal((blocks * CODEWORDS, padded // blocks))).reshape(blocks, CODEWORDS, -1)
            code = ProductCode(rotation, words, NormalDist().inv_cdf(1 - size / CODEWORDS**blocks) / np.sqrt(dim))
            left = [(a, b) for a, b in left if not np.intersect1d(code.decode(a), code.decode(b)).size]
            codes.append(code)
            if len(left) <= (1 - RECALL) * TRIALS:
                return tuple(codes)
    raise ValueError(f"no code reaches the recall for vectors of {dim} components")


def usable(vector: Column) -> Column:
    """Not null, not zero, all components finite."""
    d = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(d, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(d, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> list[np.ndarray]:
    """Unit vectors; scaled by the largest component first, so that squares
    neither overflow nor vanish."""
    out = []
    for v in column:
        x = np.asarray(v.values.to_numpy(zero_copy_only=False), np.float64)
        x = x / np.abs(x).max()
        out.append(x / np.sqrt(x @ x))
    return out


def filtered(classes: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``label, dim, direction, id``: a row for each direction a vector exceeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                found = [(len(u), decode(product_codes(len(u), cosine), u)) for u in _matrix(batch.column("vector"))]
                take = pa.array(np.repeat(np.arange(len(found)), [len(f) for _, f in found]))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("label").take(take),
                        pa.array(np.repeat([n for n, _ in found], [len(f) for _, f in found]).astype(np.int32)),
                        pa.array(np.concatenate([f for _, f in found]) if found else np.empty(0, np.int64)),
                        batch.column("id").take(take),
                    ],
                    names=["label", "dim", "direction", "id"],
                )

    label = classes.schema["label"].dataType.simpleString()
    return classes.select("id", "label", "vector").mapInArrow(run, f"label {label}, dim int, direction long, id long")


def _verified(pairs: DataFrame, cosine: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2_000):
                batch = whole.slice(at, 2_000)
                x, y = _matrix(batch.column("va")), _matrix(batch.column("vb"))
                kept = pa.array([bool(p @ q >= cosine) for p, q in zip(x, y, strict=True)], pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column("a").filter(kept), batch.column("b").filter(kept)], names=["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


def cosine_links(classes: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Pairs ``a < b`` of class ids with equal label and cosine at or above the
    threshold; ``classes`` (``id, label, vector``) is a written table.

    The directions are written, so both sides of the join on them are plain
    exchanges and a direction met by very many vectors is split. No direction,
    list or pair is capped.
    """
    rows = written(filtered(classes, cosine), "cap-filters")
    on = ["label", "dim", "direction"]
    pairs = rows.join(rows.select(*on, F.col("id").alias("b")), on).where("id < b").select(F.col("id").alias("a"), "b").distinct()
    pairs = written(pairs, "cap-pairs")
    a = classes.select(F.col("id").alias("a"), F.col("vector").alias("va"))
    b = classes.select(F.col("id").alias("b"), F.col("vector").alias("vb"))
    return _verified(pairs.join(a, "a").join(b, "b").select("a", "b", "va", "vb"), cosine)


def near_vectors(
    df: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """One row per input row: ``vec_id, n_links, component_id, kept``.

    Only rows of the same label are compared; a null label, and a vector that
    is null, zero or holds a null or non-finite component, links with nothing,
    as do vectors of different lengths. Equal vectors of a label are one class
    (linked with each other, compared with others once). Ids are integers;
    rows that repeat an id are taken as copies that share it. Other columns
    are not read; an empty table gives an empty result.
    """
    vector = F.col("vector")
    rows = written(
        df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
        .withColumn("good", usable(vector) & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
        .withColumns({"h1": F.xxhash64("vector"), "h2": F.xxhash64(F.lit("second"), "vector")}),
        "cap-rows",
    )
    key = ["label", "h1", "h2"]
    classes = written(
        rows.where("good").groupBy(*key).agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector")),
        "cap-classes",
    )
    links = written(cosine_links(classes.select("id", "label", "vector"), cosine), "cap-links")
    ends = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = ends.join(classes.select(F.col("id").alias("b"), "copies"), "b").groupBy("a").agg(F.sum("copies").alias("others"))
    found = components(links)
    placed = written(
        classes.join(others, classes["id"] == others["a"], "left")
        .join(found, classes["id"] == found["node"], "left")
        .select(*key, (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id")),
        "cap-placed",
    )
    out = rows.select("vec_id", "good", *[F.when(F.col("good"), F.col(c)).alias(c) for c in key]).join(placed, key, "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
