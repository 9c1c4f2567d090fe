"""Language identification by multinomial naive Bayes (operator 9).

A text is the multiset of its character n-grams (orders 1 to 3 of the lower-cased
code points), hashed into a fixed number of buckets. Training counts buckets
per language on executors; the log-probability matrix, buckets x languages and
so bounded by parameters, is broadcast; tasks score whole batches with numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import values

BUCKET_BITS = 16
ORDERS = (1, 2, 3)
SMOOTHING = 0.1
# Expected number of training rows taken per language, chosen by a hash of the id.
TRAIN_ROWS = 20_000
# Language labels are codes; more than this are not labels of languages. The matrix
# (buckets x languages, 8 bytes while it is fitted) then takes at most 105 MB.
MOST_LANGS = 200
# Texts are worked through in windows of so many characters.
WINDOW = 1 << 20
# Places of the matrix gathered at once.
GATHER = 1 << 20
UNDETERMINED = "und"
# N-grams of usual likelihood that are added to each text's own.
TYPICAL = 30


def buckets(text: str) -> np.ndarray:
    """Bucket of every n-gram of one window of text."""
    u = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    out = []
    for n in ORDERS:
        if len(u) >= n:
            h = np.full(len(u) - n + 1, n, np.uint32)
            for k in range(n):
                h = (h ^ u[k : len(u) - n + 1 + k]) * np.uint32(0x9E3779B1)
                h ^= h >> np.uint32(15)
            out.append((h * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BUCKET_BITS))
    return np.concatenate(out) if out else np.empty(0, np.uint32)


def windows(text: str) -> Iterator[str]:
    """The whole text in windows; neighbours share what an n-gram needs."""
    yield from (text[at : at + WINDOW + max(ORDERS) - 1] for at in range(0, max(1, len(text)), WINDOW))


@dataclass
class LanguageModel:
    """``matrix[bucket, language]`` holds log probabilities, ``prior`` the log
    shares of the languages in the labelled rows; ``usual`` is the mean log
    probability of a language's n-grams in its own labelled rows, ``unseen`` that of
    an n-gram they do not hold."""

    langs: list[str]
    matrix: np.ndarray
    prior: np.ndarray
    usual: np.ndarray
    unseen: np.ndarray


def held_out(id_col: Column) -> Column:
    """Rows kept from training: crc32 of the id's text, modulo 5, is 0. A null
    id is neither held out nor learned from."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(labelled: DataFrame, train_rows: int = TRAIN_ROWS) -> LanguageModel:
    """Fit on ``labelled`` (columns ``id, text, lang``; none null).

    About ``train_rows`` rows of each language are used, picked by a hash of
    id and text, so the work is bounded and the same rows give the same model.
    Without rows the model knows no language.
    """
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().limit(MOST_LANGS + 1).collect()}
    if len(counts) > MOST_LANGS:
        raise ValueError(f"more than {MOST_LANGS} language labels")
    langs = sorted(counts)
    if not langs:
        return LanguageModel([], np.empty((1 << BUCKET_BITS, 0), np.float32), *[np.empty(0)] * 3)
    most = F.element_at(F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, train_rows / counts[k]))]), F.col("lang"))
    picked = labelled.where(F.pmod(F.xxhash64("id", "text"), F.lit(1_000_003)) < most * 1_000_003)
    number = {k: n for n, k in enumerate(langs)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(values(batch, "text"), values(batch, "lang"), strict=True):
                k = number[lang]
                if k not in seen:
                    seen[k] = np.zeros(1 << BUCKET_BITS, np.int64)
                for part in windows(text):
                    seen[k] += np.bincount(buckets(part), minlength=1 << BUCKET_BITS)
        for k, n in seen.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), k, np.int32)), pa.array(at.astype(np.int32)), pa.array(n[at])], names=["lang", "bucket", "n"]
            )

    # At most buckets x languages rows reach the driver.
    total = (
        picked.select("text", "lang")
        .mapInArrow(count, "lang int, bucket int, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    matrix = np.zeros((1 << BUCKET_BITS, len(langs)))
    matrix[total["bucket"], total["lang"]] = total["n"]
    share = matrix / np.maximum(1, matrix.sum(0))
    unseen = np.log(SMOOTHING / (matrix.sum(0) + SMOOTHING * len(matrix)))
    matrix = np.log((matrix + SMOOTHING) / (matrix.sum(0) + SMOOTHING * len(matrix)))
    rows = np.array([counts[k] for k in langs], float)
    return LanguageModel(langs, matrix.astype(np.float32), np.log(rows / rows.sum()), (share * matrix).sum(0), unseen)


def score_batch(texts: list[str | None], model: LanguageModel) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(language, posterior, usual) of each text; texts without a letter are
    undetermined with 0 and 0. Ties go to the first label in order. ``usual`` is 1
    if the text's n-grams are on average as likely as the language's own, 0 if as
    unlikely as unseen ones; TYPICAL usual n-grams are added to it, so that a few
    odd ones in a short text say little."""
    sums = np.tile(model.prior, (len(texts), 1))
    n_grams = np.zeros(len(texts))
    known = np.array([bool(model.langs) and t is not None and any(map(str.isalpha, t)) for t in texts], bool)
    parts: list[np.ndarray] = []
    owner: list[int] = []
    waiting = 0

    def add() -> None:
        if parts:
            at = np.cumsum([0] + [len(p) for p in parts[:-1]])
            np.add.at(sums, owner, np.add.reduceat(model.matrix[np.concatenate(parts)], at, axis=0, dtype=np.float64))

    for k, text in enumerate(texts):
        if known[k]:
            for part in windows(text):
                parts.append(buckets(part))
                owner.append(k)
                n_grams[k] += len(parts[-1])
                waiting += len(parts[-1])
                if waiting > GATHER:
                    add()
                    parts, owner, waiting = [], [], 0
    add()
    if not model.langs:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
    best = sums.argmax(1)
    at = np.arange(len(texts)), best
    mean = (sums[at] - model.prior[best] + TYPICAL * model.usual[best]) / (n_grams + TYPICAL)
    usual = (mean - model.unseen[best]) / (model.usual[best] - model.unseen[best])
    sums -= sums.max(1, keepdims=True)
    share = np.exp(sums)
    share /= share.sum(1, keepdims=True)
    langs = [model.langs[b] if ok else UNDETERMINED for b, ok in zip(best, known, strict=True)]
    return langs, np.where(known, share[at], 0.0), np.where(known, usual, 0.0)


def predict(df: DataFrame, model: LanguageModel, text_col: str = "text", usual_col: str | None = None) -> DataFrame:
    """``df`` with ``lang_pred`` and ``score``, and with ``usual_col`` how usual the
    text is in that language (see ``score_batch``); columns of these names are
    replaced. Null, empty and letterless texts get ``und`` and 0. A map over the
    scan: no shuffle."""
    more = [usual_col] if usual_col else []
    kept = df.drop("lang_pred", "score", *more)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                langs, *figures = score_batch(list(values(batch, text_col)), shared.value)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(langs, pa.string()), *map(pa.array, figures[: 1 + len(more)])],
                    names=[*batch.schema.names, "lang_pred", "score", *more],
                )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(score, f"{schema + ', ' if schema else ''}lang_pred string, score double" + "".join(f", `{c}` double" for c in more))


def labelled_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Rows to learn from: id, text and language known, not held out."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    return rows.where("id is not null and text is not null and lang is not null").where(~held_out(F.col("id")))


def identify(df: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Fit on the labelled rows of ``df`` that are not held out and predict all
    rows: ``doc_id, held_out, lang_pred, score``."""
    model = fit(labelled_rows(df), train_rows)
    rows = df.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return predict(rows, model).select("doc_id", "held_out", "lang_pred", "score")
