"""Line deduplication by pairwise alignment (operator 7).

Documents that share a run of neighbouring lines of some length overlap: from
each line on, the shortest run that has enough words, often that line alone.
For each such run, every document that holds it is paired with the first one
that does, so the number of pairs is at most the number of lines, however many
documents share one. Each
pair is aligned with patience diff: lines that are rare, occurring once in
either document, anchor the alignment, and the gaps are aligned in turn. The
common blocks are deleted from the later document. A line that is deleted has
an earlier copy, and the first copy of all is never deleted.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import values, written

# Least words of a run of lines that brings two documents together, and of a
# common block that is deleted.
BLOCK_WORDS = 5
# Scripts without spaces between words: each character counts as a word.
UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}"

# White space at the ends of a line (what \\s is, without the line break).
SPACES = " \t\x0b\f\r"

DOC = ["doc_id", "t1", "t2"]  # a document: its id and a 128-bit hash of its text


def longest_increasing(pairs: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs that increase in the second place; ``pairs`` is
    sorted by the first."""
    tails: list[int] = []  # least last value of a run of each length
    at: list[int] = []
    back: list[int] = []
    for k, (_, y) in enumerate(pairs):
        n = bisect_left(tails, y)
        if n == len(tails):
            tails.append(y)
            at.append(k)
        else:
            tails[n], at[n] = y, k
        back.append(at[n - 1] if n else -1)
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def _by_occurrence(a: Sequence[int], i: int, b: Sequence[int], j: int) -> list[tuple[int, int]]:
    """Positions of the k-th occurrences of a line in both parts."""
    place: dict[int, list[int]] = {}
    for k, x in enumerate(b, j):
        place.setdefault(x, []).append(k)
    seen: Counter = Counter()
    out = []
    for k, x in enumerate(a, i):
        if seen[x] < len(place.get(x, ())):
            out.append((k, place[x][seen[x]]))
        seen[x] += 1
    return out


def patience(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """Matched positions of two sequences, increasing in both.

    Equal ends are matched first, then the lines that occur once in each part
    anchor the rest; in parts without such lines, the first occurrences of a
    line match each other, the second ones, and so on.
    """
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, m, j, n = todo.pop()
        while i < m and j < n and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            out.append((m, n))
        if i == m or j == n:
            continue
        once_a, once_b = Counter(a[i:m]), Counter(b[j:n])
        place = {x: k for k, x in enumerate(b[j:n], j) if once_b[x] == 1}
        anchors = longest_increasing([(k, place[x]) for k, x in enumerate(a[i:m], i) if once_a[x] == 1 and x in place])
        if not anchors:
            anchors = longest_increasing(_by_occurrence(a[i:m], i, b[j:n], j))
        if not anchors:
            continue
        for x, y in anchors:
            todo.append((i, x, j, y))
            i, j = x + 1, y + 1
            out.append((x, y))
        todo.append((i, m, j, n))
    return sorted(out)


def _blocks(a: Sequence[int], b: Sequence[int], words: Sequence[int], least: int) -> list[int]:
    out: list[int] = []
    block: list[int] = []
    before = None
    for x, y in [*patience(a, b), (-1, -1)]:
        if before is not None and (x, y) != (before[0] + 1, before[1] + 1):
            if sum(words[k] for k in block) >= least:
                out += block
            block = []
        block.append(y)
        before = x, y
    return out


def common_blocks(a: Sequence[int], b: Sequence[int], words: Sequence[int], least: int = BLOCK_WORDS) -> list[int]:
    """Positions in ``b`` of the aligned blocks, runs of neighbours in both,
    that have at least ``least`` words (``words``: of each line of ``b``).

    One alignment keeps the order of the lines. Blocks that moved, or that ``b``
    repeats, are aligned one by one: each run of ``b`` that is also a run of ``a``
    and does not lie in a block yet is laid upon its first place in ``a``, and
    the block grows from there as long as the lines agree. Every line is grown
    over once, so the time is in proportion to the lines, however often one
    is repeated.
    """
    inside = [False] * len(b)
    for k in _blocks(a, b, words, least):
        inside[k] = True
    known = dict(zip(b, words, strict=True))
    place: dict[tuple[int, ...], int] = {}
    for i, j in runs([known.get(x, 0) for x in a], least):
        place.setdefault(tuple(a[i:j]), i)
    for i, j in runs(words, least):
        if all(inside[i:j]) or (at := place.get(tuple(b[i:j]))) is None:
            continue
        shift = at - i
        while j < len(b) and j + shift < len(a) and a[j + shift] == b[j]:
            j += 1
        while i > 0 and i + shift > 0 and not inside[i - 1] and a[i - 1 + shift] == b[i - 1]:
            i -= 1
        inside[i:j] = [True] * (j - i)
    return [k for k, x in enumerate(inside) if x]


def runs(words: Sequence[int], least: int = BLOCK_WORDS) -> list[tuple[int, int]]:
    """From each line with words on, the shortest run (begin, end) of at least
    ``least`` words; none where the text ends before."""
    n = np.asarray(words, np.int64)
    total = np.cumsum(n)
    begin = np.flatnonzero(n)
    end = np.searchsorted(total, total[begin] - n[begin] + least) + 1
    return [(i, j) for i, j in zip(begin.tolist(), end.tolist(), strict=True) if j <= len(n)]


def _run_keys(lines: list[int], words: list[int]) -> np.ndarray:
    """Distinct keys of a document's runs; that of a single line is its hash."""
    data = np.array(lines, np.int64).tobytes()
    keys = [lines[i] if j == i + 1 else xxhash.xxh3_64_intdigest(data[8 * i : 8 * j]) - (1 << 63) for i, j in runs(words)]
    return np.unique(np.array(keys, np.int64))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _profile(df: DataFrame) -> DataFrame:
    """``doc_id, t1, t2, lines, words``: hashes of a document's lines (without
    spaces at the ends) and their numbers of words."""
    trimmed = F.transform(_lines(F.col("text")), lambda x: F.btrim(x, F.lit(SPACES)))
    spaced, unspaced = F.lit(r"\S+"), F.lit(rf"[{UNSPACED}]|[^\s{UNSPACED}]+")
    counted = lambda x: F.regexp_count(x, F.when(F.char_length(x) == F.octet_length(x), spaced).otherwise(unspaced))
    return (
        df.withColumn("trimmed", trimmed)
        .select(*DOC, F.transform("trimmed", lambda x: F.xxhash64(x)).alias("lines"), F.transform("trimmed", counted).alias("words"))
    )


def _keyed(df: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """``doc_id, t1, t2``: a document's key; with the text, or ``more`` instead."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = [F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit("second"), text).alias("t2")]
    return df.select(*key, *(more or [text.alias("text")]))


def duplicate_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, t1, t2, n_lines, gone``: for every distinct document of
    ``df``, the positions (from 0) of the lines that it repeats from earlier
    documents. Documents are ordered by id, and by their text's hash where ids
    are equal; rows equal in both are one document."""
    profile = written(_profile(_keyed(df, id_col, text_col)).dropDuplicates(DOC), "lines-profile")
    # Equal texts align whole, so one document of them stands for all.
    doc = F.struct(*DOC)
    first_copy = written(profile.groupBy("t1", "t2").agg(F.min("doc_id").alias("first_id")), "lines-copies")
    profile = profile.join(first_copy, ["t1", "t2"])
    copies = profile.where(F.col("first_id").isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") > F.col("first_id"))))
    total = F.aggregate("words", F.lit(0), lambda s, x: s + x)
    whole = copies.where(total >= BLOCK_WORDS).select(*DOC, F.sequence(F.lit(0), F.size("lines") - 1).alias("gone"))
    distinct = written(
        profile.where(F.col("doc_id").eqNullSafe(F.col("first_id"))).select(doc.alias("doc"), "lines", "words").dropDuplicates(["doc"]), "lines-distinct"
    )

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [_run_keys(x, n) for x, n in zip(values(batch, "lines"), values(batch, "words"), strict=True)]
            docs = batch.column("doc").take(pa.array(np.repeat(np.arange(len(keys)), [len(k) for k in keys])))
            yield pa.RecordBatch.from_arrays([docs, pa.array(np.concatenate(keys), pa.int64())], names=["doc", "line"])

    held = distinct.mapInArrow(keyed, f"doc {distinct.schema['doc'].dataType.simpleString()}, line long")
    holders = written(
        held.groupBy("line").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last").select("line", "first"), "lines-holders"
    )
    pairs = written(held.join(holders, "line").where("first < doc").select("first", "doc").distinct(), "lines-pairs")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone = [
                common_blocks(a, b, words)
                for a, b, words in zip(values(batch, "a"), values(batch, "b"), values(batch, "words"), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in DOC), pa.array(gone, pa.list_(pa.int32()))], names=[*DOC, "gone"]
            )

    a = distinct.select(F.col("doc").alias("first"), F.col("lines").alias("a"))
    b = distinct.select("doc", F.col("lines").alias("b"), "words")
    id_type = profile.schema["doc_id"].dataType.simpleString()
    aligned = (
        pairs.join(a, "first")
        .join(b, "doc")
        .select("doc.doc_id", "doc.t1", "doc.t2", "a", "b", "words")
        .mapInArrow(align, f"doc_id {id_type}, t1 long, t2 long, gone array<int>")
    )
    # A document has no more pairs than lines, so its lists stay in proportion to it.
    merged = aligned.groupBy(*DOC).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("gone"))
    gone = whole.unionByName(merged.where(F.size("gone") > 0))
    return written(gone, "lines-gone")


def _without(text: Column, gone: Column) -> Column:
    """The text without the lines at the given positions."""
    numbered = F.transform(_lines(text), lambda x, k: F.struct(x.alias("line"), k.alias("k")))
    kept = F.filter(numbered, lambda x: ~F.array_contains(gone, x["k"]))
    return F.array_join(F.transform(kept, lambda x: x["line"]), "\n")


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", gone_col: str = "gone_lines") -> DataFrame:
    """``df`` with the repeated lines removed from the text, and their
    positions in ``gone_lines`` (empty if nothing went).

    A null text stays null, an empty one empty; a document all of whose lines
    are repeated ends empty. Short lines go only as part of a block of at least
    five words. Repeated rows (equal id and text) stay equal. All other columns
    stay as they are.
    """
    gone = duplicate_lines(df, id_col, text_col).select(
        F.col("doc_id").alias("id"), F.col("t1").alias("h1"), F.col("t2").alias("h2"), F.col("gone").alias("positions")
    )
    # The caller's columns travel in one, so that no name of theirs is met.
    keyed = _keyed(df, id_col, text_col, F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    joined = keyed.join(gone, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("t1") == F.col("h1")) & (F.col("t2") == F.col("h2")), "left")
    given = F.col("row").getField(text_col)
    clean = F.when(F.col("positions").isNull(), given).otherwise(_without(given, F.col("positions")))
    return joined.select(
        *[(clean if c == text_col else F.col("row").getField(c)).alias(c) for c in df.columns if c != gone_col],
        F.coalesce("positions", F.array().cast("array<int>")).alias(gone_col),
    )


def deduplicated_documents(df: DataFrame) -> DataFrame:
    """Per row of ``df``: ``doc_id, n_lines, n_gone, gone`` (positions, comma
    separated) ``, text, text_sha256`` after the removal."""
    rows = df.select("doc_id", "text", F.size(_lines(F.coalesce("text", F.lit("")))).cast("long").alias("n_lines"))
    out = dedup_lines(rows)
    return out.select(
        "doc_id",
        "n_lines",
        F.size("gone_lines").cast("long").alias("n_gone"),
        F.array_join(F.col("gone_lines").cast("array<string>"), ",").alias("gone"),
        "text",
        F.sha2("text", 256).alias("text_sha256"),
    )
