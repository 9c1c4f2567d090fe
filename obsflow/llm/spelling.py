"""Spelling variants by pivotal grams (operator 13).

The vocabulary of a corpus is counted, and words at an edit distance of one are
found without comparing all words:

- the bigrams of a word are ordered by how many words hold them, rarest first;
  its *prefix* is the first three (two edits' worth of overlapping bigrams and
  one more), with all places of the last of them;
- its *pivots* are two bigrams of the prefix that do not overlap, chosen by
  dynamic programming so that the fewest words hold them. One edit can hurt
  only one of two disjoint bigrams, so the other is found in the partner;
- of two near words, take the one whose prefix ends earlier in the order: one of its
  pivots then stands in the other's prefix. So pivots are looked up in an index
  of prefixes only;
- position limits: an edit lies before or behind the unhurt pivot, so on
  one side of it the words agree. A pivot is looked up by its place and the part
  of the word up to its end, and by its place from the end and the part from
  its start, with partners at most one shorter or longer;
- what meets is verified by its edit distance.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, written

# Letters of a word. Lower-cased A-Z and these make at most 90 * 90 bigrams.
LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH = 6
LEAST_COUNT = 5
# A form is so many times as frequent as its variant.
RATIO = 5
# One run in so many (by its checksum with the document's id) loses a letter.
DAMAGE = 199
EDITS = 1
GRAM = 2
# Distinct words that a task holds before it writes them out.
WORDS_HELD = 500_000


def _lower(run: str) -> str:
    """A-Z lower-cased, other letters as they are."""
    return run.lower() if run.isascii() else run.encode().lower().decode()


def damaged(doc_id: str, run: str) -> str:
    """The run, without one letter if its checksum says so."""
    h = crc32(f"{doc_id}:{run}".encode())
    if h % DAMAGE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n``: the words of all whole texts that are long and frequent
    enough. Tasks count before the shuffle."""
    # A shorter run can never give a word: damage only shortens it.
    runs = re.compile(f"[{LETTERS}]{{{LEAST_LENGTH},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                doc_id = doc_id.as_py() or ""
                for run, n in Counter(map(_lower, runs.findall(text.as_py() or ""))).items():
                    word = damaged(doc_id, run)
                    if len(word) >= LEAST_LENGTH:
                        seen[word] += n
                if len(seen) >= WORDS_HELD:
                    yield out()
                    seen.clear()
        if seen:
            yield out()

    rows = df.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    counted = rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= LEAST_COUNT)


def prefix_of(word: str, rank: dict[str, int]) -> list[tuple[int, int]]:
    """(rank, place) of the first GRAM * EDITS + 1 bigrams in the order, with
    every place of the last one."""
    grams = sorted((rank[word[k : k + GRAM]], k) for k in range(len(word) - GRAM + 1))
    last = grams[min(GRAM * EDITS, len(grams) - 1)][0]
    return [g for g in grams if g[0] <= last]


def pivots_of(prefix: list[tuple[int, int]], held: list[int]) -> list[int]:
    """Places of the EDITS + 1 disjoint bigrams of a prefix that the fewest words
    hold (``held`` by rank), by dynamic programming over the places."""
    grams = sorted((place, held[rank]) for rank, place in prefix)
    # best[j]: least cost of j disjoint bigrams that end before the present place, and their places
    ended: list[tuple[int, list[tuple[float, list[int]]]]] = [(0, [(0, [])] + [(math.inf, [])] * (EDITS + 1))]
    for place, cost in grams:
        before = next(best for end, best in reversed(ended) if end <= place)
        now = list(ended[-1][1])
        for j in range(1, EDITS + 2):
            taken = before[j - 1][0] + cost
            if taken < now[j][0]:
                now[j] = (taken, before[j - 1][1] + [place])
        ended.append((place + GRAM, now))
    return ended[-1][1][EDITS + 1][1]


def near_words(words: DataFrame) -> DataFrame:
    """Pairs ``a, n_a, b, n_b`` of ``words`` (``word, n``) at an edit distance of
    one, each pair once."""
    gram = F.explode(F.transform(F.sequence(F.lit(1), F.char_length("word") - GRAM + 1), lambda k: F.col("word").substr(k, F.lit(GRAM))))
    # At most 90 * 90 rows: the letters are fixed.
    order = words.select(gram.alias("gram")).groupBy("gram").count().collect()
    order = sorted((r["count"], r["gram"]) for r in order)
    held, rank = [n for n, _ in order], {g: k for k, (_, g) in enumerate(order)}

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 10_000):
                batch = whole.slice(at, 10_000)
                out: list[tuple] = []
                for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True):
                    prefix = prefix_of(word, rank)
                    last, size = prefix[-1][0], len(word)
                    for _, k in prefix:
                        out.append((False, word[: k + GRAM], "<", size, word, n, last))
                        out.append((False, word[k:], ">", size, word, n, last))
                    for k in pivots_of(prefix, held):
                        for length in range(size - EDITS, size + EDITS + 1):
                            out.append((True, word[: k + GRAM], "<", length, word, n, last))
                            out.append((True, word[k:], ">", length, word, n, last))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                    names=["is_pivot", "part", "side", "length", "word", "n", "last"],
                )

    types = [pa.bool_(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int32()]
    entries = words.select("word", "n").mapInArrow(index, "is_pivot boolean, part string, side string, length int, word string, n long, last int")
    entries = written(entries.select("is_pivot", F.xxhash64("part", "side", "length").alias("key"), "word", "n", "last"), "spelling-index")
    pivots = entries.where("is_pivot").select("key", F.col("word").alias("a"), F.col("n").alias("n_a"), F.col("last").alias("last_a"))
    prefixes = entries.where("not is_pivot").select("key", F.col("word").alias("b"), F.col("n").alias("n_b"), F.col("last").alias("last_b"))
    ordered = (F.col("last_a") < F.col("last_b")) | ((F.col("last_a") == F.col("last_b")) & (F.col("a") < F.col("b")))
    near = pivots.join(prefixes, "key").where(ordered).where(F.levenshtein("a", "b", EDITS) == EDITS)
    pairs = written(near.select("a", "n_a", "b", "n_b").distinct(), "spelling-pairs")
    forget(entries)
    return pairs


def with_roots(words: DataFrame, most: int) -> DataFrame:
    """``words`` with ``root``: the end of the chain of forms. Each form is RATIO
    times as frequent, so ``most``, the largest count, bounds the chains, and
    every round doubles the steps taken."""
    steps = max(0, math.floor(math.log(max(1, most) / LEAST_COUNT, RATIO))) if most >= LEAST_COUNT else 0
    links = words.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(max(0, math.ceil(math.log2(steps + 1)))):
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = links.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return words.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word of the corpus: ``word, form, root, n, n_near, form_n``.
    ``form`` is the most frequent near word, if it is frequent enough to be what was
    meant; ``root`` where its chain of forms ends.

    - null and empty texts hold no words; a null id counts as an empty one
      where a run's checksum is taken;
    - whole texts are read, whatever their length;
    - repeated rows count each time; of near words equally frequent, the smallest
      in code-point order is the form;
    - an empty table gives an empty result;
    - other columns are not read, whatever their names.
    """
    words = written(word_counts(df, id_col, text_col), "spelling-words")
    pairs = near_words(words)
    ends = F.explode(
        F.array(
            F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("m")),
            F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("m")),
        )
    )
    best = (
        pairs.select(ends.alias("x"))
        .select("x.*")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), F.col("near").alias("near"))).alias("best"))
    )
    frequent = -F.col("best.less") >= RATIO * F.col("n")
    found = words.join(best, "word", "left").select(
        "word",
        F.when(frequent, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, -F.col("best.less")).alias("form_n"),
    )
    found = written(found, "spelling-forms")
    most = words.agg(F.max("n")).first()[0] or 0
    result = written(with_roots(found, most).select("word", "form", "root", "n", "n_near", "form_n"), "spelling-groups")
    forget(words, pairs, found)
    return result
