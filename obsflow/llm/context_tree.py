"""Language-model scoring by context-tree weighting (operator 12).

A text is coded as its UTF-8 bytes and one end symbol (the byte 255, which no
UTF-8 text holds), eight binary decisions a byte. A decision is made at a node
(the bits of the byte so far) under a context (the bytes before, as far as
``DEPTH``; the end symbol stands before a text's first byte). Every context of
every length holds a Krichevsky-Trofimov estimate of its zeros and ones, and
the probability of a decision mixes the estimates of all depths with the
weights of the context tree:

    P_w(s) = (P_kt(s) + product of P_w over the contexts one byte longer) / 2

The counts come from all training texts; they are frozen while texts are scored,
so a text's score does not depend on other texts being scored. Scores are
probabilities of whole texts: over all texts they sum to one.

How the work is spread. A *gram* is a context of DEPTH bytes and the byte
after it; the score of a text is a sum over its grams. Documents are dealt
into groups of about ``GROUP_BYTES`` by a hash. Tasks reduce each group to its
distinct grams and words. The tree is cut at ``CUT`` bytes of context: all
grams with the same last CUT bytes (at most 2**24 of them with DEPTH 4) make a
subtree that one task weighs with numpy; the at most 255 * 257 nodes above the cut
are weighed on the driver. The logarithms of a group's grams are then joined
back to the group, and its texts are scored with that table. Nothing that grows
with the corpus is broadcast or collected.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .common import forget, written

DEPTH = 4
# Contexts of so many bytes are the roots of the subtrees that tasks weigh.
CUT = 2
END = 255
GROUP_BYTES = 12 << 20
# Positions worked through at once; grams weighed at once (whole subtrees).
WINDOW = 1 << 19
WEIGHED = 1 << 18
# Distinct words that a task holds, over all its groups, before it writes those of
# the largest groups out. A group written twice only has some words twice.
WORDS_HELD = 600_000

LN2 = math.log(2)


def ln_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x > 0: Stirling's series after
    moving the argument up by eight."""
    x = np.asarray(x, float)
    below = x * (x + 1) * (x + 2) * (x + 3)
    below2 = (x + 4) * (x + 5) * (x + 6) * (x + 7)
    z = x + 8
    i2 = 1 / (z * z)
    series = (1 / 12 - i2 * (1 / 360 - i2 * (1 / 1260 - i2 * (1 / 1680 - i2 / 1188)))) / z
    return (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + series - np.log(below) - np.log(below2)


def ln_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov block probability."""
    return ln_gamma(zeros + 0.5) + ln_gamma(ones + 0.5) - ln_gamma(zeros + ones + 1) - math.log(math.pi)


def kt_one(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return (ones + 0.5) / (zeros + ones + 1)


def _weigh(zeros, ones, below) -> tuple[np.ndarray, np.ndarray]:
    """(log of the weighted probability, weight of the own estimate) of nodes
    whose longer contexts have the log product ``below``."""
    own = ln_kt(zeros, ones)
    return np.logaddexp(own, below) - LN2, 1 / (1 + np.exp(np.clip(below - own, -700, 700)))


def pieces_of(text: bytes, depth: int) -> Iterator[bytes]:
    """A text with its end symbol in windows, each after the ``depth`` bytes
    before it."""
    whole = bytes([END]) * depth + text + bytes([END])
    for at in range(0, len(text) + 1, WINDOW):
        yield whole[at : at + WINDOW + depth]


def grams_of(pieces: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """All grams of the pieces in order, and where each piece's grams start."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    n = len(data) - depth
    gram = data[:n].astype(np.uint64)
    for k in range(1, depth + 1):
        gram <<= np.uint64(8)
        gram |= data[k : n + k]
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    if len(pieces) > 1:
        # a window that reaches over the start of a piece is no gram
        starts = np.cumsum(sizes)[:-1]
        real = np.ones(n, bool)
        real[(starts[:, None] - depth + np.arange(depth)).ravel()] = False
        gram = gram[real]
    return gram, np.cumsum(sizes - depth) - (sizes - depth)


class Subtrees:
    """The nodes of one bit of the byte, below the cut, for some whole subtrees.

    ``gram`` ascending and distinct, ``n`` their training counts. Decisions about
    different bits share no node, so each bit is a tree of its own.
    """

    def __init__(self, gram: np.ndarray, n: np.ndarray, bit: int, depth: int, cut: int):
        byte = gram & np.uint64(255)
        key = gram >> np.uint64(8) << np.uint64(8) | np.uint64(1 << bit) | byte >> np.uint64(8 - bit)
        self.bits = (byte >> np.uint64(7 - bit) & np.uint64(1)).astype(bool)
        # grams that share a node follow each other
        first = np.flatnonzero(np.diff(key, prepend=~key[:1]))
        self.at = np.repeat(np.arange(len(first)), np.diff(first, append=len(key)))
        key = key[first]
        ones = np.add.reduceat(n * self.bits, first).astype(float)
        zeros = np.add.reduceat(n, first) - ones
        self.leaf = kt_one(zeros, ones)
        log_w = ln_kt(zeros, ones)
        # levels from deep to shallow: (place of each child's parent, weight, estimate)
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for d in range(depth - 1, cut - 1, -1):
            key, up = np.unique(key & np.uint64((1 << 8 * (d + 1)) - 1), return_inverse=True)
            zeros, ones, below = (np.bincount(up, x, len(key)) for x in (zeros, ones, log_w))
            log_w, own = _weigh(zeros, ones, below)
            self.levels.append((up, own, kt_one(zeros, ones)))
        self.key, self.zeros, self.ones, self.log_w = key, zeros, ones, log_w

    def log10_probabilities(self, above: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """Log10 probability of each gram's bit after its context. ``above``
        and ``rest`` give, for each node at the cut, what the depths above it
        add to the probability of a one, and the weight they leave."""
        for up, own, estimate in reversed(self.levels):
            above = (above + rest * own * estimate)[up]
            rest = (rest * (1 - own))[up]
        one = (above + rest * self.leaf)[self.at]
        return np.log10(np.where(self.bits, one, 1 - one))


def _whole_subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grams (ascending) and counts of whole subtrees, about WEIGHED grams at a
    time; the batches come in the order of the subtree."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0

    def ordered(gram, n):
        order = np.argsort(gram)
        return gram[order].astype(np.uint64), n[order]

    for batch in batches:
        if not batch.num_rows:
            continue
        r, gram, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("r", "gram", "n"))
        held.append((r, gram, n))
        size += len(r)
        if size >= WEIGHED:
            r, gram, n = (np.concatenate(x) for x in zip(*held, strict=True))
            last = int(np.searchsorted(r, r[-1]))
            if last:
                yield ordered(gram[:last], n[:last])
            held, size = [(r[last:], gram[last:], n[last:])], len(r) - last
    if size:
        _, gram, n = (np.concatenate(x) for x in zip(*held, strict=True))
        yield ordered(gram, n)


def _flags(doc_id: Column) -> tuple[Column, Column]:
    """(held out, learned from); a null id is neither."""
    rest = F.crc32(doc_id.cast("string").cast("binary")) % 5
    return F.coalesce(rest == 1, F.lit(False)), F.coalesce(rest != 1, F.lit(False))


def _gathered(rows: DataFrame, depth: int) -> DataFrame:
    """Distinct grams and words of each group with their training counts (0:
    only in texts not learned from). The empty word stands for the ends."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: dict[tuple[int, bool], list[bytes]] = {}
        waiting: Counter = Counter()
        grams: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        words: dict[int, Counter] = {}

        def reduce_pieces(key) -> None:
            gram, n = np.unique(grams_of(pieces.pop(key), depth)[0], return_counts=True)
            waiting.pop(key)
            held = grams.setdefault(key[0], [])
            held.append((gram, n if key[1] else np.zeros(len(n), np.int64)))
            if len(held) > 8:
                grams[key[0]] = [merged(held)]

        def merged(held):
            gram, at = np.unique(np.concatenate([g for g, _ in held]), return_inverse=True)
            return gram, np.bincount(at, np.concatenate([n for _, n in held]), len(gram)).astype(np.int64)

        def out(g, gram, word, n):
            size = len(n)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(size, g, np.int32)),
                    pa.nulls(size, pa.int64()) if gram is None else pa.array(gram.astype(np.int64)),
                    pa.nulls(size, pa.binary()) if word is None else pa.array(word, pa.binary()),
                    pa.array(n, pa.int64()),
                ],
                names=["g", "gram", "word", "n"],
            )

        def flush_words(most):
            for g in sorted(words, key=lambda g: -len(words[g])):
                if sum(map(len, words.values())) <= most:
                    break
                seen = words.pop(g)
                yield out(g, None, list(seen), list(seen.values()))

        for batch in batches:
            for g, learn, text in zip(*(batch.column(c).to_pylist() for c in ("g", "learn")), batch.column("text"), strict=True):
                key, text = (g, learn), text.as_py()
                for piece in pieces_of(text, depth):
                    pieces.setdefault(key, []).append(piece)
                    waiting[key] += len(piece)
                    if waiting[key] >= 2 * WINDOW:
                        reduce_pieces(key)
                found = text.lower().split()
                found.append(b"")
                words.setdefault(g, Counter()).update(found if learn else dict.fromkeys(found, 0))
            if sum(map(len, words.values())) >= WORDS_HELD:
                yield from flush_words(WORDS_HELD // 2)
        for key in list(pieces):
            reduce_pieces(key)
        for g in list(grams):
            gram, n = merged(grams.pop(g))
            yield out(g, gram, None, n)
        yield from flush_words(0)

    return rows.select("g", "learn", "text").repartition("g").mapInArrow(gather, "g int, gram long, word binary, n long")


def _top_of_tree(parts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """For each node with one byte of context (at most 255 * 256, by their key):
    what depths 0 and 1 add to the probability of a one, and the weight left."""
    top = parts.groupBy("key").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("below").alias("below")).orderBy("key").toPandas()
    key = top["key"].to_numpy(np.int64)
    zeros, ones, below = (top[c].to_numpy(float) for c in ("zeros", "ones", "below"))
    log_w, own = _weigh(zeros, ones, below)
    root = key & 255
    zeros0, ones0, below0 = (np.bincount(root, x, 256) for x in (zeros, ones, log_w))
    _, own0 = _weigh(zeros0, ones0, below0)
    above0, rest0 = own0 * kt_one(zeros0, ones0), 1 - own0
    above, rest = np.zeros(1 << 16), np.zeros(1 << 16)
    above[key] = above0[root] + rest0[root] * own * kt_one(zeros, ones)
    rest[key] = rest0[root] * (1 - own)
    return above, rest


def gram_scores(totals: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``gram, log10_p`` for every row of ``totals`` (distinct ``gram``, training
    count ``n``, 0 allowed)."""
    by_subtree = (
        totals.withColumn("r", F.shiftright("gram", 8).bitwiseAND((1 << 8 * CUT) - 1))
        .repartition("r")
        .sortWithinPartitions("r")
        .select("r", "gram", "n")
    )

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for gram, n in _whole_subtrees(batches):
            for bit in range(8):
                t = Subtrees(gram, n, bit, depth, CUT)
                key, up = np.unique(t.key & np.uint64(0xFFFF), return_inverse=True)
                sums = [np.bincount(up, x, len(key)) for x in (t.zeros, t.ones, t.log_w)]
                yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int64)), *map(pa.array, sums)], names=["key", "zeros", "ones", "below"])

    shared = totals.sparkSession.sparkContext.broadcast(_top_of_tree(by_subtree.mapInArrow(weigh, "key long, zeros double, ones double, below double")))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above, rest = shared.value
        for gram, n in _whole_subtrees(batches):
            log10_p = np.zeros(len(gram))
            for bit in range(8):
                t = Subtrees(gram, n, bit, depth, CUT)
                up = (t.key & np.uint64(0xFFFF)).astype(np.int64)
                log10_p += t.log10_probabilities(above[up], rest[up])
            yield pa.RecordBatch.from_arrays([pa.array(gram.astype(np.int64)), pa.array(log10_p)], names=["gram", "log10_p"])

    return by_subtree.mapInArrow(score, "gram long, log10_p double")


class GramTable:
    """Open hash table from grams to values; all that is asked for is in it."""

    def __init__(self, gram: np.ndarray, value: np.ndarray):
        gram, first = np.unique(gram.astype(np.uint64), return_index=True)
        self.shift = np.uint64(64 - max(4, int(len(gram) * 4).bit_length()))
        size = 1 << int(64 - self.shift)
        self.last = size - 1
        self.key, self.value = np.full(size, np.uint64(2**64 - 1)), np.zeros(size)
        place, left = self._home(gram), np.arange(len(gram))
        while len(left):
            free = self.key[place] == np.uint64(2**64 - 1)
            self.key[place[free]] = gram[left[free]]  # of several, one wins
            won = self.key[place] == gram[left]
            self.value[place[won]] = value[first[left[won]]]
            place, left = (place[~won] + 1) & self.last, left[~won]

    def _home(self, gram: np.ndarray) -> np.ndarray:
        return (gram * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def __getitem__(self, gram: np.ndarray) -> np.ndarray:
        place = self._home(gram)
        missed = np.flatnonzero(self.key[place] != gram)
        while len(missed):
            place[missed] = (place[missed] + 1) & self.last
            missed = missed[self.key[place[missed]] != gram[missed]]
        return self.value[place]


def _scored(docs: pa.Table, table: pa.Table, depth: int, base_of) -> pa.Table:
    """The texts of one group, scored with the group's table."""
    is_gram = table.column("word").is_null()
    grams = table.filter(is_gram)
    known = table.filter(pa.compute.invert(is_gram))
    lookup = GramTable(grams.column("gram").to_numpy(), grams.column("value").to_numpy())
    count: Counter = Counter()
    for learn, text in zip(docs.column("learn").to_pylist(), docs.column("text"), strict=True):
        words = text.as_py().lower().split()
        words.append(b"")
        count.update(words if learn else dict.fromkeys(words, 0))
    for word, n in zip(known.column("word").to_pylist(), known.column("value").to_pylist(), strict=True):
        count[word] = n  # words of several groups: their count in all of them
    base = {c: base_of(c) for c in set(count.values())}
    score = np.zeros(docs.num_rows)
    n_tokens, n_known, base_score = [], [], []
    pieces: list[bytes] = []
    owner: list[int] = []
    waiting = 0

    def add() -> None:
        gram, starts = grams_of(pieces, depth)
        np.add.at(score, owner, np.add.reduceat(lookup[gram], starts))

    for k, text in enumerate(docs.column("text")):
        text = text.as_py()
        for piece in pieces_of(text, depth):
            pieces.append(piece)
            owner.append(k)
            waiting += len(piece)
            if waiting >= WINDOW:
                add()
                pieces, owner, waiting = [], [], 0
        words = text.lower().split()
        words.append(b"")
        counts = list(map(count.__getitem__, words))
        n_tokens.append(len(counts))
        n_known.append(sum(map(bool, counts)))
        base_score.append(math.fsum(map(base.__getitem__, counts)))
    if pieces:
        add()
    return pa.table(
        {
            "doc_id": docs.column("doc_id"),
            "held_out": docs.column("held_out"),
            "n_tokens": pa.array(n_tokens, pa.int64()),
            "n_known": pa.array(n_known, pa.int64()),
            "base_score": pa.array(base_score, pa.float64()),
            "score": pa.array(score),
            "n_bytes": docs.column("n_bytes"),
        }
    )


def scored_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Every row of ``df`` scored by a model of those it is learned from:
    ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    bits_per_byte``. ``score`` is the log10 probability of the whole text with its
    end, ``base_score`` that of a smoothed unigram model of its words,
    ``bits_per_byte`` the code length over the bytes and the end.

    - a null text is an empty one: one token (the end), one coded symbol;
    - a null id is scored, but neither held out nor learned from;
    - whole texts are read, very long ones in windows that overlap by a context;
    - repeated rows each count and each give a row;
    - an empty table gives an empty result, a table without a row to learn from
      even odds for every bit and 0 for every token;
    - other columns are not read, whatever their names.
    """
    if not CUT <= depth <= 6:
        raise ValueError(f"depth must be from {CUT} to 6, not {depth}")
    held, learn = _flags(F.col(id_col))
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = df.select(F.col(id_col).alias("doc_id"), held.alias("held_out"), learn.alias("learn"), text.alias("text"))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("long"))
    size = rows.agg(F.sum(F.col("n_bytes") + 1)).first()[0] or 0
    groups = max(1, -(-size // group_bytes))
    rows = rows.withColumn("g", F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("int"))

    gathered = written(_gathered(rows, depth), "ctw-groups")
    grams, words = gathered.where("gram is not null"), gathered.where("word is not null")
    totals = written(grams.groupBy("gram").agg(F.sum("n").alias("n")), "ctw-grams")
    model = written(gram_scores(totals, depth), "ctw-model")
    seen = Observation(f"ctw_{uuid.uuid4().hex}")
    counts = words.groupBy("word").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows"))
    counts = counts.observe(seen, F.sum("n").alias("tokens"), F.count_if(F.col("n") > 0).alias("distinct"))
    # A word that one group alone holds is counted there again when it is scored.
    counts = written(counts.where(F.col("rows") > 1).select("word", "n"), "ctw-words")
    tokens, distinct = (seen.get[c] or 0 for c in ("tokens", "distinct"))
    floor = tokens + 0.5 * (distinct + 1)

    table = (
        grams.select("g", "gram").join(model, "gram").select("g", "gram", F.lit(None).cast("binary").alias("word"), F.col("log10_p").alias("value"))
    ).unionByName(
        words.select("g", "word").join(counts, "word").select("g", F.lit(None).cast("long").alias("gram"), "word", F.col("n").cast("double").alias("value"))
    )

    def score(docs: pa.Table, lookups: pa.Table) -> pa.Table:
        return _scored(docs, lookups, depth, lambda c: math.log10((c + 0.5) / floor))

    id_type = df.schema[id_col].dataType.simpleString()
    scored = rows.groupBy("g").cogroup(table.groupBy("g")).applyInArrow(
        score, f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, base_score double, score double, n_bytes long"
    )
    bits = -F.col("score") * math.log2(10) / (F.col("n_bytes") + 1)
    result = written(
        scored.select(
            "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score", bits.alias("bits_per_byte")
        ),
        "ctw-scores",
    )
    forget(gathered, totals, model, counts)
    return result
