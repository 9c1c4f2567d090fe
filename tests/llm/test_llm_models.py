"""Hard negatives, context-tree weighting and spelling variants."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from obsflow.llm import context_tree, hard_negatives, spelling

# Hard negatives

VECTORS = "vec_id long, embedding array<float>, label int, rank string"


def vectors(seed=4, n=400, dim=13):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    rows = []
    for i in range(n):
        v = centres[rng.integers(6)] + rng.normal(scale=0.5, size=dim)
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(10)), "x"))
    for i in range(0, n, 9):  # ties: copies of one vector
        rows[i] = (i, rows[1][1], rows[i][2], "x")
    return rows


def brute_negatives(rows, every=50):
    q = {}
    for i, v, lab, _ in rows:
        if i is None or v is None or lab is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q[i] = ((lab + 1) % 10 if i % 7 == 0 else lab, [math.floor(256 * x) for x in v])
    out = set()
    for a, (lab, v) in q.items():
        if a % every:
            continue
        scores = [(-sum(x * y for x, y in zip(v, w)), i, other == lab) for i, (other, w) in q.items() if i != a and len(w) == len(v)]
        scores.sort()
        for s, p, _ in [x for x in scores if x[2]][:5]:
            near = [(n, i) for n, i, same in scores if not same and 50 * -s <= 100 * -n <= 95 * -s]
            out |= {(a, p, k + 1, i, -s, -n) for k, (n, i) in enumerate(near[:3])}
    return out


def found_negatives(df, **kw):
    got = hard_negatives.hard_negatives(df, label=hard_negatives.shifted_label(), **kw)
    return [(r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in got.collect()]


@pytest.mark.parametrize("dim", [1, 13, 64])
def test_hard_negatives_equal_all_pairs(spark, dim):
    rows = vectors(dim=dim)
    got = found_negatives(spark.createDataFrame(rows, VECTORS).repartition(5))
    assert len(got) == len(set(got)) and set(got) == brute_negatives(rows)


def test_hard_negatives_in_blocks_and_edges(spark, monkeypatch):
    rows = vectors(n=300) + [
        (1000, None, 1, "x"), (1050, [1.0, None] + [0.0] * 11, 2, "x"), (1100, [float("nan")] * 13, 2, "x"),
        (1150, [float("inf")] * 13, 2, "x"), (1200, [1.0] * 13, None, "x"), (None, [9.0] * 13, 2, "x"),
        (1250, [0.5, -0.25], 3, "x"), (1251, [0.5, 0.25], 3, "x"), (1252, [0.25, 0.0], 4, "x"), (1300, [], 3, "x"), (1301, [], 3, "x"),
        (1350, [1e-20, -1e-20] + [0.5] * 11, 3, "x"),
    ]
    df = spark.createDataFrame(rows + rows[:60], VECTORS).repartition(4)  # repeated rows count once
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(hard_negatives, "ANCHORS_AT_ONCE", 2)
    monkeypatch.setattr(hard_negatives, "ROWS_AT_ONCE", 50)
    got = found_negatives(df)
    assert len(got) == len(set(got)) and set(got) == brute_negatives(rows)
    assert found_negatives(df.where("false")) == []
    assert found_negatives(df.where("vec_id % 50 > 0")) == []


def test_huge_components_are_scored_exactly(spark):
    rows = [(0, [3e20, 1.0], 1, "x"), (1, [1.0, 1.0], 1, "x"), (2, [1.0, -2.0], 2, "x"), (3, [0.7, 2.0], 2, "x")]
    got = hard_negatives.exact_scores(np.array([[2.0**60, 3.0]]), np.array([[1.0, 1.0], [2.0**10, 0.0]]))
    assert got.tolist() == [[2**60 + 3, 2**63 - 1]]
    assert isinstance(found_negatives(spark.createDataFrame(rows, VECTORS)), list)


def test_summaries_bound_the_score():
    rng = np.random.default_rng(1)
    a, b = rng.integers(-99, 99, (20, 37)).astype(float), rng.integers(-99, 99, (30, 37)).astype(float)
    for segments in (1, 4, 16, 64):
        (ma, da), (mb, db) = hard_negatives.summaries(a, segments), hard_negatives.summaries(b, segments)
        assert (np.abs(a @ b.T - ma @ mb.T) <= da @ db.T + 1e-6).all()


# Context-tree weighting


def brute_tree(texts, depth):
    """Log probability of a text, straight from the definition."""
    counts = {}
    for t in texts:
        whole = [255] * depth + list(t.encode()) + [255]
        for i in range(depth, len(whole)):
            for k in range(8):
                node, bit = (1 << k) | whole[i] >> (8 - k), whole[i] >> (7 - k) & 1
                for d in range(depth + 1):
                    counts.setdefault((tuple(whole[i - d : i]), node), [0, 0])[bit] += 1
    longer = {}
    for context, node in counts:
        if context:
            longer.setdefault((context[1:], node), []).append((context, node))

    def ln_kt(c):
        return math.lgamma(c[0] + 0.5) + math.lgamma(c[1] + 0.5) - math.lgamma(c[0] + c[1] + 1) - math.log(math.pi)

    memo = {}

    def ln_w(key):
        if key not in counts:
            return 0.0
        if key not in memo:
            memo[key] = ln_kt(counts[key])
            if len(key[0]) < depth:
                memo[key] = np.logaddexp(memo[key], sum(map(ln_w, longer.get(key, [])))) - math.log(2)
        return memo[key]

    def one(context, node, d):
        c = counts.get((context[len(context) - d :], node), [0, 0])
        own = (c[1] + 0.5) / (sum(c) + 1)
        if d == depth:
            return own
        below = sum(map(ln_w, longer.get((context[len(context) - d :], node), [])))
        w = 1 / (1 + math.exp(min(700, below - ln_kt(c))))
        return w * own + (1 - w) * one(context, node, d + 1)

    def score(text):
        whole = [255] * depth + list(text.encode()) + [255]
        total = 0.0
        for i in range(depth, len(whole)):
            for k in range(8):
                p = one(tuple(whole[i - depth : i]), (1 << k) | whole[i] >> (8 - k), 0)
                total += math.log10(p if whole[i] >> (7 - k) & 1 else 1 - p)
        return total

    return score


def learned(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 != 1


def test_scores_equal_the_definition(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(k, " ".join(rng.choice(["the", "Tree", "of", "éa", "漢字", "und"]) for _ in range(rng.randint(0, 12)))) for k in range(40)]
    rows += [(41, None), (None, "the tree\x1cof"), (42, ""), (43, "a\x00b\nB  the"), (43, "a\x00b\nB  the")]
    monkeypatch.setattr(context_tree, "WINDOW", 16)
    monkeypatch.setattr(context_tree, "WEIGHED", 50)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, score int, g string").repartition(3)
    for depth in (2, 4):
        got = context_tree.scored_documents(df, depth=depth, group_bytes=300).collect()
        score = brute_tree([t or "" for i, t in rows if learned(i)], depth)
        tokens = Counter()
        for i, t in rows:
            if learned(i):
                tokens.update(re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + ["END"])
        n, v = sum(tokens.values()), len(tokens)
        want = Counter()
        for i, t in rows:
            words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + ["END"]
            base = sum(math.log10((tokens[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
            held = i is not None and zlib.crc32(str(i).encode()) % 5 == 1
            want[(i, held, len(words), sum(tokens[w] > 0 for w in words), n, round(base, 8), round(score(t or ""), 8))] += 1
        assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 8), round(r.score, 8)) for r in got) == want


def test_next_bytes_sum_to_one(spark):
    grams = [(int.from_bytes(c + bytes([b]), "big"), (b * 7) % 5 if c != b"none" else 0) for c in (b"abcd", b"xbcd", b"none") for b in range(256)]
    got = context_tree.gram_scores(spark.createDataFrame(grams, "gram long, n long"), 4).collect()
    for context in (b"abcd", b"xbcd", b"none"):
        p = [10**r.log10_p for r in got if r.gram >> 8 == int.from_bytes(context, "big")]
        assert len(p) == 256 and abs(sum(p) - 1) < 1e-9


def test_nothing_to_learn_from(spark, nothing, documents):
    assert context_tree.scored_documents(nothing).collect() == []
    held = documents.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1)
    for r in context_tree.scored_documents(held).collect():
        assert r.held_out and r.train_tokens == 0 and r.n_known == 0 and abs(r.base_score) < 1e-9
        assert abs(r.bits_per_byte - 8) < 1e-9


def test_learned_texts_are_likelier(documents):
    got = [r for r in context_tree.scored_documents(documents).collect() if r.n_tokens > 30]
    assert len(got) and all(r.bits_per_byte < 6 for r in got)


# Spelling


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_spelling(rows):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), n[w], len(near[w]), form[w] and n[form[w]]) for w in n}


def test_spelling_equals_all_pairs(spark):
    rng = random.Random(5)
    stems = ["".join(rng.choice("abenrstéØ") for _ in range(rng.randint(6, 9))) for _ in range(25)] + ["banana", "anananan", "aaaaaa", "aaaaaaa"]
    words = []
    for w in stems:
        words += [w] * rng.randint(5, 300)
        for _ in range(12):
            k, x = rng.randrange(len(w) + 1), rng.choice("abenrsté")
            v = rng.choice([w[:k] + x + w[k:], w[:k] + w[k + 1 :], w[:k] + x + w[k + 1 :]])
            words += [v] * rng.choice([4, 5, 6, 25, 40])
    rng.shuffle(words)
    rows, at = [], 0
    while at < len(words):
        size = rng.randint(1, 60)
        rows.append((len(rows), " ".join(w.capitalize() if rng.random() < 0.1 else w for w in words[at : at + size])))
        at += size
    rows += [(None, "nameless " * 7), (None, None), (9_000, ""), (9_001, "×÷×÷×÷ " * 5 + "1a2b short")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n int").repartition(4)
    got = spelling.spelling_groups(df).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute_spelling(rows), key=str)
    assert any(r.root != (r.form or r.word) for r in got)  # a chain of forms
    assert spelling.spelling_groups(df.where("false")).collect() == []


def test_damaged_runs_lose_a_letter():
    runs = [(str(i), "wörterbuch") for i in range(2000)]
    got = [spelling.damaged(i, w) for i, w in runs]
    for (i, w), g in zip(runs, got, strict=True):
        h = zlib.crc32(f"{i}:{w}".encode())
        assert g == (w[: h % 10] + w[h % 10 + 1 :] if h % 199 == 0 else w)
    assert any(len(g) == 9 for g in got)


def test_pivots_are_disjoint_and_rarest():
    rng = random.Random(8)
    for _ in range(300):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(6, 12)))
        grams = sorted({word[k : k + 2] for k in range(len(word) - 1)})
        rng.shuffle(grams)
        rank, held = {g: k for k, g in enumerate(grams)}, sorted(rng.randint(1, 99) for _ in grams)
        prefix = spelling.prefix_of(word, rank)
        a, b = spelling.pivots_of(prefix, held)
        cost = {k: held[r] for r, k in prefix}
        assert b - a >= 2
        assert cost[a] + cost[b] == min(cost[x] + cost[y] for x in cost for y in cost if y - x >= 2)
