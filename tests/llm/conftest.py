import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = {
    "en": "the and ing tion er on th of re ly".split(),
    "de": "der die und schen lich keit ung zu ein ß".split(),
    "fr": "le la eau que é oux ment dans est ç".split(),
}


def word(rng, lang="en"):
    return "".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4)))


def prose(rng, n, lang="en"):
    return " ".join(word(rng, lang) for _ in range(n))


def corpus(seed=3, n=120):
    """Documents with copies, near copies, shared lines and personal data."""
    rng = random.Random(seed)
    rows, shared = [], prose(rng, 60)
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        lines = [prose(rng, rng.randint(3, 40), lang) for _ in range(rng.randint(1, 6))]
        if i % 5 == 0:
            lines.insert(rng.randint(0, len(lines)), shared)
        if i % 7 == 0:
            lines.append(f"call +1 (386) 555-{i:04d} or mail user.{i % 3}@mail.example.com, host 10.0.{i}.7 card 4111 1111 1111 1111")
        text = "\n".join(lines)
        if rows and i % 6 == 0:
            _, text, lang, *_ = rng.choice(rows)  # an exact copy
        elif rows and i % 4 == 0:
            _, text, lang, *_ = rng.choice(rows)
            words = text.split(" ")
            words[rng.randrange(len(words))] = "changed"
            text = " ".join(words)
        rows.append((i * 3, text, lang, f"s{i % 4}", len(text)))
    return rows


EDGES = [
    (1, None, None, None, None),
    (2, "", "en", "s0", 0),
    (4, "   \n\t ", "en", "s0", 6),
    (5, "one", "en", None, 3),
    (7, "12 34 !", "en", "s1", 7),
    (8, "漢字 🙂 é İ <|endoftext|> x", None, "s1", None),
    (10, "the same row twice is here", "en", "s2", 26),
    (10, "the same row twice is here", "en", "s2", 26),
    (None, "a row without an identity", "en", "s2", 25),
    (11, "word " * 20_000, "en", "s3", 100_000),
]


@pytest.fixture(scope="session")
def documents(spark):
    """All cases, with extra columns whose names the operators use too."""
    rows = [(*r, "x", 1) for r in corpus() + EDGES]
    return spark.createDataFrame(rows, DOCS + ", gone string, n_tokens int").repartition(4).cache()


@pytest.fixture(scope="session")
def nothing(documents):
    return documents.where("false")
