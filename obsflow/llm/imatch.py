"""I-Match document fingerprints (operator 10), with DataFrame functions only.

The document frequency of every term is counted over all documents; the terms
within a band of inverse document frequency form the lexicon. A fingerprint is
a list of hashes, each over the sorted distinct terms that a document has in
one randomised subset of the lexicon. Subsets are drawn by a hash of the term
at rates of one half, one quarter, ..., and a document uses those whose rate
suits its number of terms inside the band, so that each subset picks about one or
two of them, whatever the document's length. The terms above the band, which are
few, are dropped first; of what is left, a sample by the same hash is looked up in the
lexicon, so that few rows of a document are joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .order import with_next

# Subsets drawn at one rate. A document uses two neighbouring rates.
SUBSETS = 16
# A document's higher rate leaves about 2^RATE_BITS to 2^(RATE_BITS + 1) terms of the
# band; 2^LOOKUP_BITS to 2^(LOOKUP_BITS + 1) of its distinct terms (or all, if there
# are fewer) are looked up.
RATE_BITS, LOOKUP_BITS = 3, 4
NO_WORD = r"[^\p{L}\p{N}]+"
# The band: in at least so many documents, and in at most this share of them.
MIN_DOCS = 2
MAX_SHARE = 0.1


def term_hashes(text: Column) -> Column:
    """64-bit hashes of the distinct lower-case words (letters and digits)."""
    words = F.array_remove(F.split(F.lower(text), NO_WORD), "")
    return F.transform(F.array_distinct(words), lambda w: F.xxhash64(w))


def _level(terms: Column, bits: int) -> Column:
    """The rate 2^-level that leaves 2^bits to 2^(bits + 1) of the terms; 0: all."""
    return F.greatest(F.lit(0), F.floor(F.log2(F.greatest(F.size(terms), F.lit(1)).cast("double"))).cast("int") - bits)


def _mask(level: Column) -> Column:
    return F.pow(F.lit(2.0), level).cast("long") - 1


def _sampled(hashes: Column) -> Column:
    """(level, terms drawn at rate 2^-level) to be looked up in the lexicon."""
    level = _level(hashes, LOOKUP_BITS)
    return F.struct(level.alias("level"), F.filter(hashes, lambda h: h.bitwiseAND(_mask(level)) == 0).alias("terms"))


def term_counts(texts: Column, df: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``term`` (hash) and ``docs`` of the terms in at least ``min_docs`` rows of
    ``df``. Counts are combined before the shuffle, so a term that is in every
    document weighs no more than another."""
    return df.select(F.explode(term_hashes(texts)).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("docs")).where(F.col("docs") >= min_docs)


def _in_band(rows: int, min_docs: int, max_share: float) -> Column:
    return F.col("docs") <= max(min_docs, int(max_share * rows))


def lexicon(texts: Column, df: DataFrame, rows: int, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """Terms (``term``: hash) of the band, counted over all rows of ``df``."""
    return term_counts(texts, df, min_docs).where(_in_band(rows, min_docs, max_share)).select("term")


def _slots(level: Column, terms: Column) -> Column:
    """Map from subset to the hash of its sorted distinct terms; subsets that
    pick nothing are left out."""

    def at(lv: Column, j: int) -> Column:
        return F.filter(terms, lambda t: (t.bitwiseAND(_mask(lv)) == 0) & (F.pmod(F.shiftright(t, 40), F.lit(SUBSETS)) == j))

    picks = [
        F.struct(F.concat_ws(".", lv.cast("string"), F.lit(str(j))).alias("subset"), at(lv, j).alias("picked"))
        for lv in (level, level + 1)
        for j in range(SUBSETS)
    ]
    kept = F.filter(F.array(*picks), lambda p: F.size(p["picked"]) > 0)
    return F.transform(kept, lambda p: F.concat_ws(":", p["subset"], F.lower(F.hex(F.xxhash64(F.concat_ws(",", F.transform(p["picked"], lambda t: t.cast("string"))))))))


def likeness(a: Column, b: Column) -> Column:
    """Share of the subsets used by either fingerprint on which both agree."""
    x, y = F.split(a, " "), F.split(b, " ")
    names = lambda s: F.transform(s, lambda p: F.substring_index(p, ":", 1))
    return F.size(F.array_intersect(x, y)) / F.size(F.array_union(names(x), names(y))).cast("double")


def fingerprints(sampled: DataFrame, terms: DataFrame, key: str, parts: dict[str, str]) -> DataFrame:
    """Fingerprint strings. ``sampled`` has ``key`` (one per row) and for each
    of ``parts`` (struct column -> new name) a struct of ``_sampled`` and
    ``hash``, the text's hash, which is the fingerprint of a text without any
    term of the band. A term that several sides of a row share is joined once."""
    sides = list(parts)
    of = [F.col(s)["terms"] for s in sides]
    every = F.array_distinct(F.concat(*of))
    tagged = F.transform(every, lambda t: F.struct(t.alias("term"), *[F.array_contains(x, t).alias(f"in{k}") for k, x in enumerate(of)]))
    long = sampled.select(key, F.explode(tagged).alias("e")).select(key, "e.*")
    found = (
        long.join(terms, "term")
        .groupBy(key)
        .agg(*[F.array_sort(F.collect_list(F.when(F.col(f"in{k}"), F.col("term")))).alias(f"_t{k}") for k in range(len(sides))])
    )
    out = sampled.join(found, key, "left")
    for k, s in enumerate(sides):
        # The rate follows the terms that are in the band.
        inside = F.coalesce(F.col(f"_t{k}"), F.array().cast("array<bigint>"))
        slots = _slots(F.col(s)["level"] + _level(inside, RATE_BITS), inside)
        out = out.withColumn(parts[s], F.when(F.size(slots) > 0, F.array_join(slots, " ")).otherwise(F.concat(F.lit("text:"), F.lower(F.hex(F.col(s)["hash"])))))
    return out.drop(*[f"_t{k}" for k in range(len(sides))])


def _side(text: Column, hashes: Column) -> Column:
    s = _sampled(hashes)
    return F.struct(s["level"].alias("level"), s["terms"].alias("terms"), F.xxhash64(text).alias("hash"))


def edited_fingerprints(df: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """Per row of ``df``: ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``.

    The edited text replaces the last floor(n_chars / 2) characters by the
    first as many of the next row's text, by descending id (rows of one id by
    their text's hash; after the last comes the first; null ids come last). A
    null text counts as empty. Texts without a term of the band have their own
    hash as fingerprint, so equal texts always agree. Whole texts are used. An
    empty table gives an empty result; other columns are not read.
    """
    base = df.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    rows = base.count()
    counts = written(term_counts(F.col("text"), base, min_docs), "imatch-lexicon")
    in_band = _in_band(rows, min_docs, max_share)
    terms = counts.where(in_band).select("term")
    # Terms above the band: fewer than the mean number of distinct terms of a
    # document over max_share, some thousands of hashes. They go before terms are drawn.
    frequent = F.lit([r["term"] for r in counts.where(~in_band).select("term").collect()]).cast("array<bigint>")
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.expr("substring(text, 1, char_length(text) - cast(floor(char_length(text) / 2) as int))"), F.substring("next_text", F.lit(1), half))
    pairs = with_next(base, "doc_id", "tie", {"text": "next_text", "doc_id": "next_id", "tie": "next_tie"}, rows)
    sampled = written(
        pairs.withColumn("edited", edited)
        .withColumn("own_terms", F.array_except(term_hashes(F.col("text")), frequent))
        .withColumn("other_terms", F.array_except(term_hashes(F.col("edited")), frequent))
        .select(
            "doc_id",
            "tie",
            "next_id",
            "next_tie",
            n.cast("long").alias("n_chars"),
            F.sha2("edited", 256).alias("edited_sha256"),
            _side(F.col("text"), F.col("own_terms")).alias("own"),
            _side(F.col("edited"), F.col("other_terms")).alias("other"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "imatch-rows",
    )
    marked = written(
        fingerprints(sampled, terms, "row", {"own": "fingerprint", "other": "edited_fingerprint"}).drop("own", "other", "row"), "imatch-marked"
    )
    # Rows that agree in id and text have the same fingerprint: one is enough.
    following = marked.groupBy(F.col("doc_id").alias("next_id"), F.col("tie").alias("next_tie")).agg(F.first("fingerprint").alias("next_fingerprint"))
    joined = marked.alias("m").join(
        following.alias("f"), F.expr("m.next_id <=> f.next_id and m.next_tie <=> f.next_tie"), "left"
    )
    return joined.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
