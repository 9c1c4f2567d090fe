"""Information-theoretic sanitisation (operator 8), with DataFrame functions only.

Protected entities are the e-mail addresses, IP addresses, card and phone
numbers found by pattern. Corpus co-occurrence then estimates how strongly a
term reveals an entity: for a term that stands within a few words of an entity
in enough documents, the probability of the entity given the term, and the
pointwise mutual information of the two, over all documents. Terms above the
disclosure thresholds are spans too, wherever they occur: they are generalised,
or removed when they all but name the entity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import forget, written
from .imatch import NO_WORD, term_hashes

KINDS = ("email", "ip", "card", "phone")
# The contract's patterns with possessive repeats and, where a failed start
# cannot succeed later in the same run, one start per run: the same matches,
# without backtracking or recursion on long texts.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Texts without this cannot match.
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
# Words on each side of an entity that count as its context.
CONTEXT = 5
# A term must stand by the entity in so many documents.
MIN_DOCS = 5
# What can be a disclosing word: with a letter, and of three characters, or two where
# a character is a syllable or a word.
NAME = r"(?=.*\p{L})(.{3,}|.*[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}].+|.+[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}])"
# Probability of the entity given the term from which the term is generalised,
# and from which it is removed.
GENERALISE, REMOVE = 0.5, 0.9
# Bits of pointwise mutual information that a disclosing term carries at least; for
# an entity so frequent that nothing can carry that many, this share of the most
# that a term can (all of it: the entity stands beside the term every time).
MIN_PMI, MIN_INFORMATION = 3.0, 0.8
# ... but never fewer bits than this: an entity in nearly every document tells
# nothing.
LEAST_PMI = 0.25
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]", "drop": ""}


def _matches(text: Column, pattern: Column, context: int = 0) -> Column:
    """Matches in order: ``hit``, the ``gap`` of text before it since the
    match before, and the words around it up to the neighbouring matches."""
    hits = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.split(text, pattern, -1)

    def last(piece: Column) -> Column:
        words = F.split(F.rtrim(piece), r"\s+")
        return F.slice(words, F.greatest(F.lit(1), F.size(words) - context + 1), F.lit(context))

    def one(hit: Column, k: Column) -> Column:
        gap = F.get(gaps, k)
        around = F.concat(last(gap), F.slice(F.split(F.ltrim(F.get(gaps, k + 1)), r"\s+", context + 1), 1, context)) if context else F.array().cast("array<string>")
        return F.struct(hit.alias("hit"), F.char_length(gap).alias("gap"), around.alias("around"))

    return F.transform(hits, one)


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, r"[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check sum of a string of digits is a multiple of 10."""
    numbers = F.transform(F.split(F.reverse(digits), ""), lambda d: d.cast("int"))
    doubled = F.transform(numbers, lambda d, k: F.when(k % 2 == 1, 2 * d - F.when(d > 4, 9).otherwise(0)).otherwise(d))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def _valid(kind: Column, hit: Column) -> Column:
    digits = _digits(hit)
    n = F.length(digits)
    parts = F.transform(F.split(hit, r"\."), lambda p: F.ltrim(p, F.lit("0")))
    small = F.forall(parts, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255))
    return (
        F.when(kind == "ip", small)
        .when(kind == "card", F.when(n.between(14, 19), _luhn(digits)).otherwise(False))
        .when(kind == "phone", n.between(10, 15))
        .otherwise(True)
    )


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows with a 128-bit key of id and text; rows that share it are equal."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    # The caller's columns travel in one, so that no name of theirs is met.
    return df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
        text.alias("_text"),
        F.xxhash64(F.col(id_col), text).alias("_k1"),
        F.xxhash64(text, F.lit("second"), F.col(id_col)).alias("_k2"),
    )


KEY = ["_k1", "_k2"]


def _placed(matches: DataFrame) -> DataFrame:
    """Start and end of exploded matches (``_k1, _k2, kind, pos, m``): running
    sums over the matches of one document and kind."""
    before = Window.partitionBy(*KEY, "kind").orderBy("pos")
    length = F.char_length("m.hit")
    end = F.sum(F.col("m.gap") + length).over(before)
    return matches.select(*KEY, "kind", "pos", F.col("m.hit").alias("hit"), F.col("m.around").alias("around"), end.alias("end")).withColumn(
        "start", F.col("end") - F.char_length("hit")
    )


def base_spans(keyed: DataFrame) -> DataFrame:
    """Valid spans of all documents: ``_k1, _k2, kind, start, end, hit, around``."""
    found = []
    for kind in KINDS:
        worth = F.col("_text").contains(NEEDS[kind]) if NEEDS[kind] else F.col("_text").rlike("[0-9]")
        found.append(F.struct(F.lit(kind).alias("kind"), F.when(worth, _matches(F.col("_text"), F.lit(PATTERNS[kind]), CONTEXT)).alias("ms")))
    kinds = F.filter(F.array(*found), lambda x: F.size(x["ms"]) > 0)
    rows = (
        keyed.select(*KEY, F.explode(kinds).alias("x"))
        .select(*KEY, "x.kind", F.posexplode("x.ms").alias("pos", "m"))
        .dropDuplicates([*KEY, "kind", "pos"])
    )
    return _placed(rows).where(_valid(F.col("kind"), F.col("hit"))).select(*KEY, "kind", "start", "end", "hit", "around")


def disclosing_terms(keyed: DataFrame, spans: DataFrame, rows: int, min_docs: int = MIN_DOCS) -> DataFrame:
    """Terms that reveal an entity: ``term`` (hash), ``word``, ``share`` (the
    highest probability of an entity given the term)."""
    entity = F.xxhash64("kind", F.when(F.col("kind").isin("card", "phone"), _digits(F.col("hit"))).otherwise(F.lower("hit")))
    # Words as term_hashes takes them: a hyphenated or apostrophed name by its parts.
    # Addresses in the context are entities themselves.
    words = F.flatten(F.transform(F.filter("around", lambda w: ~w.contains("@")), lambda w: F.split(F.lower(w), NO_WORD)))
    near = spans.select(*KEY, entity.alias("entity"), F.explode_outer(words).alias("word"))
    entities = near.groupBy("entity", *KEY).agg(F.lit(1).alias("one")).groupBy("entity").agg(F.count(F.lit(1)).alias("entity_docs"))
    pairs = (
        near.where(F.col("word").rlike(NAME))
        .groupBy("entity", "word", *KEY)
        .agg(F.lit(1).alias("one"))
        .groupBy("entity", "word")
        .agg(F.count(F.lit(1)).alias("both"))
        .where(F.col("both") >= min_docs)
        .withColumn("term", F.xxhash64("word"))
    )
    pairs = written(pairs, "sanitise-pairs")
    # Document frequencies over the whole corpus, combined before the shuffle.
    counts = keyed.select(F.explode(term_hashes(F.col("_text"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("term_docs"))
    both = F.col("both").cast("double")
    return (
        pairs.join(counts, "term")
        .join(entities, "entity")
        .withColumn("share", F.least(F.lit(1.0), both / F.col("term_docs")))
        .withColumn("pmi", F.log2(F.lit(float(rows)) * both / (F.col("term_docs") * F.col("entity_docs"))))
        .withColumn("most", F.log2(F.lit(float(rows)) / F.col("entity_docs")))
        .where((F.col("share") >= GENERALISE) & (F.col("pmi") >= F.greatest(F.lit(LEAST_PMI), F.least(F.lit(MIN_PMI), MIN_INFORMATION * F.col("most")))))
        .groupBy("term", "word")
        .agg(F.max("share").alias("share"))
    )


def term_spans(keyed: DataFrame, terms: DataFrame) -> DataFrame:
    """Every occurrence of the ``terms``: ``_k1, _k2, kind, start, end``, kind
    ``term`` (generalised) or ``drop`` (removed)."""
    holders = (
        keyed.select(*KEY, F.explode(term_hashes(F.col("_text"))).alias("term"))
        .join(terms, "term")
        .groupBy(*KEY)
        .agg(F.collect_set("word").alias("words"), F.collect_set(F.when(F.col("share") >= REMOVE, F.col("word"))).alias("drops"))
    )
    pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), F.array_join(F.array_sort("words"), "|"), F.lit(r")(?![\p{L}\p{N}])"))
    rows = (
        keyed.select(*KEY, "_text")
        .join(written(holders, "sanitise-holders"), KEY)
        .select(*KEY, "drops", F.lit("term").alias("kind"), F.posexplode(_matches(F.col("_text"), pattern)).alias("pos", "m"))
        .dropDuplicates([*KEY, "kind", "pos"])
    )
    placed = _placed(rows.drop("drops")).join(rows.select(*KEY, "drops").dropDuplicates(KEY), KEY)
    return placed.select(*KEY, F.when(F.array_contains("drops", F.lower("hit")), F.lit("drop")).otherwise(F.lit("term")).alias("kind"), "start", "end")


def all_spans(keyed: DataFrame, rows: int, min_docs: int = MIN_DOCS) -> DataFrame:
    """Base spans, and term spans that do not touch one: ``_k1, _k2, kind,
    start, end``."""
    base = written(base_spans(keyed), "sanitise-base")
    terms = term_spans(keyed, written(disclosing_terms(keyed, base, rows, min_docs), "sanitise-terms"))
    both = base.select(*KEY, "kind", "start", "end").unionByName(terms)
    is_base = F.col("kind").isin(*KINDS)
    order = Window.partitionBy(*KEY).orderBy("start", "end", "kind")
    before = F.max(F.when(is_base, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    after = F.min(F.when(is_base, F.col("start"))).over(order.rowsBetween(0, Window.unboundedFollowing))
    marked = both.select("*", before.alias("_before"), after.alias("_after"))
    free = (F.coalesce("_before", F.lit(0)) <= F.col("start")) & (F.coalesce("_after", F.col("end")) >= F.col("end"))
    return marked.where(is_base | free).drop("_before", "_after")


def _number(kind: Column) -> Column:
    order = (*KINDS, "term", "drop")
    return F.array_position(F.array(*map(F.lit, order)), kind)


def personal_data(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per input row: ``doc_id, n_email, n_ip, n_card, n_phone,
    base_sha256, spans``; spans as ``kind:start:end`` in code points, by start
    and then kind.

    Whole texts are searched; a null or empty text has no spans; repeated rows
    each give a row; a null id stays null; an empty table gives an empty
    result; other columns are not read.
    """
    keyed = _keyed(df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "doc_id", "text")
    keyed = keyed.select(F.col("row")["doc_id"].alias("doc_id"), "_text", *KEY)
    rows = written(keyed.select("doc_id", *KEY), "sanitise-rows")
    spans = all_spans(keyed, rows.count(), min_docs)
    listed = spans.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("start", _number(F.col("kind")).alias("n"), "end", "kind"))).alias("s"))

    def joined(s: Column) -> Column:
        return F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def of(kind: str) -> Column:
        return F.size(F.filter("s", lambda x: x["kind"] == kind)).cast("long")

    out = rows.join(listed, KEY, "left").withColumn("s", F.coalesce("s", F.array().cast(listed.schema["s"].dataType)))
    base = F.filter("s", lambda x: x["n"] <= len(KINDS))
    return out.select(
        "doc_id", *[of(k).alias(f"n_{k}") for k in KINDS], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("s")).alias("spans")
    )


def sanitised(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """``df`` with every span of the text replaced by its label (a removed term
    by nothing). Touching and overlapping spans are replaced as one, with the
    first one's label. A null text stays null. All other columns stay."""
    keyed = _keyed(df, id_col, text_col)
    spans = all_spans(keyed.select("_text", *KEY), df.count(), min_docs)
    order = Window.partitionBy(*KEY).orderBy("start", "end", _number(F.col("kind")))
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.coalesce(reach, F.lit(-1)) > F.col("start"), 0).otherwise(1)
    merged = (
        spans.withColumn("opens", opens)
        .withColumn("island", F.sum("opens").over(order))
        .groupBy(*KEY, "island")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min(F.struct("start", "end", _number(F.col("kind")), "kind"))["kind"].alias("kind"))
    )
    label = F.element_at(F.create_map(*[F.lit(x) for kv in LABELS.items() for x in kv]), F.col("kind"))
    cuts = written(
        merged.withColumn("label", label).groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("start", "end", "label"))).alias("_cuts")), "sanitise-cuts"
    )
    text = F.col("row").getField(text_col)

    def kept(cut: Column, k: Column) -> Column:
        start = F.when(k > 0, F.get("_cuts", k - 1)["end"]).otherwise(F.lit(0))
        return F.concat(F.substring(text, (start + 1).cast("int"), (cut["start"] - start).cast("int")), cut["label"])

    rest = F.substring(text, (F.element_at("_cuts", -1)["end"] + 1).cast("int"), F.char_length(text))
    clean = F.when(F.col("_cuts").isNull() | text.isNull(), text).otherwise(F.concat(F.array_join(F.transform("_cuts", kept), ""), rest))
    joined = keyed.select("row", *KEY).join(cuts, KEY, "left")
    return joined.select(*[(clean if c == text_col else F.col("row").getField(c)).alias(c) for c in df.columns])
