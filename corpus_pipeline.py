"""A training corpus from raw documents, in five stages.

Each stage takes the documents its predecessor kept and applies one operator of
``obsflow.llm`` to all of them. All but the last return the columns of
``documents`` (other columns are carried along untouched, whatever their names),
with ``n_chars`` brought up to date where a text changes.

Common cases: an empty table passes through every stage; rows with a null id
are kept by the near-duplicate stage as they are; a null text has no language
and goes in the first stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.llm import language_id as lid
from obsflow.llm import line_dedup, near_dedup, packing, sanitise
from obsflow.llm.common import WORD_BPE_FILE, tokenizer_path, written

# A language is accepted from this posterior on.
LEAST_SCORE = 0.5
# ... and if its mean log likelihood an n-gram is this far from that of n-grams
# never seen towards the language's own mean. Texts of labelled rows that consist
# mostly of numbers and keys reach 0.6, prose 0.8 and more, other scripts 0.3 to 0.4.
LEAST_USUAL = 0.58


def _boxed(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` and all other columns in one, so that no operator meets
    a column whose name it uses itself. The text is not held twice."""
    return docs.select("doc_id", "text", F.struct(*[c for c in docs.columns if c != "text"]).alias("row"))


def _unboxed(boxed: DataFrame, docs: DataFrame, **new: Column) -> DataFrame:
    """The rows again, with the columns of ``docs``; ``new`` replaces some."""
    new = {"text": F.col("text")} | new
    return boxed.select(*[(new[c] if c in new else F.col("row")[c]).alias(c) for c in docs.columns])


def _n_chars() -> Column:
    return F.char_length("text").cast("long")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised stay; texts without a letter
    (null and empty ones too), those the model is in doubt about, and those whose
    n-grams are nearer to never seen than to usual in the language found (another
    language, or no language) go. A null ``lang`` becomes the predicted one.
    Without any labelled document there is no model to reject by: then only texts
    without a letter go."""
    model = lid.fit(lid.labelled_rows(docs))
    marked = lid.predict(_boxed(docs), model, usual_col="usual")
    if model.langs:
        good = (F.col("lang_pred") != lid.UNDETERMINED) & (F.col("score") >= LEAST_SCORE) & (F.col("usual") >= LEAST_USUAL)
    else:
        good = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    kept = marked.where(good)
    filled = F.coalesce(F.col("row")["lang"], F.when(F.col("lang_pred") != lid.UNDETERMINED, F.col("lang_pred")))
    return _unboxed(kept, docs, lang=filled)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines repeated from earlier documents go; a document left without any
    word goes with them."""
    clean = line_dedup.dedup_lines(_boxed(docs))
    empty = (F.size("gone_lines") > 0) & ~F.col("text").rlike(r"\S")
    return _unboxed(clean.where(~F.coalesce(empty, F.lit(False))), docs, n_chars=_n_chars())


def _own_ids(boxed: DataFrame) -> DataFrame:
    """``boxed`` with an id of its own for each text: where rows of one id have
    unlike texts, each text gets a number beyond all ids (the id stays in
    ``row``). Null ids stay null."""
    text = F.coalesce("text", F.lit(""))
    keyed = boxed.withColumns({"h1": F.xxhash64(text), "h2": F.xxhash64(F.lit("second"), text)})
    pair = F.struct("h1", "h2")
    spread = keyed.where("doc_id is not null").groupBy("doc_id").agg(F.min(pair).alias("p"), F.max(pair).alias("q")).where("p <> q")
    repeated = written(spread.select("doc_id"), "pipeline-repeated")
    if repeated.isEmpty():
        return boxed
    texts = keyed.join(repeated, "doc_id").select("doc_id", "h1", "h2").distinct()
    low, high = boxed.agg(F.min("doc_id"), F.max("doc_id")).first()
    number = F.monotonically_increasing_id()
    number = F.lit(high + 1) + number if high < 1 << 62 else F.lit(low - 1) - number
    own = written(texts.withColumn("own", number), "pipeline-own-ids")  # written once: the numbers stay
    placed = keyed.join(own, ["doc_id", "h1", "h2"], "left")
    return placed.select(F.coalesce("own", "doc_id").alias("doc_id"), "text", "row")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the
    smallest id, in one row. Rows that share an id but not the text are documents
    of their own, after those whose id is their own. Rows with a null id stay."""
    boxed = _own_ids(_boxed(docs))
    found = near_dedup.near_duplicates(boxed.where("doc_id is not null"))
    kept = found.where("kept").select("doc_id").distinct()
    once = boxed.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return _unboxed(once.unionByName(boxed.where("doc_id is null")), docs, doc_id=F.col("row")["doc_id"])


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it are replaced."""
    return _unboxed(sanitise.sanitised(_boxed(docs)), docs, n_chars=_n_chars())


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All remaining documents, tokenized and packed; see ``packing``."""
    return packing.packed_documents(docs, tokenizer_path(WORD_BPE_FILE))


STAGES = [
    ("language_id", language),
    ("line_dedup", lines),
    ("near_dedup", near_copies),
    ("pii", personal_data),
    ("packing", pack),
]

# Naive Bayes, MinHash and tokenization have no SQL form; the tests hold the
# stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared
    folder and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
