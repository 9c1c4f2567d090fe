"""The corpus pipeline, stage by stage, against brute force."""

import corpus_pipeline as cp
from conftest_helpers import by_id
from obsflow.llm.common import written
from test_llm_near import brute
from test_llm_texts import base_spans


def test_stages(spark, documents):
    docs, seen = documents, {}
    for name, stage in cp.STAGES:
        out = written(stage(spark, docs, ""), f"test-{name}")
        seen[name] = (docs.collect(), out.collect())
        if name != "packing":
            assert out.columns == docs.columns
        docs = out
    before, after = seen["language_id"]
    assert {r.doc_id for r in before} - {r.doc_id for r in after} == {1, 2, 4, 7}  # no letters
    before, after = seen["line_dedup"]
    assert {r.doc_id for r in after} <= {r.doc_id for r in before} and all(r.n_chars == len(r.text) for r in after)
    assert {x.text for x in before if x.doc_id == 8} == {x.text for x in after if x.doc_id == 8}
    before, after = seen["near_dedup"]
    groups = {c for _, c in brute(before).values()}
    assert sorted(r.doc_id for r in after if r.doc_id is not None) == sorted(groups)  # one row of each group
    assert sum(r.doc_id is None for r in after) == sum(r.doc_id is None for r in before)
    before, after = seen["pii"]
    assert len(before) == len(after) and not any(base_spans(r.text) for r in after)
    before, after = seen["packing"]
    assert {r.doc_id for r in after} == {r.doc_id for r in before}
    assert all(sum(r.length for r in rs) <= 2048 for rs in by_id(after, "sequence_id").values())


def test_run(spark, documents, tmp_dir, nothing):
    documents.write.parquet(f"{tmp_dir}/documents.parquet")
    assert cp.run(spark, tmp_dir).count() > 0
    nothing.write.parquet(f"{tmp_dir}/empty/documents.parquet")
    assert cp.run(spark, f"{tmp_dir}/empty").collect() == []


def test_rows_that_share_an_id_but_not_a_text_stay(spark, documents):
    rows = [
        (1, "an apple tree stands alone in the garden", "a"),
        (1, "quite another text that is like no other one", "b"),
        (1, "quite another text that is like no other one", "c"),
        (2, "an apple tree stands alone in the garden", "d"),
        (None, "nameless words in a row of their own", "e"),
        (None, "nameless words in a row of their own", "f"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = cp.near_copies(spark, docs, "").collect()
    assert sorted((str(r.doc_id), r.text[:5]) for r in out) == [("1", "quite"), ("2", "an ap"), ("None", "namel"), ("None", "namel")]
    huge = docs.withColumn("doc_id", docs.doc_id + (2**63 - 5))
    assert len(cp.near_copies(spark, huge, "").collect()) == 4


def test_languages_that_were_not_learned_go(spark, documents):
    odd = {
        5001: "Это пример русского текста, который никто не учил, и ещё немного слов о погоде",
        5002: "これは日本語の文章です。モデルは日本語を学んでいません。天気の話もあります。",
        5003: " ".join(["xkqz wrtpl bdfgh jklmn pqrst vwxz"] * 20),
    }
    more = spark.createDataFrame([(k, t, None, "s", len(t), "x", 1) for k, t in odd.items()], documents.schema)
    kept = {r.doc_id for r in cp.language(spark, documents.union(more), "").collect()}
    assert kept.isdisjoint(odd) and kept >= {r.doc_id for r in documents.collect()} - {1, 2, 4, 7, 8}
