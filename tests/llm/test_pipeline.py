"""The pipeline's stages, one after the other, against plain versions."""

from __future__ import annotations

import random

import corpora
import corpus_pipeline
import pytest

from winnower.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(corpora.rows(), corpora.DOCUMENTS).select(*corpus_pipeline.DOCUMENT).write.parquet(f"{path}/documents.parquet")
    return path


def test_stages_follow_from_each_other(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = docs.collect()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        rows = docs.collect()
        if k < 4:
            assert tuple(docs.columns) == corpus_pipeline.DOCUMENT
        if name == "quality rules":
            assert all(corpora.rule_counts(r["text"])[0] >= 50 for r in rows)
            assert {r["doc_id"] for r in rows} >= set(range(8))
        if name == "exact dedup":
            plain = {"".join(corpora.WORD.findall(r["text"])) for r in before}
            assert len(rows) == len(plain) == len({"".join(corpora.WORD.findall(r["text"])) for r in rows})
        if name == "near dedup":
            known = [(r["doc_id"], r["text"]) for r in before if r["doc_id"] is not None]
            roots = corpora.near_components(known, 80)
            assert {r["doc_id"] for r in rows if r["doc_id"] is not None} == {i for i, root in roots.items() if i == root}
        if name == "repeated passages":
            gone = corpora.repeated_bytes([r["text"] for r in before])
            want = sorted((r["doc_id"] or -1, bytes(b for b, g in zip(r["text"].encode(), own, strict=True) if not g).decode(errors="ignore")) for r, own in zip(before, gone, strict=True))
            assert sorted((r["doc_id"] or -1, r["text"]) for r in rows) == want
            assert all(r["n_chars"] == len(r["text"]) for r in rows)
        if name == "packing":
            totals = {}
            for r in rows:
                totals[r["doc_id"]] = totals.get(r["doc_id"], 0) + r["length"]
            assert all(totals[r["doc_id"]] == r["doc_tokens"] for r in rows)
            assert totals.keys() == {r["doc_id"] for r in before}
        before = rows
    assert len(corpus_pipeline.run(spark, folder).collect()) == len(before)


def test_every_operator_is_registered_once():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


def test_pairs_between_80_and_85_percent_are_near(spark):
    rng = random.Random(6)
    rows = []
    for k in range(40):
        words = corpora.prose(rng, 120).split(" ")
        # Each changed word is in five shingles of 116.
        other = list(words)
        for at in rng.sample(range(10, 110, 12), 2):
            other[at] = f"changed{k}x{at}"
        sets = [corpora.shingle_set(" ".join(w)) for w in (words, other)]
        share = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
        assert 0.80 <= share < 0.85
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert {r["doc_id"] for r in corpus_pipeline.near_stage(spark, docs, "").collect()} == set(range(0, 80, 2))


def test_no_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
