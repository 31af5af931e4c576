"""The pipeline stage by stage."""

from __future__ import annotations

import hashlib

import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm.helpers import empty, messy
from tests.llm.test_simhash import brute_components, brute_print
from tidepool.llm import mix, quality
from tidepool.llm.common import pin


def stages(spark, docs):
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = pin(stage(spark, docs, SF_SMALL), "test-stage")
        out.append(docs)
    return out


def test_each_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    first, clean, exact, near, mixed, last = stages(spark, docs)
    for df in (clean, exact, near, mixed):
        assert df.columns == first.columns
    kept = {r["doc_id"] for r in quality.quality_rules(first).filter("kept").select("doc.doc_id").collect()}
    assert {r["doc_id"] for r in clean.collect()} == kept
    by_text = {}
    for r in clean.collect():
        by_text[r["text"]] = max(r["doc_id"], by_text.get(r["text"], -1))
    assert sorted(r["doc_id"] for r in exact.collect()) == sorted(by_text.values())
    data = exact.collect()
    want = set(brute_components([r["doc_id"] for r in data], [brute_print(r["text"]) for r in data]))
    assert sorted(r["doc_id"] for r in near.collect()) == sorted(want)
    times = {r["doc_id"]: r["copies"] for r in mix.mix(near).collect()}
    assert sorted(r["doc_id"] for r in mixed.collect()) == sorted(d for d, n in times.items() for _ in range(n))
    texts = {r["doc_id"]: r["text"] for r in mixed.collect()}
    rows = last.collect()
    assert len(rows) == mixed.count()
    assert all(r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest() for r in rows)


def test_run_gives_the_last_stage(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = stages(spark, docs)[-1].select("doc_id", "ids_sha256").collect()
    got = corpus_pipeline.run(spark, SF_SMALL).select("doc_id", "ids_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_messy_and_empty_tables(spark):
    assert stages(spark, messy(spark))[-1].count() > 0
    assert stages(spark, empty(spark))[-1].count() == 0
