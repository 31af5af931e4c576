"""Exact dedup against grouping by the text itself."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest

from tests.llm.helpers import empty, messy, rows, values
from tidepool.llm import exact_dedup


def brute(data):
    groups = defaultdict(list)
    for r in data:
        groups[r[1] or ""].append(r[0])
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        left = 1
        for i in ids:
            kept = i == keep and left > 0
            left -= kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block, bits", [(4096, 64), (7, 64), (5, 3), (64, 0 + 1)])
def test_equals_grouping_by_text(spark, block, bits):
    # Few bucket bits put different blocks into one bucket, so that names come from the sorted lists.
    data = [r for r in rows() if bits == 64 or len(r[1] or "") < 2500]
    if block < 64:
        data = [r for r in data if len(r[1] or "") < 5000]
    docs = spark.createDataFrame(data, messy(spark).schema)
    got = exact_dedup.exact_dedup(docs, block, bits).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert values(got) == brute(data)


def test_empty_table(spark):
    assert exact_dedup.exact_dedup(empty(spark)).count() == 0
    assert exact_dedup.drop_exact_copies(empty(spark)).count() == 0


def test_dropping_keeps_columns_and_one_row_per_text(spark):
    docs = messy(spark)
    out = exact_dedup.drop_exact_copies(docs)
    assert out.columns == docs.columns
    kept = [r["text"] or "" for r in out.collect()]
    assert sorted(kept) == sorted({r[1] or "" for r in rows()})
