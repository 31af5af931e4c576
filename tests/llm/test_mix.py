"""Targets by resharing step by step; sampled words near the targets; the query's SQL is checked with the others."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import pytest

from tests.llm.helpers import SCHEMA, empty, messy, rows, sentence
from tidepool.llm import mix


def brute_targets(size: dict) -> dict:
    order = sorted((s for s in size if s is not None)) + [None] * (None in size)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, capped = sum(size.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        rest, share = total - sum(capped.values()), sum(weight[s] for s in free)
        target = {s: rest * weight[s] / share for s in free}
        over = [s for s in free if target[s] > 3 * size[s]]
        if not over:
            return target | capped
        capped |= {s: 3.0 * size[s] for s in over}


def corpus(seed, counts):
    rng = random.Random(seed)
    out, k = [], 0
    for source, n in counts.items():
        for _ in range(n):
            text = sentence(rng, int(rng.paretovariate(1.1) * 5) % 3000)
            out.append((k, text, "en", source, len(text), *["x"] * 23))
            k += 1
    return out


@pytest.mark.parametrize("counts", [{"a": 400, "b": 50, "c": 60, "d": 20, None: 30}, {"a": 2, "b": 300}, {"z": 40}])
def test_targets_are_met(spark, counts):
    data = corpus(3, counts)
    got = mix.mix(spark.createDataFrame(data, SCHEMA)).collect()
    again = mix.mix(spark.createDataFrame(data, SCHEMA).repartition(5)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    size, source, taken, goal = defaultdict(int), {r[0]: r[3] for r in data}, defaultdict(int), {}
    for r in data:
        size[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1]))
    want = brute_targets(size)
    for r in got:
        s = source[r["doc_id"]]
        assert r["taken"] <= 3 * r["size"] and r["source_size"] == size[s]
        taken[s] += r["taken"]
        goal[s] = r["target"]
    for s in size:
        assert goal[s] == pytest.approx(want[s])
        assert abs(taken[s] - goal[s]) <= max(0.03 * goal[s], 30)


def test_messy_rows_and_equal_draws(spark):
    got = mix.mix(messy(spark)).collect()
    assert len(got) == len(rows())
    same = defaultdict(set)
    for r in got:
        same[r["doc_id"], r["size"], r["source_size"]].add(r["taken"])
    assert all(len(v) == 1 for v in same.values())


def test_mixed_rows_repeat_their_documents(spark):
    docs = spark.createDataFrame(corpus(8, {"a": 200, "b": 40, "c": 30}), SCHEMA)
    out = mix.mixed(docs)
    assert out.columns == docs.columns
    times = defaultdict(int)
    for r in out.select("doc_id").collect():
        times[r[0]] += 1
    assert {r["doc_id"]: r["copies"] for r in mix.mix(docs).collect() if r["copies"]} == dict(times)


def test_empty_and_wordless(spark):
    assert mix.mix(empty(spark)).count() == 0 and mix.mixed(empty(spark)).count() == 0
    data = [(k, None if k else " ", "en", "a", 0, *["x"] * 23) for k in range(3)]
    got = mix.mix(spark.createDataFrame(data, SCHEMA)).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in got] == [(0, 0.0, 0)] * 3
