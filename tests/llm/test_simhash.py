"""Fingerprints bit by bit, components by comparing all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from tests.llm.helpers import empty, messy, rows, sentence
from tidepool.llm import simhash
from tidepool.llm.components import connected_components


def brute_print(text: str | None, k: int = 4) -> int:
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, prints, radius=4):
    parent = list(range(len(ids)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                parent[root(i)] = root(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [least.get(root(i)) for i in range(len(ids))]


def test_fingerprints_and_runs_of_words(monkeypatch):
    for r in rows():
        assert simhash.fingerprint(r[1]) == brute_print(r[1])
    for chunk in (4, 5, 7):
        monkeypatch.setattr(simhash, "CHUNK_WORDS", chunk)
        for r in rows()[:30]:
            if len(r[1] or "") < 5000:
                assert simhash.fingerprint(r[1]) == brute_print(r[1])


@pytest.mark.parametrize("tile", [4096, 3])
def test_components(spark, tile):
    data = rows()
    got = simhash.near_duplicates(messy(spark), tile=tile).collect()
    prints = [brute_print(r[1]) for r in data]
    want = zip([r[0] for r in data], [f"{p:016x}" for p in prints], brute_components([r[0] for r in data], prints))
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, want))


@pytest.mark.parametrize("tile, block_tiles", [(16, 16), (2, 16), (1, 3)])
def test_links_reach_all_close_pairs(spark, tile, block_tiles):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    fps = {int(x) for x in base} | {0, (1 << 64) - 1}
    for x in base[:30]:
        y = int(x)
        for _ in range(6):                         # chains: each step flips up to four bits
            for b in rng.choice(64, rng.integers(1, 6), replace=False):
                y ^= 1 << int(b)
            fps.add(y)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(s,) for s in signed], "fp bigint")
    roots = {r["node"]: r["root"] for r in connected_components(simhash.links(df, 4, tile, block_tiles)).collect()}
    classes = {}
    for s, c in zip(signed, brute_components(list(range(len(fps))), fps)):
        classes.setdefault(c, set()).add(roots.get(s, s))
    assert all(len(c) == 1 for c in classes.values())
    assert len({next(iter(c)) for c in classes.values()}) == len(classes)


def test_forest_of_a_dense_tile():
    fps = np.array([1 << i for i in range(60)], dtype=np.uint64)          # any two differ in two bits
    found = simhash._forest(fps, fps, 4)
    assert len(found) == 59 and len({r for _, r in found}) == 1


def test_empty_and_dropping(spark):
    assert simhash.near_duplicates(empty(spark)).count() == 0
    docs = messy(spark).filter("doc_id is not null").dropDuplicates(["doc_id"])
    out = simhash.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    near = simhash.near_duplicates(docs).collect()
    assert {r["doc_id"] for r in out.collect()} == {r["component_id"] for r in near}
    assert out.count() == len({r["component_id"] for r in near})


def test_one_row_of_each_component_stays(spark):
    """Repeated and null ids: a row is kept for its own component, not for its id."""
    rng = random.Random(8)
    a, b, c, d = (sentence(rng, 200) for _ in range(4))
    data = [(1, a), (5, a), (1, b), (2, c), (5, c), (None, d), (None, d), (None, a), (3, a + " "), (2, c)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    got = [tuple(r) for r in simhash.drop_near_duplicates(docs).collect()]
    assert sorted(got, key=repr) == sorted([(1, a), (1, b), (2, c), (None, d)], key=repr)
