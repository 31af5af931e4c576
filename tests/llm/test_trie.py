"""Prefix trie of rebuilt conversations against dictionaries of prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import types as T

from tests.llm.helpers import CLASHING, values
from tidepool.llm import trie

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                       T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]
                      + [T.StructField(c, T.StringType()) for c in [*CLASHING, "idx", "token", "part", "depth", "span"]])


def frame(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * (len(SCHEMA) - 4)) for r in rows], SCHEMA)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def plainly(rows: list[tuple]) -> list[tuple]:
    convs: dict = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn, role or "", text or ""))
    for own in convs.values():
        own.sort(key=lambda t: (t[0] is not None, t[0] or 0, sha(f"{len(t[1].encode())}:{t[1]}{t[2]}")))
    members: dict = {}
    ends: dict = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        seq = tuple(t[1:] for t in convs.get(c - c % 5, [])[:h] + own[h:])
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
        ends.setdefault(seq, []).append(c)
    children: dict = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = children.get(p, [])
        leaves[p] = sum(leaves[x] for x in below) if below else 1
        saved[p] = (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0) + sum(saved[x] for x in below)
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, [])), leaves[p], saved[p],
                    sha(",".join(map(str, sorted(ends.get(p, [])))))) for p, m in members.items()), key=repr)


def messy_rows(seed: int = 7, n: int = 240) -> list[tuple]:
    rng = random.Random(seed)
    said = [None, "", "ja", "Grüße 日本", "x" * 5000, *(f"line {k}" for k in range(6))]
    roles = ["user", "assistant", None, ""]
    rows = []
    for c in range(n):
        if c % 13 == 5:
            continue
        turns = [(c, t, roles[t % 2], said[rng.randrange(3)] if t < 4 else rng.choice(said)) for t in range(rng.choice([1, 2, 3, 5, 8, 12]))]
        if c % 3 == 0:  # copies
            turns = [(c, t, roles[t % 2], f"line {t % 3}") for t in range(10)]
        if c % 17 == 0:
            turns.append((c, None, roles[2], "before all"))
        if c % 19 == 0:
            turns += [turns[0], (c, 1, "user", "tie"), (c, 1, "user", "tie 2")]
        rows += turns
    rows += [(None, 0, "user", "nobody"), (None, None, None, None), (10_000, None, None, None)]
    rows += [(10_005 + k, t, "user", f"long {t}") for k in range(3) for t in range(700)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("parts", [1, 40])
def test_messy_conversations(spark, monkeypatch, parts):
    monkeypatch.setattr(trie, "PACK", 16)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert values(trie.prefix_trie(frame(spark, messy_rows()))) == plainly(messy_rows())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_shuffled_join_of_spanning_parents(spark, monkeypatch):
    monkeypatch.setattr(trie, "BROADCAST_ROWS", 0)
    rows = messy_rows(8, 60)
    assert values(trie.prefix_trie(frame(spark, rows))) == plainly(rows)


def test_empty(spark):
    none = trie.prefix_trie(frame(spark, []))
    assert none.count() == 0 and none.columns[0] == "conv_id"
    assert trie.prefix_trie(frame(spark, [(None, 1, "user", "x")])).count() == 0


def test_sparse_table():
    rng = np.random.default_rng(3)
    values_ = rng.integers(0, 6, 200)
    table = trie.Minima(values_)
    for _ in range(300):
        a, b = sorted(rng.integers(0, 200, 2).tolist())
        assert table.least(np.array([a]), np.array([b]))[0] == values_[a:b + 1].min()
        d = int(rng.integers(0, 7))
        r, left = a, a
        while r + 1 < 200 and values_[r + 1] >= d:
            r += 1
        while left > 0 and values_[left] >= d:
            left -= 1
        at = np.array([a]), np.array([d])
        assert table.reach(*at, right=True)[0] == r and table.reach(*at, right=False)[0] == left
