"""Merkle manifest against a plain climb over lists."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import empty, messy, rows
from tidepool.llm import merkle

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values) -> str:
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes: list[str], fanout: int) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][k:k + fanout])) for k in range(0, len(levels[-1]), fanout)])
    return levels


def plainly(docs: list[tuple], fanout: int) -> list[tuple]:
    """docs: doc_id, source, lang, n_chars, text."""
    by: dict = {}
    for r in docs:
        by.setdefault(r[2], []).append(r)
    for rs in by.values():
        rs.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {g: climb([leaf(r) for r in rs], fanout) for g, rs in by.items()}
    order = sorted(by, key=lambda g: (g is not None, (g or "").encode()))
    top = climb([trees[g][-1][0] for g in order], fanout) if order else []
    out = []
    for g, rs in by.items():
        for i, r in enumerate(rs):
            path = []
            for levels, j in ((trees[g], i), (top, order.index(g))):
                for level in levels[:-1]:
                    b = j - j % fanout
                    path.append(("".join(level[b:j]), "".join(level[j + 1:b + fanout])))
                    j //= fanout
            hit = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            h = leaf((*r[:4], r[4].translate(LOW))) if hit else leaf(r)
            for before, behind in path:
                h = digest(before + h + behind)
            out.append((r[0], leaf(r), trees[g][-1][0], top[-1][0], digest("".join(a + b for a, b in path)), h,
                        h == top[-1][0]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("fanout, stride", [(8, 3), (3, 2)])
def test_messy_rows(spark, fanout, stride):
    docs = [(r[0], r[3], r[2], r[4], r[1]) for r in rows()]
    got = merkle.verification(messy(spark), fanout, stride).collect()
    assert sorted(map(tuple, got), key=repr) == plainly(docs, fanout)


@pytest.mark.parametrize("most", [0, 200_000])
def test_many_groups_and_one_large_group(spark, monkeypatch, most):
    monkeypatch.setattr(merkle, "BROADCAST_GROUPS", most)
    docs = spark.range(700).select(
        F.col("id").alias("doc_id"), F.lit("s").alias("source"),
        F.when(F.col("id") % 3 > 0, "big").otherwise(F.concat(F.lit("g"), F.col("id").cast("string"))).alias("lang"),
        F.lit(1).cast("long").alias("n_chars"), F.concat(F.lit("Text "), (F.col("id") % 7).cast("string")).alias("text"))
    got = merkle.verification(docs, 4, 2).collect()
    assert sorted(map(tuple, got), key=repr) == plainly([(r[0], r[1], r[2], r[3], r[4]) for r in docs.collect()], 4)
    assert {r["verified"] for r in got} == {True, False}


def test_stored_bands_hold_every_third_level_only(spark):
    docs = messy(spark).select("doc_id", F.lit("one").alias("lang"), merkle.leaf_digest(F.col("text")).alias("leaf"))
    m = merkle.build(docs, "lang", "doc_id", fanout=2, stride=3)
    n = docs.count()
    assert [b.count() for b in m.rows.bands] == [n, -(-n // 8), -(-n // 64), 1][:len(m.rows.bands)]
    proofs = merkle.proofs(m)
    assert proofs.where(merkle.fold(F.col("leaf"), F.col("path")) != F.lit(m.root)).count() == 0
    assert proofs.select(F.size("path")).distinct().count() == 1


def test_one_row_and_empty(spark):
    one = messy(spark).where("doc_id = 4")
    r = one.first()
    values = (r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"])
    assert [tuple(x) for x in merkle.verification(one).collect()] == plainly([values], 8)
    nothing = merkle.verification(empty(spark))
    assert nothing.count() == 0
    assert nothing.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
