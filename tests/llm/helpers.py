"""Messy documents: nulls in every column, empty and very long texts, ties, repeated rows, clashing extra columns."""

from __future__ import annotations

import random

from pyspark.sql import types as T

# Names that the operators use inside.
CLASHING = ["row", "bucket", "rank", "pos", "n", "fp", "size", "v", "bin", "id", "spans", "words", "doc", "ids",
            "__row", "__in", "__text", "key", "kept", "copies", "score", "digest", "payload"]

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())]
                      + [T.StructField(c, T.StringType()) for c in CLASHING])


def sentence(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdeghilmnorstu") for _ in range(rng.randint(2, 9))) for _ in range(n))


def texts(seed: int = 5) -> list[str | None]:
    rng = random.Random(seed)
    long = sentence(rng, 30_000)
    out: list[str | None] = [None, "", "", " \t\n", "one", "Two words", "three  word\ttext", "x" * 70_000, long,
                             long[:-1] + "!", "ünï cödé 日本語 \U0001F600 text", "Kelvin İstanbul", "a\x00b\x1fc\x85d e"]
    for k in range(40):
        base = sentence(rng, rng.randint(5, 400))
        out.append(base)
        if k % 3 == 0:
            out += [base] * (k % 5 + 1)
        if k % 4 == 0:
            words = base.split()
            words[len(words) // 2] = "changed"
            out.append(" ".join(words))
    out += ["line one is here\nline two is there\nline one is here\n\n" + sentence(rng, 60)] * 2
    return out


def rows(seed: int = 5) -> list[tuple]:
    rng = random.Random(seed + 1)
    out = []
    for k, t in enumerate(texts(seed)):
        out.append((None if k in (1, 17) else k, t, None if k % 7 == 0 else "en",
                    None if k % 11 == 0 else f"s{rng.choice('aaab0Éz')}", None if k % 5 == 0 else len(t or ""),
                    *["x"] * len(CLASHING)))
    return out + [out[20], out[20], out[1]]


def messy(spark, seed: int = 5):
    return spark.createDataFrame(rows(seed), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def values(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
