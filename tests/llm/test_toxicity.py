"""The kernel against its definition; held-out accuracy on the labelled rows; gapped spellings."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import empty, messy, rows
from tidepool.llm import toxicity as tox


def features(word: str) -> dict:
    chars = "\u007f" + word + "\u007f"
    code = lambda c: 47 if c == "\u007f" else ord(tox._CODES[ord(c)])
    codes, out, norm = [code(c) for c in chars], {}, 0.0
    for i, j, k in combinations(range(len(codes)), 3):
        if k - i < tox.MAX_SPAN and min(codes[i], codes[j], codes[k]) > 0:
            w = tox.DECAY ** (k - i + 1)
            key = (codes[i], codes[j], codes[k])
            out[key] = out.get(key, 0.0) + w
            norm += w * w
    return {key: v / norm ** 0.5 for key, v in out.items()}


def test_kernel_is_the_shared_weighted_triples():
    words = ["idiot", "i.d.i.o.t", "idxiot", "the", "a", "ab", "éclair", "worthless", "x" * 40]
    got = tox.kernel(words, ["idiot", "worthless", "éclair"])
    for i, w in enumerate(words):
        for j, m in enumerate(["idiot", "worthless", "éclair"]):
            a, b = features(w), features(m)
            assert got[i, j] == pytest.approx(sum(v * b.get(k, 0.0) for k, v in a.items()), abs=1e-5)
    assert got[1, 0] > 0.5 > got[3, 0]                 # gaps keep the word close


def read(text, known=("you", "are", "an", "so", "the")):
    reader = tox.Reader(frozenset(known))
    words = tox.tokens(text)
    reader.learn([words])
    at, sentence, joined = reader.read(words)
    out = {}
    for k, w in [*zip(sentence.tolist(), (reader.words[i] for i in at)), *((k, w) for w, k in joined)]:
        out.setdefault(k, set()).add(w)
    return out


def test_segments_of_sentences():
    got = read('You are an i d i o t, moron### 12 ... "So are you!" The end')
    assert got[0] >= {"you", "are", "an", "idiot", "moron"} and list(got) == [0, 1, 2]
    assert got[1] == {"so", "are", "you"} and got[2] >= {"the", "end"}
    assert read("") == {} == read(" 12 %% ")
    for broken in ("you id iot", "you mo-\nron", "you i  d\ti  o\nt", "so w t f", "you wor thle ss"):
        whole = "".join(c for c in broken.split(maxsplit=1)[1] if c.isalpha())
        assert whole in read(broken)[0]
    assert "youare" not in read("you are")[0] and "idiot" not in read("id. iot")[0]
    assert max(map(len, read("x " * 100_000)[0])) == tox.RUN                      # a long run is many windows


def test_features():
    low = tox.FLOOR
    margins, sentence = np.array([0.1, 0.5, -9.0, 0.5, 0.2, 0.5, 9.0]), np.array([0, 0, 3, 4, 4, 4, 7])
    assert tox.features(margins[:6], sentence[:6]).tolist() == [0.5, 0.2, low, 0.5, low, low]    # of two, the better one
    assert tox.features(margins, sentence).tolist() == [0.5, 0.2, low, tox.CEILING, 0.5, low]
    assert tox.features(margins[:0], sentence[:0]).tolist() == [low] * 6 == tox.features(margins[2:3], sentence[2:3]).tolist()


def test_held_out_accuracy_and_gapped_insults(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = tox.train(docs, labels)
    scored = tox.score(docs, model).withColumn("held_out", tox.held_out(F.col("doc_id")))
    out = scored.join(labels.dropDuplicates(["doc_id"]), "doc_id").collect()
    held = [r for r in out if r["held_out"]]
    assert np.mean([(r["score"] >= 0.5) == (r["toxic"] == 1) for r in held]) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in out)
    scores = tox.scorer(model)
    plain = "the of and that is with for on by an in it as at be"
    bare, whole, *gapped = scores([plain, *(f"{plain} {x}" for x in (
        "idiot moron", "i.d.i.o.t m-o-r-o-n", "id*iot mo_ron", "id iot mo ron", "i  d  i  o  t, m o\nr o n",
        "idi-\not, mor-\non"))])
    assert all(g > bare for g in [whole, *gapped]), (bare, whole, gapped)
    assert all(g > whole / 2 for g in gapped[2:]), (whole, gapped)                # white space alone changes little


def test_labels_of_the_held_out_fold_are_not_read(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    flipped = labels.withColumn("toxic", F.when(tox.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = tox.toxicity(docs, labels).collect(), tox.toxicity(docs, flipped).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_messy_rows_and_missing_labels(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = tox.toxicity(messy(spark), none).collect()
    assert len(got) == len(rows()) and all(r["score"] == 0 and r["predicted"] == 0 for r in got)
    some = spark.createDataFrame([(k, 1, k % 2) for k in range(40)] + [(3, 1, None), (None, 1, 1), (5, 0, 0)],
                                 "doc_id bigint, quality int, toxic int")
    assert tox.toxicity(messy(spark), some).count() == len(rows())
    assert tox.toxicity(empty(spark), none).count() == 0
