"""Quality rules against a plain count."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest

from tests.llm.helpers import SCHEMA, empty, messy, rows, sentence
from tidepool.llm import quality

W = r"[^\x20\x09-\x0D]+"


def brute_counts(text):
    text = text or ""
    words = re.findall(W, text)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = Counter(grams)
    hit = {i + k for i, g in enumerate(grams) if times[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(W, x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))


def brute(data, min_docs, max_share, min_left):
    holders, documents = defaultdict(dict), defaultdict(set)
    norm = lambda x: " ".join(x.lower().split())
    for r in data:
        doc, text, host = r[0], r[1] or "", r[3]
        documents[host].add(text)
        for line in text.split("\n"):
            if norm(line):
                key = holders[host, norm(line)]
                key[text] = min([k for k in (key.get(text), doc) if k is not None], default=None)
    common = {k: v for k, v in holders.items()
              if len(v) >= min_docs and len(v) > max_share * len(documents[k[0]])}
    out = []
    for r in data:
        text = r[1] or ""
        counts = brute_counts(text)
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        kept_lines = []
        for line in text.split("\n"):
            held = common.get((r[3], norm(line)))
            first = held and min(held, key=lambda t: (held[t] is not None, held[t] or 0))
            if not held or first == text:
                kept_lines.append(line)
        left = len(re.findall(W, "\n".join(kept_lines)))
        out.append((r[0], *counts, failed, left, not failed and left >= min_left * counts[0]))
    return sorted(out, key=repr)


COLUMNS = ["doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_left", "kept"]


@pytest.mark.parametrize("min_docs, share, left", [(20, 0.05, 0.3), (2, 0.01, 0.9)])
def test_equals_a_plain_count(spark, min_docs, share, left):
    import random
    rng = random.Random(9)
    data = rows()
    shared = [sentence(rng, 12) for _ in range(4)]
    for k in range(60):                                   # pages of one host that share lines, some nothing else
        own = [sentence(rng, rng.choice([0, 70]))]
        text = "\n".join(rng.sample(shared, 3) + own)
        data.append((5000 + k, text, "en", "host", len(text), *data[0][5:]))
    docs = spark.createDataFrame(data, SCHEMA)
    got = quality.quality_rules(docs, min_docs=min_docs, max_share=share, min_left=left).select(*COLUMNS)
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == [repr(x) for x in brute(data, min_docs, share, left)]


def test_cleaning_keeps_columns_and_removes_lines(spark):
    import random
    rng = random.Random(4)
    data = []
    for k in range(40):
        text = "subscribe to our letter\n" + sentence(rng, 80)
        data.append((k, text, "en", "a", len(text), *["x"] * 23))
    docs = spark.createDataFrame(data, SCHEMA)
    out = quality.clean(docs).orderBy("doc_id").collect()
    assert [r["doc_id"] for r in out] == list(range(40)) and quality.clean(docs).columns == docs.columns
    assert out[0]["text"].startswith("subscribe") and all("subscribe" not in r["text"] for r in out[1:])
    assert all(r["n_chars"] == len(r["text"]) for r in out)


def test_a_line_is_common_however_large_its_host_is(spark):
    """A line in 20 of 800 documents is removed from 19 of them, as in a host of 20."""
    import random
    rng = random.Random(6)
    data = []
    for k in range(820):
        host = "large" if k < 800 else "small"
        text = ("Share this  page\n" if k % 40 == 0 or k >= 800 else "") + sentence(rng, 60)
        data.append((k, text, "en", host, len(text), *["x"] * 23))
    out = quality.clean(spark.createDataFrame(data, SCHEMA)).filter("text like '%Share this%'").collect()
    assert sorted(r["doc_id"] for r in out) == [0, 800]


def test_copies_do_not_make_their_own_lines_common(spark):
    import random
    rng = random.Random(4)
    text = "\n".join(sentence(rng, 20) for _ in range(6))
    data = [(k, text, "en", "a", 1, *["x"] * 23) for k in range(100)]
    assert quality.clean(spark.createDataFrame(data, SCHEMA)).count() == 100


def test_empty(spark):
    assert quality.quality_rules(empty(spark)).count() == 0
    assert quality.clean(empty(spark)).columns == messy(spark).columns
