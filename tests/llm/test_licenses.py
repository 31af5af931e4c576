"""License scans against blocks from every single word, tested without any filter."""

from __future__ import annotations

import math
import re

from tests.llm.helpers import SCHEMA, empty, rows
from tidepool.llm import licenses

W = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def brute(text, threshold=licenses.THRESHOLD):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(W, low)
    places = [(i, label) for phrase, label in licenses.PHRASES for i in range(len(words))
              if words[i:i + len(phrase.split())] == phrase.split()]
    base = sorted({label for _, label in places})
    labels, best = set(base), 1.0 if places else 0.0
    for label, template in licenses.TEMPLATES:
        said = re.findall(W, template.lower())
        t, n = set(said), len(said)
        for s in range(len(words)):
            shared = len(t & set(words[s:s + 2 * n]))
            if shared >= (len(t) if len(t) < 10 else math.ceil(round(threshold * len(t), 9))):
                labels.add(label)
                best = max(best, shared / len(t))
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(base),
            ",".join(sorted(labels)), best)


def cases():
    filler = " ".join(f"w{k}" for k in range(400))
    whole = [t for _, t in licenses.TEMPLATES]
    yield from whole
    yield from (f"{filler}\n{t}\n{filler}" for t in whole)
    yield from (" ".join(w for k, w in enumerate(t.split()) if k != 2) for t in whole)        # a word is missing
    yield from (t.replace(" ", " and ", 1).upper() for t in whole)
    yield from ["MIT License", "the mit\nLICENSE, apache license; mit license", "general public license " * 3,
                "general publiK license", "License mit", "apacheElicense", "", None]


def test_equals_every_window(spark):
    data = rows() + [(8000 + k, t, "en", "s", 1, *["x"] * 23) for k, t in enumerate(cases())]
    got = licenses.license_scan(spark.createDataFrame(data, SCHEMA)).collect()
    want = [(r[0], *brute(r[1])) for r in data]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_wordy_notices_are_found_wherever_they_stand(spark):
    wordy = "licensed under the creative commons attribution noncommercial cc by nc 4 0"       # 7 words spread over 13
    data = [(k, " ".join(f"w{i}" for i in range(k)) + f" {wordy} and more", "en", "s", 1, *["x"] * 23)
            for k in [*range(16), *range(490, 530), 1023, 1024, 5000]]
    got = licenses.license_scan(spark.createDataFrame(data, SCHEMA)).collect()
    assert {(r["labels"], r["score"]) for r in got} == {("cc-by-nc", 1.0)} and len(got) == len(data)
    starts = [" ".join(["license", "software"] * k + ["w"] * 500 + t.split()) for k in (1, 300)
              for _, t in licenses.TEMPLATES]
    data = [(k, t, "en", "s", 1, *["x"] * 23) for k, t in enumerate(starts)]
    got = licenses.license_scan(spark.createDataFrame(data, SCHEMA)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((r[0], *brute(r[1]))) for r in data)


def test_filters_lose_no_block(spark):
    """At low thresholds many blocks match; the filtered join still equals the plain test."""
    data = [(k, t, "en", "s", 1, *["x"] * 23) for k, t in enumerate(cases())]
    got = licenses.license_scan(spark.createDataFrame(data, SCHEMA), threshold=0.4).collect()
    want = [(r[0], *brute(r[1], 0.4)) for r in data]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_each_notice_has_its_own_label_alone(spark):
    texts = [(label, f"Some words before it. {t} And some behind.") for label, t in licenses.TEMPLATES]
    texts += [("", "Licensed under CC BY 4.0."), ("", "Licensed under the GNU licence."), ("", "Licensed under CC BY-ND 4.0.")]
    data = [(k, t, "en", "s", 1, *["x"] * 23) for k, (_, t) in enumerate(texts)]
    got = licenses.license_scan(spark.createDataFrame(data, SCHEMA)).collect()
    assert {r["doc_id"]: r["labels"] for r in got} == {k: label for k, (label, _) in enumerate(texts)}


def test_order_is_by_frequency(monkeypatch):
    short = licenses.ordered_templates({"a": 9, "b": 1, "c": 5}, [("x", "a b c")], 0.6)[0]
    assert short["least"] == 3 and short["prefix"] == ["b"]
    monkeypatch.setattr(licenses, "SHORT", 0)
    ordered = licenses.ordered_templates({"a": 9, "b": 1, "c": 5}, [("x", "a b c")], 0.6)[0]
    assert ordered["words"] == ["b", "c", "a"] and ordered["least"] == 2 and ordered["prefix"] == ["b", "c"]


def test_empty(spark):
    assert licenses.license_scan(empty(spark)).count() == 0
