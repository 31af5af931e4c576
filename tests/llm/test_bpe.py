"""Byte-level BPE against the tiktoken library, and exact round trips."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import empty, messy, rows
from tidepool.llm import bpe

CODEC = bpe.codec(bpe.vocabulary(), public_tokenizers.PATTERN)
THEIRS = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=CODEC.ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=200))
def test_any_text(text):
    ids = CODEC.encode(text)
    assert ids == THEIRS.encode_ordinary(text) and CODEC.decode(ids) == text.encode()


def test_odd_texts_and_newer_letters():
    rng = random.Random(1)
    odd = ["<|endoftext|>", "a" * 5000, " " * 3000 + "x", "it's We'LL 123", "\U00031400 Ᲊx", "日本語テスト 中文"]
    odd += ["".join(chr(rng.choice([rng.randrange(0xD800), rng.randrange(0xE000, 0x110000)])) for _ in range(300))
            for _ in range(50)]
    for text in odd:
        assert CODEC.encode(text) == THEIRS.encode_ordinary(text)


def test_memo_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 5)
    own = bpe.Codec(bpe.vocabulary(), public_tokenizers.PATTERN)
    for k in range(50):
        text = f"word{k} other{k} x{'y' * 100}{k}"
        assert own.encode(text) == THEIRS.encode_ordinary(text)
    assert len(own.memo) < 20


def test_columns_digests_and_decoding(spark):
    got = bpe.digests(messy(spark)).collect()
    want = []
    for r in rows():
        ids = THEIRS.encode_ordinary(r[1] or "")
        want.append((r[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((r[1] or "").encode()).hexdigest()))
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, want))
    docs = messy(spark)
    both = bpe.decode(bpe.encode(docs, out="tokens"), ids="tokens")
    assert both.columns == [*docs.columns, "tokens", "decoded"]
    assert all(bytes(r["decoded"]) == (r["text"] or "").encode() for r in both.collect())


def test_empty(spark):
    assert bpe.digests(empty(spark)).count() == 0
