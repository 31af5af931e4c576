"""SentencePiece BPE against the sentencepiece library, and its decoding of any ids."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import empty, messy, rows
from tidepool.llm import piece_bpe

PATH = public_tokenizers.path(piece_bpe.MODEL)
CODEC = piece_bpe.codec(PATH)
THEIRS = sentencepiece.SentencePieceProcessor(model_file=PATH)


def encode(texts, own=CODEC):
    ids, ends = own.encode(texts)
    starts = [0, *ends.tolist()]
    return [ids[a:b].tolist() for a, b in zip(starts, starts[1:])]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=120), max_size=4))
def test_any_texts(texts):
    ids = encode(texts)
    assert ids == [THEIRS.encode(t) for t in texts]
    assert [CODEC.decode(i) for i in ids] == [THEIRS.decode(i) for i in ids]


def odd_texts():
    rng = random.Random(1)
    odd = ["", " ", "  a", " " * 40, "▁x▁▁", "<s> </s><unk><0x41>", "a" * 5000, " " * 3000 + "x" + " " * 17 + "y" + " " * 16 + "z ",
           "日本語テスト 中文", "\x00a\x00", "ab" * 4000, "\U0001F600" * 3000,
           "".join(rng.choice("etaoinshrdlu") for _ in range(100_000))]
    for _ in range(800):
        kind = rng.choice(["ab ", "abcdefghijklmnopqrstuvwxyz  ", "the an ing\n", " ▁x", "éèüß日本\U0001F600 a", "0123456789. "])
        odd.append("".join(rng.choice(kind) for _ in range(rng.randint(1, 300))))
    return odd


@pytest.mark.parametrize("long", [1, 4, 1024])
def test_odd_texts_by_flat_and_linked_rounds(monkeypatch, long):
    monkeypatch.setattr(piece_bpe, "LONG", long)
    odd = odd_texts()
    assert encode(odd, piece_bpe.Codec(PATH)) == THEIRS.encode(odd, num_threads=1)


def test_memo_is_bounded(monkeypatch):
    monkeypatch.setattr(piece_bpe, "MEMO", 5)
    own = piece_bpe.Codec(PATH)
    for k in range(50):
        text = f"word{k} other{k} the same x{'y' * 100}{k}"
        assert encode([text, "the same"], own) == THEIRS.encode([text, "the same"], num_threads=1)
    assert len(own.memo) < 20 and len(own.ids) < 400


def test_decoding_of_any_ids():
    rng = random.Random(2)
    for _ in range(20_000):
        ids = [rng.choice([rng.randrange(32_000), rng.randrange(259), rng.randrange(3), 259, 28705]) for _ in range(rng.randint(0, 12))]
        assert CODEC.decode(ids) == THEIRS.decode(ids)


def test_columns_digests_and_decoding(spark):
    got = piece_bpe.digests(messy(spark)).collect()
    want = []
    for r in rows():
        ids = THEIRS.encode(r[1] or "")
        want.append((r[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(THEIRS.decode(ids).encode()).hexdigest()))
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, want))
    docs = messy(spark)
    both = piece_bpe.decode(piece_bpe.encode(docs, out="tokens"), ids="tokens")
    assert both.columns == [*docs.columns, "tokens", "decoded"]
    assert all(r["decoded"] == (r["text"] or "") for r in both.collect())


def test_empty(spark):
    assert piece_bpe.digests(empty(spark)).count() == 0


def test_other_models_are_refused(tmp_path):
    other = tmp_path / "unigram.model"
    other.write_bytes(b"\x12\x02\x18\x01")
    with pytest.raises(ValueError):
        piece_bpe.Model(str(other))
