"""Byte-level BPE encoding and decoding with a sentencepiece BPE model built straight from the rank file.

The model is serialised by hand (protocol-buffer fields of the public sentencepiece format): piece i is rank i's
bytes, each byte mapped to one printable character; its score is -i, so that the merge of the lowest rank wins as
in rank order; the normaliser is the identity. Each match of the pre-token pattern is encoded on its own: a
pre-token that is itself in the vocabulary is one id, all others go through the model. Decoding maps ids back to
pieces and those to bytes.

Scale: one pass over the text without an exchange. The ranks are read by every Python worker from the tokenizer
file (a parameter; installed with the library on each machine) and the encodings of frequent pre-tokens are kept in
a bounded memo.

Edge cases: null and empty text give no ids and decode to empty bytes. Null ids decode to empty bytes. All other
columns pass through unread.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import small_slices

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
MEMO = 100_000
MEMO_CHARS = 64
SLICE_BYTES = 2 << 20
_FOUR_BYTES = struct.Struct("<i").pack


@lru_cache(maxsize=4)
def read_ranks(path: str) -> list[bytes]:
    """The bytes of each rank, from a file of ``base64 rank`` lines."""
    with open(path, "rb") as f:
        pairs = sorted((int(rank), base64.b64decode(token)) for token, rank in (x.split() for x in f if x.strip()))
    if [r for r, _ in pairs] != list(range(len(pairs))):
        raise ValueError("ranks must run from 0 without gaps")
    return [t for _, t in pairs]


def byte_characters() -> str:
    """256 distinct characters, none a space or control: printable Latin-1 stands for itself, the rest follow 255."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    moved = iter(range(0x100, 0x200))
    return "".join(chr(b if b in own else next(moved)) for b in range(256))


def _varint(n: int) -> bytes:
    out = bytearray()
    n &= (1 << 64) - 1
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _int(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _block(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


def model_bytes(tokens: list[bytes]) -> bytes:
    """A serialised sentencepiece model whose piece ids are the ranks; one unknown piece follows them."""
    chars = byte_characters()
    out = bytearray()
    for rank, token in enumerate(tokens):
        piece = "".join(chars[b] for b in token).encode()
        out += _block(1, _block(1, piece) + _varint(2 << 3 | 5) + struct.pack("<f", -float(rank)))
    out += _block(1, _block(1, b"<unk>") + _varint(2 << 3 | 5) + struct.pack("<f", 0.0) + _int(3, 2))
    out += _block(2, _int(3, 2) + _int(4, len(tokens) + 1) + _int(40, len(tokens)) + _int(41, -1) + _int(42, -1)
                  + _int(43, -1))
    out += _block(3, _block(1, b"identity") + _int(3, 0) + _int(4, 0) + _int(5, 0))
    return bytes(out)


@lru_cache(maxsize=1)
def newer_characters() -> dict[str, str]:
    """For letters and numbers, the characters that this regex module knows and the tiktoken library's Unicode tables do not.

    The library's own classes decide how it splits, so they are asked, once in a process that meets such a text.
    """
    every = "".join(map(chr, chain(range(0x370, 0xD800), range(0xE000, 0x110000))))
    out = {}
    for kind in (r"\p{L}", r"\p{N}"):
        theirs = tiktoken.Encoding("class", pat_str=kind, mergeable_ranks={bytes([i]): i for i in range(256)},
                                   special_tokens={}).encode_ordinary
        out[kind] = "".join(f"\\U{ord(c):08x}" for c in regex.findall(kind, every) if not theirs(c))
    return out


def splitter(pattern: str):
    """``findall`` of the pattern, with the tiktoken library's letters and numbers."""
    plain = regex.compile(pattern).findall

    @lru_cache(maxsize=1)
    def exact():
        newer = newer_characters()
        changed = pattern
        for kind, points in newer.items():
            if points:
                changed = changed.replace(kind, f"[{kind}--[{points}]]")
        return regex.compile("[" + "".join(newer.values()) + "]").search, regex.compile(changed, regex.V1).findall

    def split(text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            met, findall = exact()
            return findall(text) if met(text) else plain(text)
        return plain(text)

    return split


class Codec:
    """Encoder and decoder over one rank file."""

    def __init__(self, path: str, pattern: str):
        self.tokens = read_ranks(path)
        self.ranks = {t: i for i, t in enumerate(self.tokens)}
        self.split = splitter(pattern)
        self.table = {b: c for b, c in enumerate(byte_characters())}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(self.tokens))
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _learn(self, pieces: Iterable[str]) -> dict[str, bytes]:
        found, rest, mapped = {}, [], []
        for p in pieces:
            raw = p.encode("utf-8", "surrogatepass")
            rank = self.ranks.get(raw)
            if rank is not None:
                found[p] = _FOUR_BYTES(rank)
            else:
                rest.append(p)
                mapped.append(raw.decode("latin-1").translate(self.table))
        for p, ids in zip(rest, self.model.encode(mapped, num_threads=1)):
            found[p] = struct.pack(f"<{len(ids)}i", *ids)
        return found

    def packed(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers; new pre-tokens of all texts are learned in one call.

        The memo has two generations: a full one becomes the older, and what is met again moves back to the younger, so
        frequent pre-tokens are never learned anew.
        """
        split = [self.split(t) for t in texts]
        if len(self.memo) > MEMO:
            self.older, self.memo = self.memo, {}
        memo, older = self.memo, self.older
        new = set(chain.from_iterable(split)).difference(memo)
        known = {p: older[p] for p in new if p in older}
        memo.update(known)
        found = self._learn(new.difference(known))
        long = {p: found.pop(p) for p in new if len(p) > MEMO_CHARS}
        memo.update(found)
        if long:
            return [b"".join([long[p] if p in long else memo[p] for p in pieces]) for pieces in split]
        return [b"".join(map(memo.__getitem__, pieces)) for pieces in split]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed([text])[0], dtype="<i4").tolist()

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def vocabulary(name: str = VOCABULARY) -> str:
    return public_tokenizers.path(name)


def _lists(packed: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(p) // 4 for p in packed)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(packed), dtype="<i4")))


def _with(df: DataFrame, make, out: list[str], kinds: list[str]) -> DataFrame:
    """``__row`` unpacked, with the columns that ``make`` yields from the Arrow column ``__in``."""
    names = [f"__out{k}" for k in range(len(out))]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches, SLICE_BYTES):
            yield pa.RecordBatch.from_arrays([batch.column("__row"), *make(batch.column("__in"))], ["__row", *names])

    row = df.schema["__row"].dataType.simpleString()
    made = df.mapInArrow(run, f"__row {row}, " + ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))
    return made.select("__row.*", *[F.col(n).alias(o) for n, o in zip(names, out)])


def encode(docs: DataFrame, text: str = "text", out: str = "ids", decoded: str | None = None,
           path: str | None = None, pattern: str = public_tokenizers.PATTERN,
           keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) and ``out``, the token ids of column ``text`` (array<int>).

    ``decoded`` names a column for the bytes those ids decode to, made in the same pass.
    """
    path = path or vocabulary()

    def make(column: pa.Array) -> list[pa.Array]:
        own = codec(path, pattern)
        ids = own.packed([t or "" for t in column.to_pylist()])
        back = [own.decode(np.frombuffer(i, dtype="<i4").tolist()) for i in ids] if decoded else []
        return [_lists(ids), *([pa.array(back, pa.binary())] if decoded else [])]

    cols = [F.col(c) for c in (keep if keep is not None else docs.columns)]
    rows = docs.select(F.struct(*cols).alias("__row"), F.col(text).cast("string").alias("__in"))
    return _with(rows, make, [out, decoded] if decoded else [out], ["array<int>", "binary"][:2 if decoded else 1])


def decode(encoded: DataFrame, ids: str = "ids", out: str = "decoded", path: str | None = None) -> DataFrame:
    """All columns and ``out``, the bytes that the ids stand for (binary)."""
    path = path or vocabulary()

    def make(column: pa.Array) -> list[pa.Array]:
        tokens = read_ranks(path)
        return [pa.array([b"".join(map(tokens.__getitem__, i)) if i else b"" for i in column.to_pylist()], pa.binary())]

    return _with(encoded.select(F.struct("*").alias("__row"), F.col(ids).alias("__in")), make, [out], ["binary"])


def digests(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (doc_id), n_tokens, ids_sha256 and decoded_sha256 of each row: the encoding and its inverse."""
    both = encode(docs, text, decoded="decoded", keep=keep or ["doc_id"])
    listed = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return both.select(*(keep or ["doc_id"]), F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
