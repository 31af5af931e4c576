"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The pieces and scores of a sentencepiece BPE model file become numpy tables. A text, spaces as U+2581 and one in front, is
cut into words where no piece can reach across. All new words of a slice of texts lie in flat symbol arrays; a round takes
the least pair rank of every word (segmented minimum), merges all leftmost pairs of that rank at once, compacts the arrays and
drops the words that have no pair left. Merging one pair at a time gives the same, unless a merge makes a pair of a rank no
greater than its own: in a word where that happens only the leftmost pair is merged in that round. A word of more than
``LONG`` symbols takes its rounds over linked arrays, where a round touches the pairs of its rank alone, so that a text without
spaces costs no rounds times length. Characters outside the vocabulary end as their UTF-8 bytes' pieces.
Decoding looks the pieces up, drops the space in front and puts bytes together.

Scale: one pass over the text without an exchange. Each Python worker reads the model file (a parameter; installed with the library on each
machine) and keeps the ids of at most ``MEMO`` distinct words; when these are full, only the words of the slice at hand stay.

Edge cases: null and empty texts give no ids; no ids, or null ones, decode to the empty string. Repeated rows are encoded as often as they occur,
ranks that tie go to the leftmost pair, bytes that are no UTF-8 decode to U+FFFD each, control ids to nothing and the unknown
id to the model's mark. All other columns pass through unread.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import arrow_columns

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
MEMO = 200_000
LONG = 1024
SLICE_BYTES = 1 << 20
#: Fixed values of the sentencepiece format: the piece types, and the model type of BPE.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BPE = 2
NONE = np.iinfo(np.int32).max


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a serialised protocol-buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        n = shift = 0
        while True:
            byte = data[at]
            at += 1
            n |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return n

    while at < len(data):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(tag & 7) or number()
            yield tag >> 3, data[at:at + size]
            at += size


class Model:
    """Tables of one model file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            top = list(_fields(f.read()))
        entries = [dict(_fields(v)) for k, v in top if k == 1]
        self.pieces = [e[1].decode() for e in entries]
        kinds = [e.get(3, NORMAL) for e in entries]
        scores = [struct.unpack("<f", e[2])[0] if 2 in e else 0.0 for e in entries]
        trainer, normaliser = (dict(_fields(b"".join(v for k, v in top if k == n))) for n in (2, 3))
        plain = normaliser.get(3, 1) == 1 and normaliser.get(4, 1) == 0 and normaliser.get(5, 1) == 1
        if trainer.get(3) != BPE or not trainer.get(35) or normaliser.get(2) or not plain \
                or set(kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("only BPE models with byte fallback, identity normalisation and a space in front are known")
        ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, kinds)) if k == NORMAL}
        levels = {s: r for r, s in enumerate(sorted({scores[i] for i in ids.values()}, reverse=True))}
        self.size = len(self.pieces)
        self.chars = np.full(0x110000, -1, dtype=np.int32)
        pairs = []
        for piece, i in ids.items():
            if len(piece) == 1:
                self.chars[ord(piece)] = i
            pairs += [(ids[piece[:k]] * self.size + ids[piece[k:]], levels[scores[i]], i)
                      for k in range(1, len(piece)) if piece[:k] in ids and piece[k:] in ids]
        pairs = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 3)
        self.keys = np.append(pairs[:, 0], np.iinfo(np.int64).max)
        self.ranks = np.append(pairs[:, 1], NONE).astype(np.int32)
        self.merged = np.append(pairs[:, 2], -1).astype(np.int32)
        bytes_of = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, kinds)) if k == BYTE}
        self.byte_ids = np.array([bytes_of[b] for b in range(256)], dtype=np.int32)
        mark = trainer.get(44, " ⁇ ".encode())
        back = {v: k for k, v in bytes_of.items()}
        self.surfaces = [{NORMAL: p.replace(SPACE, " ").encode(), UNKNOWN: mark, CONTROL: b""}.get(k, b"") if i not in back
                         else bytes([back[i]]) for i, (p, k) in enumerate(zip(self.pieces, kinds))]
        self.is_byte = [k == BYTE for k in kinds]
        self.controls = {i for i, k in enumerate(kinds) if k == CONTROL}
        self.opens = [k == NORMAL and p.startswith(SPACE) for p, k in zip(self.pieces, kinds)]
        self.words = re.compile(self._pattern(ids, scores)).findall

    def _pattern(self, ids: dict[str, int], scores: list[float]) -> str:
        """Words: runs of spaces and what follows them, if no piece has a space behind another character.

        Where the pieces of 2 to n spaces share the least score of all and none has two spaces before other characters, a
        longer run of spaces ends as blocks of n from the left, so those are words of their own.
        """
        if any(SPACE in p.lstrip(SPACE) for p in ids):
            return r"(?s).+"
        runs = sorted(len(p) for p in ids if len(p) > 1 and not p.strip(SPACE))
        least = min(scores[i] for p, i in ids.items() if len(p) > 1)
        block = ""
        if (runs and runs == list(range(2, runs[-1] + 1)) and {scores[ids[SPACE * n]] for n in runs} == {least}
                and not any(p.startswith(SPACE * 2) and p.strip(SPACE) for p in ids)):
            block = f"{SPACE}{{{runs[-1]}}}(?={SPACE})|"
        return f"{block}{SPACE}*[^{SPACE}]+|{SPACE}+"

    def look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (``NONE`` if there is none) and piece of each pair of symbols; negative symbols never pair."""
        key = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.keys, key)
        fits = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(fits, self.ranks[at], NONE), self.merged[at]

    def symbols(self, text: str) -> np.ndarray:
        """The id of each character, or its code point less 0x110000 where the vocabulary lacks it."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int32)
        found = self.chars[points]
        return np.where(found < 0, points - 0x110000, found)

    def fall_back(self, symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols with unknown characters as ids of their bytes, and the ends of words moved accordingly."""
        unknown = np.flatnonzero(symbols < 0)
        if not len(unknown):
            return symbols, ends
        encoded = [chr(c + 0x110000).encode("utf-8", "surrogatepass") for c in symbols[unknown].tolist()]
        sizes = np.ones(len(symbols), dtype=np.int64)
        sizes[unknown] = [len(b) for b in encoded]
        out = np.repeat(symbols, sizes)
        out[out < 0] = self.byte_ids[np.frombuffer(b"".join(encoded), dtype=np.uint8)]
        return out, np.concatenate([[0], np.cumsum(sizes)])[ends]

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and where each word ends."""
        done: list[np.ndarray] = [np.empty(0, np.int32)] * len(words)
        short = []
        for k, w in enumerate(words):
            if len(w) > LONG:
                done[k] = self._long(self.symbols(w))
            else:
                short.append(k)
        ids, ends = self._rounds(self.symbols("".join(words[k] for k in short)),
                                 np.fromiter((len(words[k]) for k in short), np.int64, len(short)))
        if len(short) < len(words):
            for k, part in zip(short, np.split(ids, ends[:-1]) if short else []):
                done[k] = part
            ids = np.concatenate(done)
            ends = np.cumsum([len(d) for d in done])
        return self.fall_back(ids, ends)

    def _rounds(self, s: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge rounds over words of ``lengths`` symbols (none is empty) in one flat array."""
        word = np.repeat(np.arange(len(lengths)), lengths)
        kept_ids, kept_words = [], []
        rank, into = np.full(len(s), NONE, dtype=np.int32), np.zeros(len(s), dtype=np.int32)

        def ranked(at: np.ndarray) -> None:
            at = at[(at >= 0) & (at < len(s))]
            inner = at[at + 1 < len(s)]
            inner = inner[word[inner] == word[inner + 1]]
            rank[at] = NONE
            rank[inner], into[inner] = self.look(s[inner], s[inner + 1])

        ranked(np.arange(len(s)))
        while len(s):
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            sizes = np.diff(np.append(starts, len(s)))
            least = np.minimum.reduceat(rank, starts)
            if (least == NONE).any():
                live = np.repeat(least != NONE, sizes)
                kept_ids.append(s[~live])
                kept_words.append(word[~live])
                s, word, rank, into = s[live], word[live], rank[live], into[live]
                sizes, least = sizes[least != NONE], least[least != NONE]
                if not len(s):
                    break
            of = np.repeat(np.arange(len(sizes)), sizes)
            at = self._leftmost(np.flatnonzero(rank == least[of]), 1)
            ends = np.cumsum(sizes)
            new = into[at]
            follows = at + 2 < ends[of[at]]
            after = np.where(follows, s[np.minimum(at + 2, len(s) - 1)], -1)
            merged = s.copy()
            merged[at + 1] = new
            before = np.where(at > (ends - sizes)[of[at]], merged[at - 1], -1)
            made = np.minimum(self.look(before, new)[0], self.look(new, after)[0])
            early = made <= least[of[at]]
            if early.any():
                alone = np.zeros(len(sizes), dtype=bool)
                alone[of[at[early]]] = True
                first = np.concatenate([[True], of[at][1:] != of[at][:-1]])
                at = at[first | ~alone[of[at]]]
                new = into[at]
            s[at] = new
            stay = np.ones(len(s), dtype=bool)
            stay[at + 1] = False
            moved = at - np.arange(len(at))
            s, word, rank, into = s[stay], word[stay], rank[stay], into[stay]
            ranked(np.concatenate([moved - 1, moved]))
        ids, of = (np.concatenate([np.empty(0, np.int32), *x]) for x in (kept_ids, kept_words))
        order = np.argsort(of, kind="stable")
        return ids[order].astype(np.int32), np.cumsum(np.bincount(of.astype(np.int64), minlength=len(lengths)))

    @staticmethod
    def _leftmost(at: np.ndarray, step: int | np.ndarray) -> np.ndarray:
        """Of ascending pair positions, the leftmost ones that share no symbol: every other one of a chain.

        ``step``: how far right of each position the next symbol lies.
        """
        if len(at) < 2:
            return at
        chained = np.concatenate([[False], (at + step)[:-1] == at[1:]])
        place = np.arange(len(at))
        return at[(place - np.maximum.accumulate(np.where(chained, 0, place))) % 2 == 0]

    def _long(self, s: np.ndarray) -> np.ndarray:
        """Merge rounds over one long word, its symbols linked in place; a round visits the pairs of its rank."""
        n = len(s)
        right, left = np.arange(1, n + 1), np.arange(-1, n - 1)
        s = np.append(s, -1)  # behind the last symbol, and before the first
        rank, into = np.full(n + 1, NONE, dtype=np.int32), np.zeros(n + 1, dtype=np.int32)
        waiting: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def ranked(at: np.ndarray) -> None:
            rank[at], into[at] = self.look(s[at], s[right[at]])
            at = at[rank[at] != NONE]
            at = at[np.argsort(rank[at], kind="stable")]
            cuts = np.flatnonzero(np.diff(rank[at])) + 1
            for part in np.split(at, cuts) if len(at) else []:
                r = int(rank[part[0]])
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(heap, r)
                waiting[r].append(part)

        ranked(np.arange(n))
        while heap:
            r = heapq.heappop(heap)
            every = np.unique(np.concatenate(waiting.pop(r)))
            every = every[rank[every] == r]
            if not len(every):
                continue
            at = self._leftmost(every, right[every] - every)
            new = into[at]
            gone = right[at]
            merged = s.copy() if len(at) > 1 else s
            if len(at) > 1:
                merged[gone] = new
            before = merged[left[at]]
            made = np.minimum(self.look(before, new)[0], self.look(new, s[right[gone]] if n else s[:0])[0])
            if len(at) > 1 and (made <= r).any():
                at, new, gone = at[:1], new[:1], gone[:1]
            rest = np.setdiff1d(every, at)
            s[at] = new
            rank[gone] = NONE
            right[at] = right[gone]
            inner = at[right[at] < n]
            left[right[inner]] = inner
            s[gone] = -1
            if len(rest):
                waiting[r] = [rest]
                heapq.heappush(heap, r)
            ranked(np.unique(np.concatenate([at, left[at][left[at] >= 0]])))
        alive, out = 0, []
        while alive < n:
            out.append(s[alive])
            alive = right[alive]
        return np.array(out, dtype=np.int32)


class Codec:
    """Encoder and decoder with a bounded memo of words."""

    def __init__(self, path: str):
        self.model = Model(path)
        self._start([], np.empty(0, np.int32), np.empty(0, np.int64))

    def _start(self, words: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        self.memo = dict(zip(words, range(len(words))))
        self.ids, self.ends = ids, np.concatenate([[0], ends]).astype(np.int64)

    def _gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the memo's entries ``numbers`` in a row, and where each ends."""
        begin = self.ends[numbers]
        sizes = self.ends[numbers + 1] - begin
        ends = np.cumsum(sizes)
        return self.ids[np.repeat(begin - (ends - sizes), sizes) + np.arange(int(sizes.sum()))], ends

    def encode(self, texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where each text ends."""
        words, counts = [], []
        for text in texts:
            found = self.model.words(SPACE + text.replace(" ", SPACE)) if text else []
            words += found
            counts.append(len(found))
        distinct = set(words)
        if len(self.memo) > MEMO:
            stay = [w for w in distinct if w in self.memo]
            self._start(stay, *self._gather(np.fromiter(map(self.memo.__getitem__, stay), np.int64, len(stay))))
        new = list(distinct.difference(self.memo))
        if new:
            ids, ends = self.model.merge(new)
            self.memo.update(zip(new, range(len(self.memo), len(self.memo) + len(new))))
            self.ends = np.concatenate([self.ends, self.ends[-1] + ends])
            self.ids = np.concatenate([self.ids, ids])
        ids, ends = self._gather(np.fromiter(map(self.memo.__getitem__, words), np.int64, len(words)))
        return ids, np.concatenate([[0], ends])[np.cumsum(counts, dtype=np.int64)]

    def decode(self, ids: list[int]) -> str:
        m, front = self.model, 0
        while front < len(ids) and not m.surfaces[ids[front]]:
            front += 1
        if not m.controls.isdisjoint(ids):  # they show nothing, yet part the bytes around them
            return self._mended(ids, front)
        raw = b"".join(map(m.surfaces.__getitem__, ids))
        raw = raw[1:] if front < len(ids) and m.opens[ids[front]] else raw
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return self._mended(ids, front)

    def _mended(self, ids: list[int], front: int) -> str:
        """Bytes that are no UTF-8 become U+FFFD one by one; a run of byte pieces is read by itself."""
        m, out, run = self.model, [], bytearray()

        def flush() -> None:
            at = 0
            while at < len(run):
                for size in range(1, 5):
                    try:
                        out.append(run[at:at + size].decode())
                        break
                    except UnicodeDecodeError:
                        size = 0
                else:
                    out.append("�")
                at += size or 1
            run.clear()

        for k, i in enumerate(ids):
            if m.is_byte[i]:
                run += m.surfaces[i]
            else:
                flush()
                surface = m.surfaces[i].decode()
                out.append(surface[1:] if k == front and m.opens[i] else surface)
        flush()
        return "".join(out)


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    return Codec(path)


def encode(docs: DataFrame, text: str = "text", out: str = "ids", decoded: str | None = None, path: str | None = None,
           keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) and ``out``, the ids of column ``text`` (array<int>), without begin or end ids.

    ``decoded`` names a column for the text those ids decode to, made in the same pass.
    """
    path = path or public_tokenizers.path(MODEL)

    def make(column: pa.Array) -> list[pa.Array]:
        own = codec(path)
        ids, ends = own.encode(t or "" for t in column.to_pylist())
        starts = np.concatenate([[0], ends])
        lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids))
        if not decoded:
            return [lists]
        flat = ids.tolist()
        return [lists, pa.array([own.decode(flat[a:b]) for a, b in zip(starts.tolist(), ends.tolist())], pa.string())]

    cols = [F.col(c) for c in (keep if keep is not None else docs.columns)]
    outs = {out: "array<int>"} | ({decoded: "string"} if decoded else {})
    return arrow_columns(docs, cols, F.col(text).cast("string"), make, outs, SLICE_BYTES)


def decode(encoded: DataFrame, ids: str = "ids", out: str = "decoded", path: str | None = None) -> DataFrame:
    """All columns and ``out``, the text that the ids stand for."""
    path = path or public_tokenizers.path(MODEL)

    def make(column: pa.Array) -> list[pa.Array]:
        return [pa.array([codec(path).decode(i or []) for i in column.to_pylist()], pa.string())]

    return arrow_columns(encoded, [F.col(c) for c in encoded.columns], F.col(ids), make, {out: "string"}, SLICE_BYTES)


def digests(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (doc_id), n_tokens, ids_sha256 and decoded_sha256 of each row: the encoding and its inverse."""
    keep = keep or ["doc_id"]
    both = encode(docs, text, decoded="decoded", keep=keep)
    listed = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return both.select(*keep, F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
