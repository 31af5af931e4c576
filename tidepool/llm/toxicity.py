"""Toxicity by a subsequence string-kernel SVM with Nyström landmarks.

Kernel: two strings are as alike as the letter triples they share, in order but not necessarily adjacent; a triple
that spans s characters weighs DECAY ** s, up to MAX_SPAN. Inserted or odd characters only widen spans, so gapped spellings
stay close to the plain word. A string is divided by the norm its spans would have if all its triples differed. Word
ends count as letters; other scripts' letters share a few codes.

Model: a sentence (up to a word that ends in . ! or ?; line ends are white space) scores as its best segment: a word,
or what white space may have broken: two neighbours of which one is a short piece that no two training documents know
as a word, and runs of three or more single letters, or of these and such pieces, in windows of ``RUN`` (a comma,
colon or semicolon parts them). Landmarks are the segments whose document frequencies differ most between the classes,
and random ones of clean sentences. The SVM (squared hinge, in the Nyström space of the landmarks) is trained on the
segments that witness their sentence's label: every sentence of a clean document is clean, the best-scoring sentences
of a toxic one are toxic. Positives are segments far commoner in toxic documents and the best of those sentences,
negatives the worst false alarms of clean sentences and random clean segments; an error costs the share of documents
that hold the segment. Joined pieces are looked at in scoring only: as instances they cost accuracy (check_s: 28 false
alarms against 6). Witnesses are chosen anew for a few rounds. A document's score is a logistic function of the
largest distinct margins inside its best sentence and of those of all its sentences. As the kernel is a product of
triple weights, the whole decision function is one table with a weight per triple; the scoring tasks get it and the
words of the training documents.

Scale: the model is fitted on the driver on at most ``MAX_TRAIN`` labelled documents of each class (those with the
smallest hash); everything else is one pass over whole texts without an exchange. A task holds one slice of rows, the
table (under 1 MB), the known words (of the training sample) and a bounded memo of words' margins.

Edge cases: null text counts as empty; a text without segments gets the score of the lowest margin, below 0.5.
Rows without a label, or with a null one, are not learned from. Labels that repeat a doc_id are one label, toxic if any is.
Only ``doc_id`` and ``text`` are read (``labels``: doc_id, toxic). Without labels of both classes every score is the
share of toxic labels (0 without any).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import small_slices, text_or_empty

LETTERS = 48
END = LETTERS - 1
DECAY = 0.6
MAX_SPAN = 7
MAX_TRAIN = 2000
LANDMARKS = 128
ROUNDS = 3
WITNESSES = 4
ANCHOR_LIFT, WITNESS_LIFT = 2.9, 1.5
MAX_ANCHORS = 300
MAX_INSTANCES = 4000
COST = 2000.0
TOP = 3
MEMO = 200_000
FLOOR, CEILING = -1.0, 1.5
SENTENCE_END = (".", "!", "?")
PAUSE = (",", ";", ":")
CLOSING = "\"')]}»”’"
PIECE, PARTNER = 5, 8
RUN = 16
OFFSETS = [(a, b) for b in range(2, MAX_SPAN) for a in range(1, b)]


class _Letters(dict):
    """Lower-case characters to codes as characters: a-z 1-26, other letters 27-46, all else 0 (a gap)."""

    def __missing__(self, point: int) -> str:
        c = chr(point)
        code = point - 96 if "a" <= c <= "z" else 27 + point % 20 if c.isalpha() else 0
        self[point] = chr(code)
        return self[point]


_CODES = _Letters()
_TRIM = re.compile(r"^[\W\d_]+|[\W\d_]+$")


class Reader:
    """Texts, as lower-case tokens between white space, to segments numbered by sentence."""

    def __init__(self, known: frozenset[str], pieces: bool = True) -> None:
        """``pieces``: whether neighbours are joined; runs of single letters always are."""
        self.known, self.pieces = known, pieces
        self.forget()

    def forget(self) -> None:
        self.at: dict[str, int] = {}
        self.words: list[str] = []
        self.size = np.empty(0, np.int64)
        self.ends, self.pause, self.unknown = (np.empty(0, bool) for _ in range(3))

    def learn(self, texts: list[list[str]]) -> None:
        new = sorted(set().union(*texts).difference(self.at))
        words = [t if t.isalpha() else _TRIM.sub("", t) for t in new]
        self.at.update(zip(new, range(len(self.words), len(self.words) + len(new))))
        self.words += words
        self.size = np.concatenate([self.size, np.array([len(w) for w in words], np.int64)])
        self.ends = np.concatenate([self.ends, np.array([t.rstrip(CLOSING).endswith(SENTENCE_END) for t in new], bool)])
        self.pause = np.concatenate([self.pause, np.array([t.endswith(PAUSE) for t in new], bool)])
        self.unknown = np.concatenate([self.unknown, np.array([len(w) > 1 and w not in self.known for w in words], bool)])

    def read(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray, list[tuple[str, int]]]:
        """Numbers of the words of a learned text, their sentences, and the joined segments with their sentences."""
        at = np.fromiter(map(self.at.__getitem__, tokens), np.int64, len(tokens))
        ends = self.ends[at]
        sentence = np.cumsum(ends) - ends
        held = self.size[at] > 0
        at, sentence = at[held], sentence[held]
        size = self.size[at]
        near = (sentence[1:] == sentence[:-1]) & ~self.pause[at[:-1]]
        piece, partner = self.unknown[at] & (size <= PIECE) & self.pieces, size <= PARTNER
        joined = [(self.words[at[i]] + self.words[at[i + 1]], int(sentence[i])) for i in np.flatnonzero(
            near & (piece[1:] | piece[:-1]) & partner[1:] & partner[:-1]).tolist()]
        letter = size == 1
        for part in (letter, letter | piece) if piece.any() else (letter,):
            edges = np.flatnonzero(np.diff((near & part[1:] & part[:-1]).astype(np.int8), prepend=0, append=0)).tolist()
            for first, last in zip(edges[::2], edges[1::2]):
                if last - first >= 2:
                    joined.extend(("".join(self.words[j] for j in at[k:min(k + RUN, last + 1)]), int(sentence[first]))
                                  for k in range(first, max(first + 1, last + 1 - RUN // 2), RUN // 2))
        return at, sentence, joined


def tokens(text: str) -> list[str]:
    return text.lower().split()


def triples(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Flat arrays over all triples of ``words``: index of the word, code of the triple, normalised weight."""
    stream = chr(END) + f"{chr(END)}\x7f{chr(END)}".join(w.translate(_CODES) for w in words) + chr(END)
    codes = np.frombuffer(stream.encode("latin-1"), dtype=np.uint8).astype(np.int32)
    word = np.cumsum(codes == 0x7F).astype(np.int32)
    letter = (codes > 0) & (codes != 0x7F)
    n = len(codes)
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for a, b in OFFSETS:
        if n <= b:
            continue
        i = np.flatnonzero(letter[:n - b] & letter[a:n - b + a] & letter[b:] & (word[:n - b] == word[b:]))
        code = (codes[i] * LETTERS + codes[i + a]) * LETTERS + codes[i + b]
        parts.append((word[i], code, np.full(len(i), DECAY ** (b + 1), dtype=np.float32)))
    if not parts:
        none = np.empty(0, dtype=np.int32)
        return none, none, none.astype(np.float32)
    at, code, weight = (np.concatenate([p[k] for p in parts]) for k in range(3))
    norm = np.sqrt(np.bincount(at, weights=weight.astype(np.float64) ** 2, minlength=len(words)))
    return at, code, (weight / norm[at]).astype(np.float32)


def kernel(words: list[str], landmarks: list[str], step: int = 250) -> np.ndarray:
    """The kernel between every word and every landmark."""
    at, code, weight = triples(landmarks)
    table = np.zeros((LETTERS ** 3, len(landmarks)), dtype=np.float32)
    np.add.at(table, (code, at), weight)
    out = np.zeros((len(words), len(landmarks)), dtype=np.float32)
    for k in range(0, len(words), step):
        at, code, weight = triples(words[k:k + step])
        order = np.argsort(at, kind="stable")
        at, code, weight = at[order], code[order], weight[order]
        first = np.flatnonzero(np.diff(at, prepend=-1))
        if len(first):
            out[k + at[first]] = np.add.reduceat(weight[:, None] * table[code], first, axis=0)
    return out


@dataclass
class Model:
    """``table``: a weight per triple; ``bias``; top margins -> score by slope and shift; ``share`` of toxic labels;
    ``known`` words."""
    table: np.ndarray
    bias: float
    slope: np.ndarray | None
    shift: float
    share: float
    known: frozenset[str] = frozenset()

    def margins(self, words: list[str], step: int = 5000) -> np.ndarray:
        out = np.empty(len(words), dtype=np.float32)
        for k in range(0, len(words), step):
            part = words[k:k + step]
            at, code, weight = triples(part)
            out[k:k + step] = np.bincount(at, weights=weight * self.table[code], minlength=len(part)) + self.bias
        return out

    def score(self, margins: np.ndarray, sentence: np.ndarray) -> float:
        """The score of a text from the margins and the sentences of its segments."""
        if self.slope is None:
            return self.share
        return float(1 / (1 + np.exp(-np.clip(features(margins, sentence) @ self.slope + self.shift, -35, 35))))


def features(margins: np.ndarray, sentence: np.ndarray) -> np.ndarray:
    """The largest distinct margins inside the best sentence, then the largest distinct ones of the sentences' best.

    A sentence is as good as its ``TOP`` largest margins together; margins under FLOOR, and missing ones, count as FLOOR.
    """
    out = np.full(2 * TOP, FLOOR)
    use = np.flatnonzero(margins > FLOOR)
    if not len(use):
        return out
    m, s = margins[use], sentence[use]
    order = np.lexsort((-m, s))
    m, s = m[order], s[order]
    new = np.diff(s, prepend=-1) != 0
    once = new | (np.diff(m, prepend=np.inf) != 0)
    m, s = np.minimum(m[once], CEILING), s[once]
    starts = np.flatnonzero(np.diff(s, prepend=-1))
    ends = np.append(starts[1:], len(m))
    rank = np.arange(len(m)) - np.repeat(starts, ends - starts)
    best = int(np.add.reduceat(np.where(rank < TOP, m - FLOOR, 0.0), starts).argmax())
    inside = m[starts[best]:min(ends[best], starts[best] + TOP)]
    across = np.unique(m[starts])[::-1][:TOP]
    out[:len(inside)], out[TOP:TOP + len(across)] = inside, across
    return out


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights (the last one is the bias) of a linear SVM with squared hinge loss, by finite Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)])
    w = np.zeros(x.shape[1])
    reg = ridge * np.eye(len(w))
    reg[-1, -1] = 1e-6
    active = np.ones(len(x), dtype=bool)
    for _ in range(rounds):
        xa, ca = x[active], cost[active]
        w = np.linalg.solve(xa.T @ (xa * ca[:, None].astype(xa.dtype)) + reg, xa.T @ (ca * y[active]))
        now = y * (x @ w) < 1
        if np.array_equal(now, active):
            break
        active = now
    return w


def _logistic(x: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights (none negative) and shift of the score over the top margins, by Newton steps with a small ridge."""
    use = np.ones(x.shape[1], dtype=bool)
    while True:
        z = np.hstack([x[:, use], np.ones((len(x), 1))])
        w = np.zeros(z.shape[1])
        ridge = np.diag([0.05] * use.sum() + [1e-9])
        for _ in range(60):
            q = 1 / (1 + np.exp(-np.clip(z @ w, -35, 35)))
            step = np.linalg.solve((z * (q * (1 - q))[:, None]).T @ z + ridge + 1e-9 * np.eye(len(w)),
                                   z.T @ (q - label) + ridge @ w)
            w -= step
            if np.abs(step).max() < 1e-8:
                break
        if (w[:-1] >= 0).all() or use.sum() == 1:
            break
        use[np.flatnonzero(use)[w[:-1] < 0]] = False
        if not use.any():
            use[0] = True
    out = np.zeros(x.shape[1])
    out[use] = np.maximum(w[:-1], 0)
    return out, float(w[-1])


def fit(texts: list[str], labels: list[int], landmarks: int = LANDMARKS, seed: int = 7) -> Model:
    """Train on labelled documents; their sentences are the labelled units, the sentences' segments the instances."""
    share = float(np.mean(labels)) if labels else 0.0
    if not 0 < share < 1:
        return Model(np.zeros(LETTERS ** 3, dtype=np.float32), 0.0, None, 0.0, share)
    rng = np.random.default_rng(seed)
    y = np.array(labels)
    n1, n = int(y.sum()), len(y)
    split = [tokens(t) for t in texts]
    plainly = Reader(frozenset())
    plainly.learn(split)
    held_by = Counter(w for t in split for w in {plainly.words[plainly.at[x]] for x in set(t)})
    reader = Reader(frozenset(w for w, k in held_by.items() if k > 1), pieces=False)
    del plainly, held_by
    reader.learn(split)
    index: dict[str, int] = {}
    units: list[tuple[np.ndarray, np.ndarray]] = []                   # distinct (sentence, segment) of each document
    for t in split:
        at, sentence, joined = reader.read(t)
        pairs = np.concatenate([sentence, [k for _, k in joined]]).astype(np.int64) << 32
        pairs |= np.array([index.setdefault(reader.words[i], len(index)) for i in at.tolist()]
                          + [index.setdefault(w, len(index)) for w, _ in joined], dtype=np.int64)
        pairs = np.unique(pairs)
        units.append((pairs >> 32, (pairs & 0xFFFFFFFF).astype(np.int32)))
    del split
    ids = [np.unique(words) for _, words in units]
    every = list(index)
    del index
    d1, d0 = (np.bincount(np.concatenate([i for i, label in zip(ids, labels) if label == k] or [ids[0][:0]]),
                          minlength=len(every)).astype(np.float32) for k in (1, 0))
    if not every:
        return Model(np.zeros(LETTERS ** 3, dtype=np.float32), 0.0, None, 0.0, share)
    rate = (d1 + d0) / n
    lift = (d1 - n1 * rate) / np.sqrt(n1 * rate * (1 - n1 / n) + 0.5)
    lift[d1 * (n - n1) < 4 * (d0 + 0.5) * n1] = 0
    ranked = np.argsort(-lift, kind="stable")
    anchors = ranked[:min(MAX_ANCHORS, max(12, int((lift > ANCHOR_LIFT).sum())))]
    anchors = anchors[lift[anchors] > 0]
    plain = np.flatnonzero(d0 > 0)
    marked = [every[i] for i in anchors[:landmarks // 2]]
    clean = [every[i] for i in rng.choice(plain, min(landmarks // 2, len(plain)), replace=False)]
    chosen = sorted(set(marked) | set(clean))
    values, vectors = np.linalg.eigh(kernel(chosen, chosen))
    good = values > 1e-6 * values.max(initial=0)
    root = vectors[:, good] / np.sqrt(values[good])                    # K(x, landmarks) @ root is the Nyström map
    at, code, weight = triples(chosen)
    in_toxic, in_clean = d1 / n1, d0 / (n - n1)                        # shares of documents, the costs of errors

    known, held = np.empty(0, dtype=np.int64), np.empty((0, root.shape[1]), dtype=np.float32)

    def trained(positive: np.ndarray, negative: np.ndarray) -> Model:
        nonlocal known, held
        both = np.union1d(positive, negative)
        new = np.setdiff1d(both, known)
        held = np.vstack([held, (kernel([every[i] for i in new], chosen) @ root).astype(np.float32)])
        known = np.concatenate([known, new])
        order = np.argsort(known)
        x = held[order[np.searchsorted(known[order], both)]]
        up, down = np.isin(both, positive) & (d1[both] > 0), d0[both] > 0
        # A missed positive costs the share of toxic documents that hold it; false alarms cost alike.
        cost = np.concatenate([in_toxic[both][up], np.where(up, in_clean[both] / (in_clean + in_toxic)[both], 1.0)[down]])
        side = np.concatenate([np.ones(up.sum()), -np.ones(down.sum())])
        for k in (1, -1):
            if total := cost[side == k].sum():
                cost[side == k] *= COST / total
        w = _svm(np.vstack([x[up], x[down]]), side, cost)
        table = np.bincount(code, weights=weight * (root @ w[:-1])[at], minlength=LETTERS ** 3)
        return Model(table.astype(np.float32), float(w[-1]), np.ones(2 * TOP), 0.0, share, reader.known)

    spare = rng.choice(plain, min(MAX_INSTANCES, len(plain)), replace=False)
    model = trained(anchors, spare)
    witnesses: list[list[np.ndarray]] = [[spare], [anchors]]
    for _ in range(ROUNDS):
        margin = model.margins(every)
        for words, label in zip(ids, labels):
            if len(words):
                best = words[np.argsort(-margin[words], kind="stable")[:WITNESSES]]
                if label:
                    best = best[(margin[best] > 0) & (lift[best] > WITNESS_LIFT)]
                else:
                    best = best[margin[best] > -1]
                witnesses[label].append(best)
        model = trained(np.unique(np.concatenate(witnesses[1])), np.unique(np.concatenate(witnesses[0])))
    margin = model.margins(every)
    model.slope, model.shift = _logistic(
        np.array([features(margin[words], sentence) for sentence, words in units]), y)
    return model


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAIN) -> Model:
    """Fit on the labelled documents outside the held-out fold, at most ``most`` of each class."""
    marked = (labels.filter("doc_id is not null and toxic is not null").filter(~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    mine = [marked.filter(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for k in (0, 1)]
    rows = (docs.select("doc_id", text_or_empty().alias("text"))
            .join(F.broadcast(mine[0].union(mine[1])), "doc_id")       # at most 2 * most rows of two numbers
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.max("text").alias("text"))
            .orderBy("doc_id").collect())
    return fit([r["text"] for r in rows], [r["toxic"] for r in rows])


def scorer(model: Model):
    """A function from texts to their scores, with a memo of words that is forgotten at ``MEMO``."""
    reader, margin = Reader(model.known), np.empty(0, dtype=np.float32)

    def run(texts: list[str]) -> list[float]:
        nonlocal margin
        split = [tokens(t) for t in texts]
        if len(reader.words) > MEMO:
            reader.forget()
            margin = margin[:0]
        reader.learn(split)
        margin = np.concatenate([margin, model.margins(reader.words[len(margin):])])
        found = [reader.read(t) for t in split]
        new = sorted({w for _, _, joined in found for w, _ in joined})
        of = dict(zip(new, model.margins(new).tolist()))
        return [model.score(np.concatenate([margin[at], [of[w] for w, _ in joined]]),
                            np.concatenate([sentence, [k for _, k in joined]])) for at, sentence, joined in found]
    return run


def _scores(model: Model):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = scorer(model)
        for batch in small_slices(batches, 2 << 20):
            got = scores(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(got, pa.float64())], ["row", "score"])
    return run


def score(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (doc_id) and ``score`` (0 to 1) for each row of ``docs``."""
    rows = docs.select(F.struct(*[F.col(c) for c in keep or ["doc_id"]]).alias("row"), text_or_empty().alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(_scores(model), f"row {kind}, score double").select("row.*", "score")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs``."""
    scored = score(docs, train(docs, labels))
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
