"""Secret scans: fixed patterns, and novelty against a dictionary-primed zstandard compressor.

Base kinds, leftmost non-overlapping matches each: ``assign``, ``access`` and ``hex``. The method adds ``novel``: a string of
credential characters up to ``REACH`` behind a sensitive word, or before it, is a candidate; it is compressed with a raw
dictionary made of common identifiers and of the text around it (without the candidate and its copies), and its
marginal cost is the growth of the frame over that of an empty input. Zstandard entropy-codes literals from 64 bytes
on, which tells the alphabet and not what is known, so a longer string is compressed in pieces below that, each primed
with what stands before it in the string too. A string that costs at least ``NOVELTY`` of its own length is new to both
dictionaries: names, paths and words that stand nearby in other strings compress away, random keys do not. Copies of a
string that the text calls as a function are left in: it is a name. Strings under ``SHORT`` that read as plain words
are no candidates.

Scale: one pass over whole texts without an exchange; memory per task is one slice of rows and one text.

Edge cases: null text counts as empty; an empty text has no spans. Every row gets a row, repeated ones too. Only
the asked columns and ``text`` are read. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import small_slices, text_or_empty

# The base patterns and the least length of what they must hold.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_LEAST = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 18
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "novel")

# Words after which a string may be a credential, and how far it may stand from them.
SENSITIVE_WORDS = ("password", "passwd", "passphrase", "secret", "token", "apikey", "api_key", "api-key", "credential",
                   "private_key", "private key", "access_key", "access key", "auth_key", "bearer", "authorization")
SENSITIVE = re.compile("|".join(map(re.escape, SENSITIVE_WORDS)), re.IGNORECASE | re.ASCII)
REACH = 96
LEAST = 12
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=.-]{{{LEAST},}}")
SHORT = 16
WORDS = re.compile(r"(?!.*[B-DF-HJ-NP-TV-XZb-df-hj-np-tv-xz]{5})[+/_=.-]*[A-Z]?[a-z]+(?:[+/_=.-]+[A-Z]?[a-z]+)*[+/_=.-]*")
AROUND = 512
NOVELTY = 0.8
# Literals of up to so many bytes are stored as they are; how far back a string's own text counts as known.
PIECE = 63
OWN = 4096

# The identifier dictionary: names that stand where a credential could.
IDENTIFIERS = (
    "access_token refresh_token client_secret client_id api_key apikey authorization bearer password username "
    "passwd credential credentials secret_key private_key public_key session_id request_id environment variable "
    "configuration config settings default example placeholder changeme your_api_key_here your-token-here "
    "xxxxxxxxxxxxxxxx 0000000000000000 1234567890123456 0123456789abcdef abcdefghijklmnopqrstuvwxyz "
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ localhost https://www.example.com/path/index.html application/json "
    "getElementById java.lang.String os.environ process.env self.assertEqual import return function class "
).encode()


def novelty(candidate: str, before: str, after: str) -> float:
    """Marginal compressed bytes of ``candidate`` over its length, given its surroundings and the identifiers."""
    raw = candidate.encode()
    known = IDENTIFIERS + before.encode() + b"\n" + after.encode()
    pieces = math.ceil(len(raw) / PIECE)
    cost = 0
    for k in range(pieces):
        a, b = k * len(raw) // pieces, (k + 1) * len(raw) // pieces
        primed = zstandard.ZstdCompressionDict(known + raw[max(0, a - OWN):a], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        squeeze = zstandard.ZstdCompressor(level=3, dict_data=primed, write_content_size=False, write_checksum=False,
                                           write_dict_id=False).compress
        cost += len(squeeze(raw[a:b])) - len(squeeze(b""))
    return cost / len(raw)


def surroundings(text: str, a: int, b: int) -> tuple[str, str]:
    """The text before and after the candidate at (a, b), copies of its value blanked unless it is a function's name."""
    value = text[a:b].rstrip("=").rsplit("=", 1)[-1].strip("+/_=.-") or text[a:b]
    lo, n = max(0, a - AROUND), len(value)
    far = max(0, lo - n)
    before, after = text[far:a], text[b:b + AROUND + n]
    if text[b:b + 1] != "(" and f"{value}(" not in before and f"{value}(" not in after:
        before, after = (x.replace(value, "\n" * n) for x in (before, after))
    return before[lo - far:], after[:AROUND]


def _novel(text: str, a: int, b: int) -> bool:
    if b - a < SHORT and WORDS.fullmatch(text, a, b):
        return False
    return novelty(text[a:b], *surroundings(text, a, b)) >= NOVELTY


def candidates(text: str) -> set[tuple[int, int]]:
    """Strings near sensitive words: those that start at most ``REACH`` behind one, and whole ones that end so far before one.

    A word inside a string cuts it: what follows is a candidate, behind the first and the last such word of the string. Every look is at the few strings
    within reach, so the work grows with the text.
    """
    runs = [m.span() for m in CANDIDATE.finditer(text)]
    starts, ends = [a for a, _ in runs], [b for _, b in runs]
    words = [w.span() for w in SENSITIVE.finditer(text)]
    near: set[tuple[int, int]] = set()
    cuts: dict[int, list[int]] = {}
    for _, end in words:
        k = bisect_left(starts, end)
        if k and ends[k - 1] - end >= LEAST:
            cuts.setdefault(k - 1, []).append(end)
        while k < len(runs) and starts[k] - end <= REACH:
            near.add(runs[k])
            k += 1
    near |= {(at, ends[k]) for k, of in cuts.items() for at in (of[0], of[-1])}
    # Before a word: whole strings, unless one is already a candidate from the word inside it.
    judged = {b for _, b in near}
    for start, _ in words:
        k = bisect_left(ends, start - REACH)
        while k < len(runs) and ends[k] <= start:
            if ends[k] not in judged:
                near.add(runs[k])
            k += 1
    return near


def scan(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of each span of a whole text, by start and then by kind as listed."""
    found: list[tuple[str, int, int]] = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    if any(w in low for w in SENSITIVE_WORDS):
        found += [("novel", a, b) for a, b in candidates(text) if _novel(text, a, b)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    for batch in small_slices(batches):
        spans = [[{"kind": k, "start": a, "end": b} for k, a, b in scan(t)]
                 for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(spans, span)], ["row", "spans"])


def find_secrets(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (doc_id) and ``spans``, an array of (kind, start, end), for each row of ``docs``."""
    rows = docs.select(F.struct(*[F.col(c) for c in keep or ["doc_id"]]).alias("row"), text_or_empty().alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    return (rows.mapInArrow(_scan, f"row {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>")
            .select("row.*", "spans"))


def listed(spans: list) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def base_digest(text: str) -> str:
    """The digest column for one text, as the query derives it (for tests)."""
    return hashlib.sha256(listed([s for s in scan(text) if s[0] != "novel"]).encode()).hexdigest()


def secret_report(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of the base spans, and all spans as one string."""
    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    found = find_secrets(docs)
    base = F.filter("spans", lambda s: s["kind"] != "novel")
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
