"""Quality rules: counts of one text, and the frequency of its lines across the documents of its host.

Rules of one text: word, character and symbol counts, repeated lines, and words inside repeated 3-word windows;
a text fails with under ``MIN_WORDS`` words, or with over half of its words in repeated windows.

Cross-document rule: each line is normalised (lower case, white space collapsed) and hashed; the distinct
documents of a host that hold it are counted (equal texts are one document, so copies do not make their own lines
common). A line held by at least ``min_docs`` documents, however large the host is, is removed from every document but
the first (by doc_id) that holds it, and a document left with under ``min_left`` of its words is rejected. With
``max_share`` (off unless given) a line must also be held by more than that share of the host's documents.

Scale: (host, line, document) hashes are written once, combined before the exchange; the hash of the document is in the
key, so a very common line spreads over all tasks. The common lines are a table of (host, line), joined to those rows;
what is removed comes back as one row per distinct document that loses a line, with the hashes of those lines (bounded
by the document). It joins the texts by host and document in a sorted join, for which texts move once and which
splits groups of copies.

Edge cases: null text has no words and no lines. Null hosts form one host. Documents repeated with the same id
get a row each. Only doc_id, text and the host column are read; ``clean`` keeps all columns.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import pin, small_slices

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_DOCS = 20
MIN_LEFT = 0.3
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"


def _hash(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data, 42) - (1 << 63)


def line_hash(line: str) -> int | None:
    """Hash of a normalised line; None for a line without a word."""
    words = line.lower().split()
    return _hash(" ".join(words).encode("utf-8", "surrogatepass")) if words else None


def text_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    words = text.encode("utf-8", "surrogatepass").split()
    chars = len(text) - sum(text.count(c) for c in SPACES)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(windows) < len(words) - 2:
        hit = np.zeros(len(words), dtype=bool)
        for i, w in enumerate(zip(words, words[1:], words[2:])):
            if windows[w] > 1:
                hit[i:i + 3] = True
        repeated = int(hit.sum())
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated


def _line_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("host", pa.string()), ("line", pa.int64()), ("document", pa.int64()), ("doc_id", pa.int64())])
    for batch in small_slices(batches):
        out: tuple[list, ...] = ([], [], [], [])
        for host, text, doc in zip(batch.column("host").to_pylist(), batch.column("text").to_pylist(),
                                   batch.column("doc_id").to_pylist()):
            text = text or ""
            own = _hash(text.encode("utf-8", "surrogatepass"))
            for h in {None, *(line_hash(x) for x in text.split("\n"))}:
                for column, value in zip(out, (host, h, own, doc)):
                    column.append(value)
        yield pa.RecordBatch.from_pydict(dict(zip(schema.names, out)), schema=schema)


def removed_lines(docs: DataFrame, host: str = "source", min_docs: int = MIN_DOCS,
                  max_share: float | None = None) -> DataFrame:
    """host, document, gone: for each distinct document that loses lines, the hashes of those lines."""
    rows = docs.select(F.col(host).cast("string").alias("host"), F.col("text").cast("string").alias("text"),
                       F.col("doc_id").cast("bigint").alias("doc_id"))
    seen = pin(rows.mapInArrow(_line_rows, "host string, line bigint, document bigint, doc_id bigint")
               .groupBy("host", "line", "document").agg(F.min("doc_id").alias("doc_id")), "line-holders")
    # The row without a line counts the host's documents.
    counts = seen.groupBy("host", "line").agg(
        F.count(F.lit(1)).alias("n"), F.min_by("document", F.struct("doc_id", "document")).alias("first"))
    common = pin(counts.filter((F.col("n") >= min_docs) | F.col("line").isNull()), "line-counts")
    if max_share is not None:
        hosts = common.filter("line is null").select(F.col("host").alias("h"), F.col("n").alias("documents"))
        common = (common.join(hosts, F.col("host").eqNullSafe(F.col("h")))
                  .filter(F.col("n") > F.lit(max_share) * F.col("documents")))
    common = common.filter("line is not null").select(F.col("host").alias("h"), F.col("line").alias("l"), "first")
    return pin(seen.join(common, F.col("host").eqNullSafe(F.col("h")) & (F.col("line") == F.col("l")))
               .filter("document <> first")
               .groupBy("host", "document").agg(F.collect_list("line").alias("gone")), "removed-lines")


def _judge(min_left: float):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches):
            counts: list[tuple] = []
            left, cleaned = [], []
            for text, gone in zip(batch.column("__text").to_pylist(), batch.column("__gone").to_pylist()):
                whole = text or ""
                counts.append(row := text_counts(whole))
                kept_text, n_left = text, row[0]
                if gone:
                    lines = set(gone)
                    kept_text = "\n".join(x for x in whole.split("\n") if line_hash(x) not in lines)
                    n_left = len(kept_text.encode("utf-8", "surrogatepass").split())
                left.append(n_left)
                cleaned.append(kept_text)
            cols = {n: pa.array([c[k] for c in counts], pa.int64()) for k, n in enumerate(names)}
            failed = [n < MIN_WORDS or 100 * r > MAX_REPEAT_PERCENT * n for n, _, _, _, r in counts]
            kept = [not f and n >= min_left * c[0] for f, n, c in zip(failed, left, counts)]
            rest = [i for i, n in enumerate(batch.schema.names) if n not in ("__text", "__gone")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in rest]
                + [*cols.values(), pa.array(failed), pa.array(left, pa.int64()), pa.array(cleaned, pa.string()),
                   pa.array(kept)],
                [batch.schema.names[i] for i in rest] + [*cols, "base_failed", "n_left", "clean_text", "kept"])
    return run


_VERDICT = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
            "base_failed boolean, n_left bigint, clean_text string, kept boolean")


def quality_rules(docs: DataFrame, host: str = "source", carry: list[str] | None = None, min_docs: int = MIN_DOCS,
                  max_share: float | None = None, min_left: float = MIN_LEFT) -> DataFrame:
    """The columns ``carry`` (doc_id) packed in ``doc``, the counts, base_failed, n_left, clean_text and kept."""
    removed = removed_lines(docs, host, min_docs, max_share).select(F.col("host").alias("__h"), F.col("document").alias("__d"),
                                                                    F.col("gone").alias("__gone"))
    carry = carry or ["doc_id"]
    rows = docs.select(F.struct(*[F.col(c) for c in carry]).alias("doc"), F.col(host).cast("string").alias("__host"),
                       F.col("text").cast("string").alias("__text"))
    # The same hash as _hash: Spark's seed is 42 too, its sign is the highest bit.
    own = F.xxhash64(F.coalesce("__text", F.lit(""))).bitwiseXOR(F.lit(-(1 << 63)))
    # Merged at every size: one plan, whose disk grows in proportion to the texts.
    joined = (rows.join(removed.hint("merge"), F.col("__host").eqNullSafe(F.col("__h")) & (own == F.col("__d")), "left")
              .select("doc", "__text", "__gone"))
    kind = rows.schema["doc"].dataType.simpleString()
    return joined.mapInArrow(_judge(min_left), f"doc {kind}, {_VERDICT}")


def clean(docs: DataFrame, **limits) -> DataFrame:
    """The documents that the rules keep, without their removed lines; same columns (``n_chars`` follows the text)."""
    carry = [c for c in docs.columns if c not in ("text", "n_chars")] or None
    kept = quality_rules(docs, carry=carry, **limits).filter("kept")
    cols = {c: F.col(f"doc.`{c}`") for c in carry or []}
    cols["text"] = F.col("clean_text")
    if "n_chars" in docs.columns:
        cols["n_chars"] = F.length("clean_text").cast(docs.schema["n_chars"].dataType)
    return kept.select(*[cols[c].alias(c) for c in docs.columns])
