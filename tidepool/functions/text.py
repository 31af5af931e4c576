"""Text column functions: tokenising and lexicon sentiment, all native Spark expressions (no UDF)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A Unicode word: letters, digits and underscore. Java's \w is ASCII-only, so spell the classes out.
WORD_PATTERN = r"[\p{L}\p{N}_]+"

# The default English lexicon of the rule-based classifier.
DEFAULT_POSITIVE_WORDS = [
    "amazing", "brilliant", "excellent", "love", "fantastic", "great",
    "awesome", "superb", "wonderful", "outstanding", "proud", "inspiring",
    "delightful", "impressive", "best", "perfect", "thrilled", "happy",
]
DEFAULT_NEGATIVE_WORDS = [
    "terrible", "awful", "horrible", "hate", "disgusting", "worst",
    "pathetic", "shameful", "disappointing", "disaster", "corrupt",
    "failure", "useless", "toxic", "outrageous", "sad", "angry",
]


def tokenize(text: Column) -> Column:
    """Lower-case word tokens, in order, repeats kept."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), 0)


_WORD_CHAR = r"[\p{L}\p{N}_]"


def lexicon_words(text: Column, words: list[str]) -> Column:
    """The tokens of ``text`` (lower-cased, in order, with repeats) that are in ``words``.

    A whole-word match (no word character on either side) is exactly a token equal to a lexicon word, so one pass over the
    text finds them all without an array of every token.
    """
    alts = "|".join(re.escape(w) for w in sorted(set(words), key=len, reverse=True))
    return F.regexp_extract_all(F.lower(text), F.lit(f"(?<!{_WORD_CHAR})(?:{alts})(?!{_WORD_CHAR})"), 0)


def with_lexicon_sentiment(df: DataFrame, text: str, positive: list[str], negative: list[str], label: str, score: str,
                           confidence: str) -> DataFrame:
    """``df`` with the label, score and confidence of the rule-based classifier over a text column.

    pos / neg = tokens (with repeats) in the positive / negative lexicon; total = pos + neg + 1e-9.
    More positive -> ("positive", min(pos/total, 1)); more negative -> ("negative", -min(neg/total, 1));
    tie -> ("neutral", 0.05). confidence = min(|pos-neg|/total, 1). Score and confidence rounded to 4. A null text has no counts
    and is neutral.

    The words are found in a projection of their own and counted in the next: both are used more than once, so the planner leaves
    them apart and the text is read once.
    """
    words = F.col("_lexicon")
    found = df.withColumn("_lexicon", lexicon_words(F.col(text), positive + negative))
    both = found.select(*df.columns, F.size(F.filter(words, lambda w: w.isin(*positive))).alias("_pos"),
                        F.size(F.filter(words, lambda w: w.isin(*negative))).alias("_neg"))
    pos, neg = (F.when(F.col(c) >= 0, F.col(c)) for c in ("_pos", "_neg"))
    total = pos + neg + F.lit(1e-9)
    return both.select(
        *df.columns, F.when(pos > neg, "positive").when(neg > pos, "negative").otherwise("neutral").alias(label),
        F.round(F.when(pos > neg, F.least(pos / total, F.lit(1.0))).when(neg > pos, -F.least(neg / total, F.lit(1.0)))
                .otherwise(F.lit(0.05)), 4).alias(score),
        F.round(F.least(F.abs(pos - neg) / total, F.lit(1.0)), 4).alias(confidence))


def standardise_text(text: Column) -> Column:
    """Collapse whitespace runs, trim, lower-case."""
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))
