"""Mixing sources to target weights by Pareto order sampling.

A document's size is its number of words. Sources in code-point order (null last) weigh 5, 2, 1, repeating; their
targets share the corpus' size by weight and stop at ``cap`` times the source's size, the excess reshared.

Every document of a source gets the whole copies its target allows, floor(target / size of the source), for
certain. The remainder is a sample of fixed size (in words): each document has a random u (from the md5 of seed
and doc_id), and documents are ranked by odds(u) / odds(p). The inclusion odds odds(p) are those of the remaining
fraction times (size / mean size) ** 0.5: inclusion is unequal, a longer document is likelier. The ranking is
cut where the words taken come nearest to the remainder. Documents above ``grain`` of the remainder are cut
first, on their own; the rest is then cut at what they leave, so one long document cannot miss the target.

Scale: nothing is sorted as a whole. The rank is mapped to 256 bins and those to 256 again; words are summed
by (source, bin) with map-side sums, and only the rows of the one bin where a source's target falls are ordered. Decisions come back as
one row per source, so applying them needs no exchange of the documents; a hot source is never one task's.

Edge cases: null text has size 0 and is never sampled (it gets the whole copies). Null sources form one source.
Rows that repeat a doc_id (or have none) share one draw, so equal rows are taken or left together. A
corpus without words takes nothing. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.common import WORD, pin, text_or_empty

WEIGHTS = (5, 2, 1)
CAP = 3
GRAIN = 0.05
BINS = 1 << 16
SEED = "mix-1"


def words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def _id(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("string"), F.lit(""))


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, id, source, size of each row."""
    return docs.select("doc_id", _id(F.col("doc_id")).alias("id"), F.col("source").cast("string").alias("source"),
                       words(text_or_empty()).alias("size"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row per source: key, source, source_size, n, target, copies (certain ones), rest (words to sample)."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"),
                                      F.count(F.when(F.col("size") > 0, 1)).alias("n"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (turn + 1).cast("int"))
    per = pin(per.withColumn("weight", weight), "sources")  # one row per source
    # Sources in the order in which they reach their cap; the share of a unit of weight is the largest level met.
    by_cap = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    capped = F.coalesce(F.sum(F.col("source_size") * cap).over(by_cap.rowsBetween(Window.unboundedPreceding, -1)),
                        F.lit(0))
    left = F.sum("weight").over(by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = (F.sum("source_size").over(every) - capped).cast("double") / left
    per = per.withColumn("level", level)
    most = (F.col("source_size") * cap).cast("double")
    per = per.withColumn("target", F.least(most, F.max("level").over(every) * F.col("weight")))
    copies = (F.when(F.col("target") >= most, F.lit(cap))
              .otherwise(F.floor(F.col("target") / F.col("source_size"))).cast("long"))
    return (per.withColumn("copies", F.when(F.col("source_size") > 0, copies).otherwise(F.lit(0).cast("long")))
            .withColumn("rest", F.col("target") - F.col("copies") * F.col("source_size"))
            .select("source", "source_size", "n", "target", "copies", "rest"))


def _ranked(rows: DataFrame, per_source: DataFrame, seed: str, grain: float) -> DataFrame:
    """``rows`` with their source's columns, ``large``, and the rank v in (0, 1) with its bin."""
    known = per_source.withColumnRenamed("source", "__s")
    out = (rows.withColumn("__key", F.coalesce("source", F.lit(""))).withColumn("__none", F.col("source").isNull())
           .join(known.withColumn("__key", F.coalesce("__s", F.lit(""))).withColumn("__none", F.col("__s").isNull()),
                 ["__key", "__none"]).drop("__key", "__none", "__s"))
    u = ((F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.col("id"))), 1, 13), 16, 10).cast("double") + 0.5)
         / F.lit(float(1 << 52)))
    share = F.col("rest") / F.col("source_size")
    odds_p = share / (1 - share) * F.sqrt(F.col("size").cast("double") * F.col("n") / F.col("source_size"))
    q = u / (1 - u) / odds_p
    open_ = (F.col("rest") > 0) & (F.col("size") > 0)
    return (out.withColumn("large", F.col("size") > F.lit(grain) * F.col("rest"))
            .withColumn("v", F.when(open_, q / (1 + q)))
            .withColumn("bin", F.least(F.floor(F.col("v") * BINS), F.lit(BINS - 1)).cast("int")))


def _cut(ranked: DataFrame, quota: DataFrame, label: str) -> DataFrame:
    """Where each source's ranking is cut: source, bin, v, id, got (words taken); ``quota``: source, quota.

    Rows before ``bin``, and those of ``bin`` up to (v, id), are taken. Without a crossing ``bin`` is BINS.
    """
    def with_quota(df: DataFrame) -> DataFrame:
        q = quota.withColumnRenamed("source", "__s")
        return df.join(q, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")

    def crossing(rows: DataFrame, bin_: Column, label: str) -> DataFrame:
        """For each source the bin in which its quota falls, and the words before it; one row per source."""
        along = Window.partitionBy("source").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)  # at most 256 rows
        bins = (rows.groupBy("source", "before", "quota", bin_.alias("b")).agg(F.sum("size").alias("words"))
                .withColumn("through", F.col("before") + F.sum("words").over(along)))
        return pin(bins.groupBy("source", "quota").agg(
            F.min(F.when(F.col("through") > F.col("quota"),
                         F.struct("b", (F.col("through") - F.col("words")).alias("before")))).alias("at"),
            F.max("through").alias("all")), f"{label}-bins")

    def within(rows: DataFrame, cross: DataFrame, bin_: Column) -> DataFrame:
        at = cross.filter("at is not null").select(F.col("source").alias("__s"), F.col("at.b").alias("__b"),
                                                   F.col("at.before").alias("before"), "quota")
        return (rows.drop("before", "quota").join(at, F.col("source").eqNullSafe(F.col("__s")) & (bin_ == F.col("__b")))
                .drop("__s", "__b"))

    rows = with_quota(ranked.filter("v is not null").select("source", "bin", "v", "id", "size")
                      .withColumn("before", F.lit(0).cast("long")))
    coarse, fine_bin = F.shiftright("bin", 8), F.col("bin")
    outer = crossing(rows, coarse, f"{label}-coarse")
    rows = within(rows, outer, coarse)
    cross = crossing(rows, fine_bin, label)
    inside = (within(rows, cross, fine_bin)
              .groupBy("source", "v", "id", "before", "quota").agg(F.sum("size").alias("words")))
    fine = Window.partitionBy("source").orderBy("v", "id").rowsBetween(Window.unboundedPreceding, 0)
    taken = (inside.withColumn("through", F.col("before") + F.sum("words").over(fine))
             .filter(2 * F.col("through") - F.col("words") <= 2 * F.col("quota"))
             .groupBy("source").agg(F.max(F.struct("v", "id")).alias("last"), F.max("through").alias("got"))
             .withColumnRenamed("source", "__s"))
    found = (cross.join(taken, F.col("source").eqNullSafe(F.col("__s")), "left").select(
        F.col("source").alias("__f"), F.col("at.b").alias("b"), "last", F.coalesce("got", "at.before").alias("got")))
    return (outer.join(found, F.col("source").eqNullSafe(F.col("__f")), "left")
            .select("source", F.coalesce("b", F.lit(BINS)).alias("bin"), F.col("last.v").alias("v"),
                    F.col("last.id").alias("id"), F.coalesce("got", "all").alias("got")))


def decisions(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: str = SEED,
              grain: float = GRAIN) -> DataFrame:
    """One row per source: its targets and the two cuts of its ranking. ``sizes`` must be a written table."""
    per = pin(targets(sizes, weights, cap), "targets")
    ranked = _ranked(sizes, per, seed, grain)
    large = ranked.filter("large and v is not null")
    quota = large.groupBy("source", "rest", "source_size").agg(F.sum("size").alias("w")).select(
        "source", (F.col("rest") / F.col("source_size") * F.col("w")).alias("quota"))
    first = pin(_cut(large, pin(quota, "large-quota"), "large"), "large-cut")
    one = first.select(F.col("source").alias("__s"), F.struct("bin", "v", "id").alias("large_cut"), "got")
    per = pin(per.join(one, F.col("source").eqNullSafe(F.col("__s")), "left").drop("__s")
              .withColumn("quota", F.greatest(F.col("rest") - F.coalesce("got", F.lit(0)), F.lit(0.0))), "quotas")
    second = pin(_cut(ranked.filter("not large"), per.select("source", "quota"), "small"), "small-cut")
    two = second.select(F.col("source").alias("__s"), F.struct("bin", "v", "id").alias("small_cut"))
    return pin(per.join(two, F.col("source").eqNullSafe(F.col("__s")), "left")
               .select("source", "source_size", "n", "target", "copies", "rest", "large_cut", "small_cut"), "decisions")


def with_copies(rows: DataFrame, decided: DataFrame, seed: str = SEED, grain: float = GRAIN) -> DataFrame:
    """``rows`` (id, source, size and more) with ``taken_copies``: how often each is taken."""
    cut = F.when(F.col("large"), F.col("large_cut")).otherwise(F.col("small_cut"))
    ahead = (F.col("bin") < cut["bin"]) | ((F.col("bin") == cut["bin"]) & (
        (F.col("v") < cut["v"]) | ((F.col("v") == cut["v"]) & (F.col("id") <= cut["id"]))))
    return (_ranked(rows, decided, seed, grain)
            .withColumn("taken_copies", F.col("copies") + F.when(F.coalesce(ahead, F.lit(False)), 1).otherwise(0)))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target, copies, taken (words, repeats counted) of each row of ``docs``."""
    sizes = pin(sized(docs), "sizes")
    return (with_copies(sizes, decisions(sizes, weights, cap, seed), seed)
            .select("doc_id", "size", "source_size", "target", F.col("taken_copies").alias("copies"),
                    (F.col("size") * F.col("taken_copies")).alias("taken")))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """The documents of the mix with all their columns, a document taken twice as two rows."""
    decided = decisions(pin(sized(docs), "sizes"), weights, cap, seed)
    packed = docs.select(F.struct("*").alias("doc"), _id(F.col("doc_id")).alias("id"),
                         F.col("source").cast("string").alias("source"), words(text_or_empty()).alias("size"))
    return (with_copies(packed, decided, seed).filter("taken_copies > 0")
            .select("doc", F.explode(F.array_repeat(F.lit(0), F.col("taken_copies").cast("int"))).alias("copy"))
            .select("doc.*"))
