"""Global (unpartitioned) ranking windows without a single-partition exchange.

``rank() over (order by x)`` with no PARTITION BY plans ``Exchange SinglePartition``: one task sorts the
whole table. Here the table is range-partitioned on the full ordering (value plus a unique tie-break, so a
value held by a third of all rows is still spread over many partitions), sorted inside each partition and
checkpointed to the shared checkpoint folder. After the checkpoint every partition's content and order are
fixed files, so a per-partition row count (a table with one row per partition) gives each partition its
offset, and the global row number is ``offset + position in partition``. Rank and ntile derive from it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.session import ensure_checkpoint_dir

_PID, _MID = "_pid", "_mid"


def _order_cols(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def global_row_number(df: DataFrame, order: Sequence[Column | str], out: str = "rn",
                      num_partitions: int | None = None, total_out: str | None = None) -> DataFrame:
    """1-based row number over the whole DataFrame in ``order`` (which should be a total order).

    ``total_out`` also attaches the table's row count, taken from the same per-partition counts.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    cols = _order_cols(order)
    ranged = df.repartitionByRange(num_partitions, *cols) if num_partitions else df.repartitionByRange(*cols)
    # Reliable checkpoint: cuts lineage and pins partition contents, so ids below survive executor loss.
    pinned = ranged.sortWithinPartitions(*cols).checkpoint(eager=True)
    tagged = pinned.select("*", F.spark_partition_id().alias(_PID), F.monotonically_increasing_id().alias(_MID))
    # One row per partition (bounded by the partition count): prefix sums on a tiny table.
    counts = tagged.groupBy(_PID).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        _PID,
        (F.coalesce(F.sum("_n").over(Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)),
                    F.lit(0))).alias("_off"),
        F.sum("_n").over(Window.partitionBy(F.lit(1))).alias("_total"))
    j = tagged.join(F.broadcast(offsets), _PID)
    local = F.col(_MID) - F.shiftleft(F.col(_PID).cast("bigint"), 33)
    j = j.withColumn(out, F.col("_off") + local + 1)
    drop = [_PID, _MID, "_off"]
    if total_out and total_out != "_total":
        j = j.withColumnRenamed("_total", total_out)
    elif not total_out:
        drop.append("_total")
    return j.drop(*drop)


def global_rank(df: DataFrame, value: str, descending: bool = True, tiebreak: Sequence[str] = (),
                out: str = "rank") -> DataFrame:
    """SQL RANK() over the whole table: 1 + number of rows strictly ahead; ties share a rank, gaps follow.

    The rank is the position at which the run of a value starts. Rows are sorted over range partitions; inside one, a
    running maximum carries the start of the current run, and a run that began in an earlier partition takes its
    start from a table with one row per partition. No join on the value, so a value that a third of all rows hold costs no more.
    """
    v = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    order = [v] + [F.col(c).asc() for c in tiebreak]
    pinned = df.repartitionByRange(*order).sortWithinPartitions(*order).checkpoint(eager=True)
    tagged = pinned.select("*", F.spark_partition_id().alias(_PID), F.monotonically_increasing_id().alias(_MID))
    local = F.col(_MID) - F.shiftleft(F.col(_PID).cast("bigint"), 33) + 1
    inside = Window.partitionBy(_PID).orderBy(_MID)  # one range partition, balanced by the range sort
    starts = (F.col("_pos") == 1) | ~F.col(value).eqNullSafe(F.lag(value).over(inside))
    runs = (tagged.withColumn("_pos", local).withColumn("_new", F.when(starts, F.col("_pos")))
            .withColumn("_run", F.max("_new").over(inside.rowsBetween(Window.unboundedPreceding, 0))))
    ends = tagged.withColumn("_pos", local).groupBy(_PID).agg(
        F.count(F.lit(1)).alias("_n"), F.min_by(F.struct(value), "_pos").alias("_first"),
        F.max_by(F.struct(value), "_pos").alias("_last"))
    # One row per partition: its offset, and where a run that reaches into it began.
    by_part = Window.orderBy(_PID)
    before = by_part.rowsBetween(Window.unboundedPreceding, -1)
    held = (tagged.join(F.broadcast(ends.select(_PID, "_last")), _PID)
            .where(F.struct(value).eqNullSafe(F.col("_last"))).groupBy(_PID).agg(F.min(local).alias("_tail")))
    parts = (ends.join(held, _PID)
             .withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
             .withColumn("_cont", F.coalesce(F.col("_first").eqNullSafe(F.lag("_last").over(by_part))
                                             & (F.lag("_n").over(by_part) > 0), F.lit(False)))
             .withColumn("_began", F.when(~(F.col("_cont") & (F.col("_tail") == 1)), F.col("_off") + F.col("_tail")))
             .withColumn("_from", F.when(F.col("_cont"), F.last("_began", ignorenulls=True).over(before)))
             .select(_PID, "_off", "_from"))
    ranked = runs.join(F.broadcast(parts), _PID)
    rank = F.when((F.col("_run") == 1) & F.col("_from").isNotNull(), F.col("_from")).otherwise(F.col("_off") + F.col("_run"))
    return ranked.withColumn(out, rank).drop(_PID, _MID, "_pos", "_new", "_run", "_off", "_from")


def ntile_of(rn: Column, total: Column, n: int) -> Column:
    """NTILE(n) bucket of 1-based row ``rn`` among ``total`` rows (first ``total % n`` tiles get one extra)."""
    s = F.floor(total / F.lit(n)).cast("bigint")
    r = (total % F.lit(n)).cast("bigint")
    big = r * (s + 1)
    return (F.when(rn <= big, F.ceil(rn / (s + 1)))
            .otherwise(r + F.ceil((rn - big) / F.when(s == 0, F.lit(None)).otherwise(s)))).cast("bigint")


def global_ntile(df: DataFrame, n: int, order: Sequence[Column | str], out: str = "ntile") -> DataFrame:
    """SQL NTILE(n) over the whole table in ``order`` (needs a total order to be deterministic)."""
    numbered = global_row_number(df, order, out="_rn", total_out="_total")
    return numbered.withColumn(out, ntile_of(F.col("_rn"), F.col("_total"), n)).drop("_rn", "_total")


def trailing_mean_global(df: DataFrame, value: str, order: Sequence[Column | str], width: int,
                         partition_by: Sequence[str] = (), bucket_rows: int = 1 << 16,
                         out: str = "trailing_mean", count_out: str = "trailing_count") -> DataFrame:
    """Mean and count of the last ``width`` rows (current included) in ``order``, per ``partition_by`` key.

    Rows get a global row number i over (keys, order) and go to bucket ``i div B``; the last ``width-1``
    rows of a bucket are copied into the next bucket as a halo, the window runs per (bucket, key), and
    only home rows are kept. Every bucket holds at most B + width - 1 rows, so a key holding a third of
    all rows is still spread over many tasks.
    """
    if bucket_rows < width:
        raise ValueError("bucket_rows must be at least the window width")
    keys = [F.col(k) for k in partition_by]
    numbered = global_row_number(df, keys + _order_cols(order), out="_i").withColumn("_i", F.col("_i") - 1)
    b = F.floor(F.col("_i") / F.lit(bucket_rows)).cast("bigint")
    halo = (F.col("_i") % bucket_rows) >= (bucket_rows - (width - 1))
    spread = numbered.withColumn("_home", b).withColumn(
        "_b", F.explode(F.when(halo, F.array(b, b + 1)).otherwise(F.array(b))))
    w = Window.partitionBy("_b", *partition_by).orderBy("_i").rowsBetween(-(width - 1), 0)
    r = (spread.withColumn(out, F.avg(value).over(w))
               .withColumn(count_out, F.count(F.lit(1)).over(w))
               .where(F.col("_b") == F.col("_home")))
    return r.drop("_b", "_home")


def global_cumsum(df: DataFrame, order: Sequence[Column | str], weight: str, out: str = "cum") -> DataFrame:
    """Inclusive running sum of ``weight`` over one global order (order should be total).

    Range-partitioned and checkpointed like ``global_row_number``; per-partition sums (one row per
    partition) give offsets, and the in-partition running sum is a window over the partition id, whose
    partitions are the balanced range partitions themselves.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    cols = _order_cols(order)
    pinned = df.repartitionByRange(*cols).sortWithinPartitions(*cols).checkpoint(eager=True)
    tagged = pinned.withColumn(_PID, F.spark_partition_id())
    sums = tagged.groupBy(_PID).agg(F.sum(weight).alias("_s"))
    offsets = sums.select(_PID, F.coalesce(
        F.sum("_s").over(Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    w = Window.partitionBy(_PID).orderBy(*cols).rowsBetween(Window.unboundedPreceding, 0)
    r = tagged.withColumn(out, F.sum(weight).over(w)).join(F.broadcast(offsets), _PID)
    return r.withColumn(out, F.col(out) + F.col("_off")).drop(_PID, "_off")
