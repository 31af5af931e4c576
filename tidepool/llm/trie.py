"""Prefix trie of conversations: sorted sequences, longest common prefixes, range minima in a sparse table.

A turn is the SHA-256 of its role and text, a conversation the digests of its turns one after another, so that byte order
sorts conversations with all that share a prefix side by side. Equal sequences are one row with a count. Between sorted
neighbours stands the number of first turns they share (LCP). A node is a pair of a row and a depth over the row's own
LCP; a binary search to the right over range minima of the LCPs, held in a sparse table, finds the last row that shares that prefix, and
one to the left from the depth above finds the parent's first row. Every candidate searches by itself; nothing is carried from
one to the next. Members, smallest member, leaves and bytes of an interval are then range minima and differences of running sums.

Scale: rows are sorted by range partition, a part of them is held by one task. The LCPs between parts come from the first and last row of each part
(a row per part on the driver). A node whose interval reaches over an edge is returned in pieces, one per part, whose figures
add up; only prefixes that two neighbours share are such nodes. Copies of a sequence collapse
before the sort: their ids are packed by the hundreds beforehand, and one task hashes the packs of a sequence as a stream. A
conversation is held whole in a task, 32 bytes and a number a turn; texts are not.

Edge cases: rows without conv_id belong to no conversation and are left out; null roles and texts count as empty; turns of equal number (null
first) go by their digest, and repeated rows are turns of their own; no conversations, no nodes. Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import pin
from tidepool.operators.ranking import global_row_number

WIDTH = 32  # bytes of a turn's digest
PACK = 4096
BROADCAST_ROWS = 1_000_000
FAMILY, MOST = 5, 9
EMPTY = hashlib.sha256(b"").hexdigest()
SEQUENCE = "key binary, sizes array<long>, n long, conv_id long, ends string"
NODE = ("span binary, parent_span binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, ends string")


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, idx (place among the conversation's turns, from 1), token, size (bytes of the text) and row (place among all)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    token = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    base = pin(conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", token.alias("token"),
        F.octet_length(text).cast("long").alias("size")), "trie-turns")
    rows = global_row_number(base, ["conv_id", F.col("turn").asc_nulls_first(), "token"], out="row")
    first = rows.groupBy("conv_id").agg(F.min("row").alias("first"))
    return rows.join(first, "conv_id").select("conv_id", (F.col("row") - F.col("first") + 1).alias("idx"), "token", "size", "row")


def spliced(own: DataFrame, family: int = FAMILY, most: int = MOST) -> DataFrame:
    """The rebuilt conversations' turns, as ``turns`` gives them, and a row of idx 0 for each conversation.

    Conversation c takes the first h turns of conversation c - c % ``family`` and its own behind its first h, where h is the
    CRC-32 of the decimal c modulo ``most``.
    """
    def head(c):
        return F.crc32(c.cast("string").cast("binary")) % most

    conv = F.col("conv_id")
    kind = "array<struct<conv_id:bigint,idx:bigint,token:binary,size:bigint,row:bigint>>"
    none = F.array().cast(kind)
    row = F.struct("conv_id", "idx", "token", "size", "row")
    mark = F.struct("conv_id", F.lit(0).cast("long"), F.lit(None).cast("binary"), F.lit(0).cast("long"), "row")
    given = F.filter(
        F.transform(F.sequence(conv, conv + family - 1),
                    lambda c: F.when(F.col("idx") <= head(c), F.struct(c, "idx", "token", "size", F.lit(None).cast("long")))),
        lambda r: r.isNotNull())
    made = [F.when(on, rows.cast(kind)).otherwise(none) for on, rows in (
        (F.col("idx") > head(conv), F.array(row)), (F.col("idx") == 1, F.array(mark)),
        ((F.pmod(conv, F.lit(family)) == 0) & (F.col("idx") < most), given))]
    return own.select(F.inline(F.concat(*made)))


def sequences(rows: DataFrame) -> DataFrame:
    """Distinct sequences: key (digests of the turns), sizes, n and smallest conv_id of its conversations, digest of their ids.

    ``rows`` as ``spliced`` gives them; turns of a conversation without a row of idx 0 are left out.
    """
    whole = rows.groupBy("conv_id").agg(
        F.array_sort(F.filter(F.collect_list(F.struct("idx", "token", "size")), lambda t: t["idx"] > 0)).alias("t"),
        F.max(F.when(F.col("idx") == 0, F.col("row"))).alias("row")).where(F.col("row").isNotNull())
    key = F.unhex(F.concat_ws("", F.transform("t", lambda t: F.hex(t["token"]))))
    keyed = whole.select("conv_id", key.alias("key"), F.transform("t", lambda t: t["size"]).alias("sizes"),
                         F.floor(F.col("row") / F.lit(PACK)).cast("long").alias("pack"))
    packed = keyed.groupBy(F.sha2("key", 256).alias("id"), "pack").agg(
        F.any_value("key").alias("key"), F.any_value("sizes").alias("sizes"),
        F.array_sort(F.collect_list("conv_id")).alias("convs"))

    def stream(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per id; its packs follow one another in ascending order."""
        open_row: dict = {}

        def close() -> pa.RecordBatch:
            row = {k: open_row[k] for k in ("key", "sizes", "n", "conv_id")} | {"ends": open_row["hash"].hexdigest()}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        schema = pa.schema([("key", pa.binary()), ("sizes", pa.list_(pa.int64())), ("n", pa.int64()), ("conv_id", pa.int64()),
                            ("ends", pa.string())])
        for batch in batches:
            done = []
            for k in range(batch.num_rows):
                convs = batch.column("convs")[k].values.to_pylist()
                listed = ",".join(map(str, convs)).encode()
                if open_row.get("id") == (own := batch.column("id")[k].as_py()):
                    open_row["n"] += len(convs)
                    open_row["hash"].update(b"," + listed)
                    continue
                if open_row:
                    done.append(close())
                open_row = {"id": own, "key": batch.column("key")[k].as_py(), "sizes": batch.column("sizes")[k].as_py(),
                            "n": len(convs), "conv_id": convs[0], "hash": hashlib.sha256(listed)}
            if done:
                yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
        if open_row:
            yield close()

    return packed.repartition("id").sortWithinPartitions("id", "pack").mapInArrow(stream, SEQUENCE)


def _shared(a: bytes, b: bytes) -> int:
    """How many first turns two sequences share."""
    n = min(len(a), len(b)) // WIDTH * WIDTH
    if a[:n] == b[:n]:
        return n // WIDTH
    return int((np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)).argmax()) // WIDTH


class Minima:
    """Sparse table: the minimum of any range in two look-ups."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 << len(self.levels) - 1 <= len(values):
            half, last = 1 << len(self.levels) - 1, self.levels[-1]
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def least(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minimum over first..last, both included."""
        out = np.empty(len(first), dtype=self.levels[0].dtype)
        power = np.frexp((last - first + 1).astype(float))[1] - 1
        for k in np.unique(power):
            at = power == k
            out[at] = np.minimum(self.levels[k][first[at]], self.levels[k][last[at] - (1 << int(k)) + 1])
        return out

    def reach(self, start: np.ndarray, depth: np.ndarray, right: bool) -> np.ndarray:
        """The farthest row to the right (left) of each ``start`` with no value below ``depth`` on the way.

        Value i stands between rows i - 1 and i.
        """
        at, last = start.copy(), len(self.levels[0]) - 1
        for k in range(len(self.levels) - 1, -1, -1):
            step = 1 << k
            fits = at + step <= last if right else at - step >= 0
            place = np.where(fits, at + 1 if right else at - step + 1, 0)
            fits &= self.levels[k][np.minimum(place, len(self.levels[k]) - 1)] >= depth
            at = np.where(fits, at + step if right else at - step, at)
        return at


def _part_nodes(keys: list[bytes], sizes: list[list[int]], n: np.ndarray, conv: np.ndarray, ends: list[str], before: int,
                after: int) -> pa.Table:
    """All nodes of one part's sorted rows; ``before`` and ``after`` turns are shared with the parts around (-1: none there)."""
    m = len(keys)
    length = np.array([len(k) // WIDTH for k in keys], dtype=np.int64)
    lcp = np.array([before, *map(_shared, keys, keys[1:])], dtype=np.int64)
    minima, convs = Minima(lcp), Minima(conv)
    flat = np.zeros(int(length.sum()) + m, dtype=np.int64)  # each row's running bytes, from 0
    begin = np.concatenate([[0], np.cumsum(length + 1)])[:-1]
    inner = np.ones(len(flat), dtype=bool)
    inner[begin] = False
    flat[inner] = [x for row in sizes for x in row]
    flat = np.cumsum(flat)
    flat -= np.repeat(flat[begin], length + 1)
    total = flat[begin + length]
    new = total - flat[begin + np.maximum(lcp, 0)]

    def running(values: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(values)])

    leaf = length > np.append(lcp[1:], after)
    members, bytes_in, leaves, added = map(running, (n, n * total, leaf, new))

    least = np.concatenate([[0], lcp[1:] + 1])  # the first row also has those prefixes that began before it
    count = length - least + 1
    offset = np.concatenate([[0], np.cumsum(count)])[:-1]
    i = np.repeat(np.arange(m), count)
    d = np.arange(len(i)) - np.repeat(offset - least, count)
    r = minima.reach(i, d, right=True)
    starts = (i > 0) | (d > before)
    has_parent = d > 0
    above = np.maximum(d - 1, 0)
    first = minima.reach(i, above, right=False)
    parent = offset[first] + above - least[first]

    n_convs = members[r + 1] - members[i]
    passed = flat[begin[i] + above]
    own = np.where(starts, total[i] - passed, new[i])
    saved = bytes_in[r + 1] - bytes_in[i] - n_convs * passed - own - (added[r + 1] - added[i + 1])
    children = np.bincount(parent[has_parent & starts], minlength=len(i))
    smallest = convs.least(i, r)
    spans = ~starts | ((r == m - 1) & (d <= after))

    names: list[bytes | None] = [None] * len(i)
    for k in np.flatnonzero(spans).tolist():
        names[k] = hashlib.sha256(keys[i[k]][:WIDTH * int(d[k])]).digest()
    name = pa.array(names, pa.binary())
    whole = d == length[i]
    listed = [ends[a] if w else None for a, w in zip(i.tolist(), whole.tolist())]
    parents = pa.array(np.where(has_parent, parent, 0), mask=~has_parent)
    return pa.table({
        "span": name, "parent_span": name.take(parents), "conv_id": smallest, "depth": d,
        "parent_conv_id": pa.array(smallest).take(parents), "n_convs": n_convs, "n_children": children.astype(np.int64),
        "n_leaves": leaves[r + 1] - leaves[i], "saved_tokens": saved, "ends": pa.array(listed, pa.string())})


def nodes(found: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of the trie of ``sequences``."""
    parts = pin(found.repartitionByRange("key").sortWithinPartitions("key").withColumn("part", F.spark_partition_id()), "trie-parts")
    edges = sorted(parts.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last")).collect())  # a row per part
    shared = [-1, *(_shared(bytes(a["last"]), bytes(b["first"])) for a, b in zip(edges, edges[1:])), -1]
    around = {e["part"]: (shared[k], shared[k + 1]) for k, e in enumerate(edges)}

    def search(rows: pa.Table) -> pa.Table:
        keys = rows["key"].to_pylist()
        order = sorted(range(len(keys)), key=keys.__getitem__)
        rows = rows.take(pa.array(order, pa.int64()))
        return _part_nodes([keys[k] for k in order], rows["sizes"].to_pylist(), rows["n"].to_numpy(), rows["conv_id"].to_numpy(),
                           rows["ends"].to_pylist(), *around[rows["part"][0].as_py()])

    every = pin(parts.groupBy("part").applyInArrow(search, NODE), "trie-nodes")
    pieces = every.where(F.col("span").isNotNull()).groupBy("span").agg(
        F.any_value("parent_span").alias("parent_span"), F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")], F.max("ends").alias("ends"))
    joined = pin(pieces, "trie-spans")
    lookup = joined.select(F.col("span").alias("parent_span"), F.col("conv_id").alias("above"))
    lookup = F.broadcast(lookup) if joined.count() <= BROADCAST_ROWS else lookup
    both = every.where(F.col("span").isNull()).unionByName(joined).join(lookup, "parent_span", "left")
    return both.select("conv_id", "depth", F.coalesce("above", "parent_conv_id").alias("parent_conv_id"), "n_convs", "n_children",
                       "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(EMPTY)).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The nodes of all rebuilt conversations."""
    return nodes(sequences(spliced(turns(conversations))))
