"""SimHash near-dedup by tiled exact comparison.

Fingerprints: lower-case A-Z, words [^\\x20\\x09-\\x0D]+, shingles of ``shingle`` words (repeats included; a text
with fewer words is one shingle, a text without words has fingerprint 0), XXH64 with seed 42 of each, and bit b
is set if it is set in over half of the hashes.

Links: distinct fingerprints are sorted by the population counts of their four 16-bit words and cut into tiles
of fixed size. A tile keeps the least and largest count of each word. The sum of the differences of the counts
never exceeds the bit distance, so a pair of tiles whose counts differ by more than the radius is skipped;
all others are compared exactly (numpy exclusive-or and bit count). A task emits, for each pair of tiles,
a spanning forest of the links it found, so a dense group costs as many rows as it has members.

Scale: copies collapse before any comparison. Only (doc_id, fingerprint) and tiles leave a task. The work is
quadratic in the number of distinct fingerprints, less what the counts skip. Consecutive tiles travel as numbered blocks
of up to ``BLOCK_TILES``; a pair of blocks is one piece of work, and pieces are dealt by number to a number of tasks
that follows from how many there are, so the longest task doesn't grow with the input and each fingerprint is sent
once per block it meets. Up to ``BLOCKS`` x ``BLOCK_TILES`` tiles what is sent grows as the input does.

Edge cases: null text counts as empty. A component takes its smallest non-null doc_id (null if it has none).
Repeated rows get a row each. Only ``doc_id`` and ``text`` are read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import pin, row_key, small_slices, text_or_empty
from tidepool.llm.components import connected_components

SHINGLE_WORDS = 4
MAX_BITS = 4
TILE = 4096
SEED = 42
CHUNK_WORDS = 50_000
WORDS_PER_TILE_KEY = 4
BLOCKS = 64
BLOCK_TILES = 16
TASK_TILE_PAIRS = 16
MAX_TASKS = 100_000


def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of a whole text, read in runs of words so that memory stays bounded."""
    votes, n = np.zeros(64, dtype=np.int64), 0
    rest = (text or "").encode("utf-8", "surrogatepass").lower()
    carried: list[bytes] = []
    digest = xxhash.xxh64_intdigest
    while True:
        words = rest.split(None, CHUNK_WORDS)
        rest = words.pop() if len(words) > CHUNK_WORDS else b""
        words = carried + words
        last = not rest
        if last and n == 0 and 0 < len(words) < shingle:
            hashes = [digest(b" ".join(words), SEED)]
        else:
            joined, at, ends = b" ".join(words), [0], []
            for w in words:
                ends.append(at[-1] + len(w))
                at.append(ends[-1] + 1)
            hashes = [digest(joined[a:b], SEED) for a, b in zip(at, ends[shingle - 1:])]
        if hashes:
            bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            votes += bits.sum(axis=0, dtype=np.int64)
            n += len(hashes)
        if last:
            break
        carried = words[len(words) - shingle + 1:] if shingle > 1 else []
    set_bits = np.flatnonzero(2 * votes > n)
    return int(sum(1 << int(b) for b in set_bits))


def _fingerprints(shingle: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches):
            fps = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps.view(np.int64))], ["doc_id", "fp"])
    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed 64-bit integer."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(F.col("doc_id"), text_or_empty().alias("text")).mapInArrow(
        _fingerprints(shingle), f"doc_id {kind}, fp bigint")


def _count_columns() -> list:
    """Population counts of the 16-bit words of ``fp``."""
    return [F.bit_count(F.shiftright("fp", 16 * k).bitwiseAND(F.lit(0xFFFF).cast("long"))).alias(f"c{k}")
            for k in range(WORDS_PER_TILE_KEY)]


def _boxes(fps: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The least and the largest count of each word, for every tile of ``size`` fingerprints."""
    counts = np.bitwise_count(fps.view(np.uint16).reshape(-1, WORDS_PER_TILE_KEY)).astype(np.int32)
    at = np.arange(0, len(fps), size)
    return np.minimum.reduceat(counts, at), np.maximum.reduceat(counts, at)


def _blocks(size: int):
    """Cut each sorted partition into blocks: the fingerprints, and the range of each word's count."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        held = np.empty(0, dtype=np.uint64)

        def block(fps: np.ndarray) -> pa.RecordBatch:
            lo, hi = _boxes(fps, len(fps))
            return pa.RecordBatch.from_pydict({"part": [part], "at": [at], "lo": lo.tolist(), "hi": hi.tolist(),
                                               "fps": [fps.tobytes()]}, schema=_BLOCK_ARROW)

        for batch in batches:
            held = np.concatenate([held, batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)])
            while len(held) >= size:
                yield block(held[:size])
                held, at = held[size:], at + 1
        if len(held):
            yield block(held)
    return run


_BLOCK_ARROW = pa.schema([("part", pa.int32()), ("at", pa.int64()), ("lo", pa.list_(pa.int32())),
                          ("hi", pa.list_(pa.int32())), ("fps", pa.binary())])
_BLOCK_SQL = "part int, at bigint, lo array<int>, hi array<int>, fps binary"


def _forest(a: np.ndarray, b: np.ndarray, radius: int, rows: int = 256) -> list[tuple[int, int]]:
    """A spanning forest of the links between the fingerprints of two tiles, as (larger, root) pairs.

    Of each run of rows, every row and column gives its first link to another tree until no link joins two trees,
    so a dense group is not walked link by link.
    """
    nodes, at_node = np.unique(np.concatenate([a, b]).view(np.int64), return_inverse=True)
    node_a, node_b = at_node[:len(a)], at_node[len(a):]
    parent = np.arange(len(nodes))
    for at in range(0, len(a), rows):
        i, j = np.nonzero(np.bitwise_count(a[at:at + rows, None] ^ b[None, :]) <= radius)
        x, y = node_a[at + i], node_b[j]
        while True:
            apart = parent[x] != parent[y]
            x, y = x[apart], y[apart]
            if not len(x):
                break
            first = np.union1d(np.unique(x, return_index=True)[1], np.unique(y, return_index=True)[1])
            up = parent.tolist()
            for p, q in zip(x[first].tolist(), y[first].tolist()):
                while up[p] != p:
                    p = up[p]
                while up[q] != q:
                    q = up[q]
                up[max(p, q)] = min(p, q)
            parent = np.array(up)
            while not np.array_equal(up := parent[parent], parent):
                parent = up
    linked = np.flatnonzero(parent != np.arange(len(nodes)))
    return list(zip(nodes[linked].tolist(), nodes[parent[linked]].tolist()))


def _compare(radius: int, size: int):
    """Links of pairs of blocks, which come as two rows each, one after the other."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first: tuple[int, np.ndarray] | None = None
        for batch in batches:
            for pair, fps in zip(batch.column("pair").to_pylist(), batch.column("fps")):
                y = np.frombuffer(fps.as_buffer(), dtype=np.uint64)
                if first is None:
                    first = pair, y.copy()
                    continue
                if first[0] != pair:
                    raise RuntimeError(f"pair {first[0]} has one block only")
                x, first = first[1], None
                found: list[tuple[int, int]] = []
                same = np.array_equal(x, y)
                (xl, xh), (yl, yh) = _boxes(x, size), _boxes(y, size)
                for i in range(len(xl)):
                    apart = np.maximum(0, np.maximum(yl - xh[i], xl[i] - yh)).sum(axis=1)
                    for j in np.flatnonzero(apart <= radius).tolist():
                        if not same or i <= j:
                            found += _forest(x[i * size:(i + 1) * size], y[j * size:(j + 1) * size], radius)
                yield pa.RecordBatch.from_pydict({"a": [f[0] for f in found], "b": [f[1] for f in found]},
                                                 schema=schema)
    return run


def links(distinct_fps: DataFrame, radius: int = MAX_BITS, tile: int = TILE,
          block_tiles: int = BLOCK_TILES) -> DataFrame:
    """Links (a, b) between distinct fingerprints: a spanning forest for each pair of tiles within ``radius``."""
    spark = distinct_fps.sparkSession
    counted = distinct_fps.select("fp", *_count_columns())
    order = [f"c{k}" for k in range(WORDS_PER_TILE_KEY)] + ["fp"]
    tiles = -(-distinct_fps.count() // tile)
    wide = min(max(1, -(-tiles // BLOCKS)), block_tiles)          # tiles of a block: how the work is cut
    stored = pin(counted.repartitionByRange(*order).sortWithinPartitions(*order).select("fp")
                 .mapInArrow(_blocks(tile * wide), _BLOCK_SQL), "blocks")
    starts, n = [], 0
    for part, k in sorted(map(tuple, stored.groupBy("part").count().collect())):   # a row per range partition
        starts.append((part, n))
        n += k
    offsets = spark.createDataFrame(starts, "part int, start bigint")
    blocks = (stored.join(F.broadcast(offsets), "part")
              .select((F.col("start") + F.col("at")).alias("block"), "lo", "hi", "fps"))
    boxes = blocks.select("block", "lo", "hi")
    # A block's partners follow it, up to the last one whose first word may have a count within the radius.
    last = dict(map(tuple, boxes.groupBy(F.col("lo")[0]).agg(F.max("block")).collect()))   # 17 counts at most
    reach = [max((b for c, b in last.items() if c <= top), default=-1) for top in range(16 + radius + 1)]
    ahead = F.element_at(F.array(*[F.lit(r).cast("long") for r in reach]), F.col("hi")[0] + radius + 1)
    left = boxes.select(F.col("block").alias("x"), F.col("lo").alias("xl"), F.col("hi").alias("xh"),
                        F.explode(F.sequence("block", F.greatest(ahead, "block"))).alias("y"))
    right = boxes.select(F.col("block").alias("y"), F.col("lo").alias("yl"), F.col("hi").alias("yh"))
    apart = sum((F.greatest(F.lit(0), F.col("yl")[k] - F.col("xh")[k], F.col("xl")[k] - F.col("yh")[k])
                 for k in range(WORDS_PER_TILE_KEY)), F.lit(0))
    number = F.expr("y * (y + 1) div 2 + x").alias("pair")        # place in the triangle of all pairs
    pairs = pin(left.join(right, "y").filter(apart <= radius).select("x", "y", number), "pairs")
    tasks = max(1, min(-(-pairs.count() * min(wide * wide, TASK_TILE_PAIRS) // TASK_TILE_PAIRS), MAX_TASKS))
    sides = pairs.select("pair", F.explode(F.array("x", "y")).alias("block"))
    work = (sides.join(blocks.select("block", "fps"), "block")
            .repartitionById(tasks, F.pmod("pair", F.lit(tasks)).cast("int")).sortWithinPartitions("pair", "block"))
    return work.select("pair", "fps").mapInArrow(_compare(radius, tile), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, radius: int = MAX_BITS,
                    tile: int = TILE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for each row of ``docs``."""
    prints = pin(fingerprints(docs, shingle), "fingerprints")
    firsts = pin(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fps")
    roots = pin(connected_components(links(firsts, radius, tile)), "roots")
    linked = pin(firsts.join(roots, F.col("fp") == F.col("node"), "left")
                 .select("fp", "first", F.coalesce("root", "fp").alias("root")), "linked")
    least = pin(linked.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    by_fp = pin(linked.join(least, "root").select("fp", "component_id"), "components")
    return (prints.join(by_fp, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, radius: int = MAX_BITS) -> DataFrame:
    """One row of each component with all its columns: the smallest doc_id (null last), then the smallest text digest.

    Components are told apart by their rows, so repeated or null ids keep one row each too.
    """
    key, digest = "__near_key", F.sha2(text_or_empty(), 256)
    rows = docs.select(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"),
                                digest.alias("digest")).alias("doc_id"), "text")
    kept = (near_duplicates(rows, shingle, radius).filter(F.col("doc_id") == F.col("component_id"))
            .select(row_key("doc_id.id", "doc_id.digest").alias(key)))
    keyed = docs.withColumn(key, row_key("doc_id", digest))
    return keyed.join(kept, key, "left_semi").dropDuplicates([key]).drop(key)
