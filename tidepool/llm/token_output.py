"""Training-order materialisation of token ids as fixed-stride binary shards.

The ids of all documents, each closed by an end id, form one stream in scan order, cut into sequences of ``length``
ids (the last one is filled up with end ids). A keyed Feistel network over the next power of four, walked until it falls
below the number of sequences, permutes sequence numbers to slots: a bijection that needs no sort and no table. A shard
holds ``shard_slots`` consecutive slots, ``length`` little-endian 16-bit ids each, so slot s of the training order is
at a known file and offset, reads are sequential, and a run resumes from a slot number alone.

Scale: texts are encoded once. Each scan task stores its ids in numbered chunks; one row per scan task comes to the
driver and gives every chunk its place in the stream, so no document is joined or sorted for it. A pass over the chunks
cuts them at the sequences' edges and sends each piece to the task of its shard range by number
(``repartitionById``), which writes the shards in slot order. Shards are equal in size whatever the documents are, and a
long document is many chunks. Chunks and pieces travel compressed by zstandard; the chunks are deleted once the shards
are complete. A task that fails writes a file of another name; the manifest names the files of committed attempts only.

Edge cases: null text counts as empty and gives its end id alone. An empty table gives no shard. Repeated rows appear as
often as they occur. Only ``text`` is read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.bpe import read_ranks, vocabulary
from tidepool.llm.common import pin, shared_folder, small_slices, text_or_empty

LENGTH = 1024
SHARD_SLOTS = 8192
MAX_TASKS = 20_000
KEY = 0x5EED
ROUNDS = 6
CHUNK_IDS = 1 << 19
CHUNK_LEVEL = 6
PIECE_LEVEL = 3
ENCODED = pa.schema([("task", pa.int32()), ("at", pa.int64()), ("n", pa.int32()), ("ids", pa.binary())])


def _mixed(x: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit mix of ``x`` under ``key``."""
    x = (x + np.uint64(key & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def slots(sequences: np.ndarray, n: int, key: int = KEY, rounds: int = ROUNDS) -> np.ndarray:
    """The slots, a permutation of 0..n-1, of sequence numbers below ``n``."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    out = np.asarray(sequences, dtype=np.uint64).copy()
    walking = np.arange(len(out))
    with np.errstate(over="ignore"):
        while len(walking):
            left, right = out[walking] >> shift, out[walking] & mask
            for r in range(rounds):
                left, right = right, left ^ (_mixed(right, key * 0x100 + r) & mask)
            out[walking] = left << shift | right
            walking = walking[out[walking] >= np.uint64(n)]
    return out.astype(np.int64)


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> tiktoken.Encoding:
    ranks = {t: i for i, t in enumerate(read_ranks(path))}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _encoded(path: str, pattern: str, chunk_ids: int):
    """task, at, n, ids: the ids of a scan task's documents, each closed by the end id (the number after the last
    rank), in chunks that begin at the task's id ``at``."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _encoder(path, pattern)
        end = np.array([own.max_token_value + 1], dtype="<u2")
        pack = zstandard.ZstdCompressor(level=CHUNK_LEVEL).compress
        task, at = TaskContext.get().partitionId(), 0
        held: list[np.ndarray] = []
        n_held = 0

        def chunk(ids: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"task": task, "at": at, "n": len(ids), "ids": pack(ids.tobytes())}],
                                              schema=ENCODED)

        for batch in small_slices(batches, 1 << 20):
            for text in batch.column("text").to_pylist():
                ids = own.encode_to_numpy(text, disallowed_special=()).astype("<u2")
                held += [ids, end]
                n_held += len(ids) + 1
                if n_held >= chunk_ids:
                    ids = np.concatenate(held)
                    for k in range(0, n_held - chunk_ids + 1, chunk_ids):
                        yield chunk(ids[k:k + chunk_ids])
                        at += chunk_ids
                    held = [ids[n_held - n_held % chunk_ids:]]
                    n_held = len(held[0])
        if n_held:
            yield chunk(np.concatenate(held))
    return run


def _pieces(starts: np.ndarray, n_slots: int, length: int, key: int):
    """slot, at, ids: the parts of sequences that each stored chunk holds."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=PIECE_LEVEL).compress
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for task, at, n, packed in zip(batch.column("task").to_pylist(), batch.column("at").to_pylist(),
                                           batch.column("n").to_pylist(), batch.column("ids")):
                begin = int(starts[task]) + at
                edges = np.array([0, *range(-begin % length or length, n, length), n])
                places = begin + edges[:-1]
                ids = memoryview(unpack(packed.as_buffer()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slots(places // length, n_slots, key)), pa.array((places % length).astype(np.int32)),
                     pa.array([pack(ids[2 * a:2 * b]) for a, b in zip(edges, edges[1:])], pa.binary())],
                    ["slot", "at", "ids"])
    return run


def _write(folder: str, length: int, shard_slots: int, n_slots: int, end: int):
    stride = 2 * length
    schema = pa.schema([("shard", pa.int64()), ("path", pa.string()), ("first_slot", pa.int64()),
                        ("n_slots", pa.int64()), ("stride", pa.int32())])

    class Shard:
        """A shard being written; its slots come in order, and only the stream's last sequence may be short."""

        def __init__(self, number: int, store: fs.FileSystem, root: str):
            self.number, self.written, self.filled = number, 0, False
            self.n = min(shard_slots, n_slots - number * shard_slots)
            self.path = f"{root}/{number:08d}-{TaskContext.get().taskAttemptId()}.bin"
            self.out = store.open_output_stream(self.path, compression=None)

        def reach(self, place: int) -> None:
            """Fill up a short sequence with end ids."""
            missing = place - self.written
            if missing:
                if self.filled or place % stride or not 0 < missing < stride:
                    raise RuntimeError(f"shard {self.number}: {missing} bytes are missing before {place}")
                self.filled = True
                self.out.write(end.to_bytes(2, "little") * (missing // 2))
                self.written = place

        def add(self, slot: int, at: int, ids: bytes) -> None:
            self.reach((slot - self.number * shard_slots) * stride + 2 * at)
            self.out.write(ids)
            self.written += len(ids)

        def close(self) -> pa.RecordBatch:
            self.reach(self.n * stride)
            self.out.close()
            return pa.RecordBatch.from_pylist(
                [{"shard": self.number, "path": self.path, "first_slot": self.number * shard_slots, "n_slots": self.n,
                  "stride": stride}], schema=schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        unpack = zstandard.ZstdDecompressor().decompress
        shard: Shard | None = None
        for batch in batches:
            for slot, at, ids in zip(batch.column("slot").to_pylist(), batch.column("at").to_pylist(),
                                     batch.column("ids")):
                if shard is None or shard.number != slot // shard_slots:
                    if shard is not None:
                        yield shard.close()
                    shard = Shard(slot // shard_slots, store, root)
                shard.add(slot, at, unpack(ids.as_buffer()))
        if shard is not None:
            yield shard.close()
    return run


def materialise(docs: DataFrame, folder: str, length: int = LENGTH, shard_slots: int = SHARD_SLOTS, key: int = KEY,
                path: str | None = None, pattern: str = public_tokenizers.PATTERN,
                chunk_ids: int = CHUNK_IDS) -> DataFrame:
    """Write the shards of ``docs`` to ``folder``; the manifest: shard, path, first_slot, n_slots, stride."""
    path = path or vocabulary()
    end = len(read_ranks(path))
    if end > 0xFFFF:
        raise ValueError("ids must fit 16 bits")
    spark = docs.sparkSession
    chunks = shared_folder(spark, "token-ids")
    schema = "task int, at bigint, n int, ids binary"
    texts = docs.select(text_or_empty().alias("text"))
    texts.mapInArrow(_encoded(path, pattern, chunk_ids), schema).write.parquet(chunks)
    encoded = spark.read.schema(schema).parquet(chunks)
    counts = encoded.groupBy("task").agg(F.sum("n").alias("n")).collect()  # a row per scan task
    sizes = np.zeros(max((r["task"] for r in counts), default=-1) + 1, dtype=np.int64)
    for r in counts:
        sizes[r["task"]] = r["n"]
    starts = np.cumsum(sizes) - sizes
    n_slots = -(-int(sizes.sum()) // length)
    n_shards = -(-n_slots // shard_slots)
    tasks = max(1, min(n_shards, MAX_TASKS))
    per_task = max(1, -(-n_shards // tasks))
    pieces = encoded.mapInArrow(_pieces(starts, n_slots, length, key), "slot bigint, at int, ids binary")
    ranged = (pieces.repartitionById(tasks, F.floor(F.col("slot") / F.lit(shard_slots * per_task)).cast("int"))
              .sortWithinPartitions("slot", "at"))
    manifest = pin(ranged.mapInArrow(_write(folder, length, shard_slots, n_slots, end),
                                     "shard bigint, path string, first_slot bigint, n_slots bigint, stride int"),
                   "shards")
    store, root = fs.FileSystem.from_uri(chunks)
    store.delete_dir(root)
    return manifest


def read_slots(manifest: DataFrame, folder: str, first: int = 0) -> DataFrame:
    """slot, shard, offset, ids (binary) of every slot from ``first`` on, each shard read front to back."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                skip = max(0, first - row["first_slot"])
                with store.open_input_file(row["path"]) as f:
                    f.seek(skip * row["stride"])
                    for at in range(skip, row["n_slots"], 256):
                        k = min(256, row["n_slots"] - at)
                        data = f.read(k * row["stride"])
                        if len(data) != k * row["stride"]:
                            raise RuntimeError(f"{row['path']} is cut short")
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(range(row["first_slot"] + at, row["first_slot"] + at + k), pa.int64()),
                             pa.array([row["shard"]] * k, pa.int64()),
                             pa.array([(at + i) * row["stride"] for i in range(k)], pa.int64()),
                             pa.array([data[i * row["stride"]:(i + 1) * row["stride"]] for i in range(k)], pa.binary())],
                            ["slot", "shard", "offset", "ids"])

    wanted = manifest.filter(F.col("first_slot") + F.col("n_slots") > first)
    tasks = max(1, min(wanted.count(), MAX_TASKS))  # named: by size, the few rows of file names would be one task
    spread = wanted.repartitionById(tasks, F.pmod(F.col("shard"), F.lit(tasks)).cast("int"))
    return spread.mapInArrow(run, "slot bigint, shard bigint, offset bigint, ids binary")


def training_order(docs: DataFrame, length: int = LENGTH, shard_slots: int = SHARD_SLOTS, key: int = KEY) -> DataFrame:
    """slot, shard, offset, ids_sha256 of every sequence, read back from the shards."""
    folder = shared_folder(docs.sparkSession, "token-shards")
    manifest = materialise(docs, folder, length, shard_slots, key)
    return read_slots(manifest, folder).select("slot", "shard", "offset", F.sha2("ids", 256).alias("ids_sha256"))
