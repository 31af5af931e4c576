"""WARC archives: whole-file gzip streams, their normaliser, and reads through the offset index.

``write_archives`` writes one gzip stream per archive, many records in one member (a monolithic archive).
``normalise`` inflates each such stream once, front to back, rewrites every record as its own gzip member, and writes a
sidecar index (JSON lines: offset and length of each member). ``read_archives`` follows the index.

Of records with equal payloads of at least ``MIN_REVISIT`` bytes, the one with the largest page_id is a response
and the others are revisits without a payload.

Scale: an archive is written by one task and rolls over at ``ROLL_BYTES`` of records, so neither files nor memory grow with a
partition; a record is the most that is held at once. A file's name carries its task attempt and only files that a
committed attempt reported are read on, so a lost executor leaves at most an orphan. Files are reached through
``pyarrow.fs`` from the folder in ``spark.checkpoint.dir``, which all machines share. Equal payloads meet as digests with
map-side maxima.

Edge cases: null html is the empty payload; null urls leave out the target; null page_ids are smaller than any
other and come back as null. Rows that repeat the largest page_id of their group are all responses. An empty
table writes no archive and reads back no row. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import pin, shared_folder, small_slices

MIN_REVISIT = 1000
ROLL_BYTES = 256 << 20
LEVEL = 4
DATE = "1970-01-01T00:00:00Z"
CRLF = b"\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def plan_records(pages: DataFrame, least: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, payload (binary) and refers_to (null for responses) of each row of ``pages``."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                        html.cast("binary").alias("payload"))
    sums = rows.select("page_id", F.length("payload").alias("bytes"), F.sha2("payload", 256).alias("sum"))
    groups = pin(sums.filter(F.col("bytes") >= least).groupBy("sum")
                 .agg(F.max("page_id").alias("largest"), F.count(F.lit(1)).alias("n")).filter("n > 1")
                 .select("sum", "largest"), "warc-groups")
    own = F.when(F.length("payload") >= least, F.sha2("payload", 256))
    return (rows.withColumn("sum", own).join(groups, "sum", "left")
            .select("page_id", "url", "payload",
                    F.when(~F.col("page_id").eqNullSafe(F.col("largest")), F.col("largest")).alias("refers_to")))


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _from_urn(urn: str | None) -> int | None:
    return int(urn[len("<urn:page:"):-1]) if urn and urn != _urn(None) else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC/1.1 record with its two closing line ends."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if refers_to is None else http
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + CRLF * 2 + block + CRLF * 2


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of one record."""
    head, _, rest = raw.partition(CRLF * 2)
    lines = head.decode("utf-8", "surrogateescape").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    return fields, rest[:int(fields["content-length"])]


def inflated(stream, size: int = 1 << 20) -> Iterator[bytes]:
    """The inflated bytes of a gzip file of one or several members, read once."""
    one = zlib.decompressobj(31)
    while data := stream.read(size):
        while data:
            if out := one.decompress(data, 4 * size):
                yield out
            data = one.unconsumed_tail
            if one.eof:
                data, one = one.unused_data, zlib.decompressobj(31)


def records(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """Whole records of an inflated WARC stream; holds one record and one chunk."""
    held = bytearray()
    need = None
    for chunk in chunks:
        held += chunk
        while True:
            if need is None:
                at = held.find(CRLF * 2)
                if at < 0:
                    break
                length = next(int(x[15:]) for x in bytes(held[:at]).split(CRLF) if x.lower().startswith(b"content-length:"))
                need = at + 4 + length + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = None
    if held.strip():
        raise ValueError("the archive ends inside a record")


class _Files:
    """New files of this task attempt in a shared folder."""

    def __init__(self, folder: str):
        self.at, self.root = fs.FileSystem.from_uri(folder)
        self.at.create_dir(self.root, recursive=True)
        task = TaskContext.get()
        self.stem = f"{task.partitionId():06d}-{task.taskAttemptId()}"
        self.n = 0

    def new(self):
        name = f"{self.root}/{self.stem}-{self.n:04d}.warc.gz"
        self.n += 1
        return name, self.at.open_output_stream(name, compression=None)


def _write(folder: str, level: int, roll: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, name, out, packer, raw, n = None, None, None, None, 0, 0

        def closed() -> pa.RecordBatch:
            out.write(packer.flush())
            out.close()
            return pa.RecordBatch.from_pydict({"archive": [name], "n_records": [n], "raw_bytes": [raw]})

        for batch in small_slices(batches):
            for row in batch.to_pylist():
                if out is None:
                    files = files or _Files(folder)
                    name, out = files.new()
                    packer, raw, n = zlib.compressobj(level, zlib.DEFLATED, 31), 0, 0
                data = record(row["page_id"], row["url"], row["payload"], row["refers_to"])
                out.write(packer.compress(data))
                raw, n = raw + len(data), n + 1
                if raw >= roll:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()
    return run


def write_archives(planned: DataFrame, folder: str, level: int = LEVEL, roll: int = ROLL_BYTES) -> DataFrame:
    """Write ``planned`` (see ``plan_records``) as monolithic archives; archive, n_records, raw_bytes of each."""
    return pin(planned.mapInArrow(_write(folder, level, roll), "archive string, n_records bigint, raw_bytes bigint"),
               "warc-archives")


def _normalise(folder: str, level: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = None
        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                files = files or _Files(folder)
                name, out = files.new()
                offset, n = 0, 0
                with out, files.at.open_input_stream(archive, compression=None) as source, \
                        files.at.open_output_stream(f"{name}.index.json", compression=None) as index:
                    for raw in records(inflated(source)):
                        packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                        member = packer.compress(raw) + packer.flush()
                        out.write(member)
                        fields, _ = parse(raw)
                        line = {"archive": name, "offset": offset, "length": len(member),
                                "record_type": fields["warc-type"], "page_id": _from_urn(fields["warc-record-id"])}
                        index.write(json.dumps(line).encode() + b"\n")
                        offset, n = offset + len(member), n + 1
                yield pa.RecordBatch.from_pydict(
                    {"archive": [name], "index": [f"{name}.index.json"], "n_records": [n], "bytes": [offset]})
    return run


def normalise(archives: DataFrame, folder: str, level: int = LEVEL) -> DataFrame:
    """Rewrite each archive record by record; archive, index, n_records, bytes of each new file."""
    tasks = max(1, 4 * archives.count())  # a number of its own, or the few names would be merged into one task
    spread = archives.select("archive").repartition(tasks, "archive")
    return pin(spread.mapInArrow(_normalise(folder, level), "archive string, index string, n_records bigint, bytes bigint"),
               "warc-normalised")


_INDEX = "archive string, offset bigint, length bigint, record_type string, page_id bigint"
_READ = "page_id bigint, record_type string, refers_to bigint, payload binary, payload_digest string"


def read_index(normalised: DataFrame, folder: str) -> DataFrame:
    """The sidecar indexes of the committed archives, in file order; files of failed attempts are left out."""
    index = normalised.sparkSession.read.schema(_INDEX).json(f"{folder}/*.index.json")
    return (index.join(normalised.select("archive"), "archive", "left_semi")
            .sortWithinPartitions("archive", "offset"))


def _read(folder: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        schema = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                            ("payload", pa.binary()), ("payload_digest", pa.string())])
        name, opened = None, None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = []
                for entry in batch.slice(at, 256).to_pylist():
                    if entry["archive"] != name:
                        name, opened = entry["archive"], store.open_input_file(entry["archive"])
                    opened.seek(entry["offset"])
                    fields, block = parse(zlib.decompress(opened.read(entry["length"]), 31))
                    kind = fields["warc-type"]
                    payload = block.partition(CRLF * 2)[2] if kind == "response" else None
                    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                    if payload is not None and hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"digest of {fields['warc-record-id']} in {name} does not hold")
                    rows.append({"page_id": _from_urn(fields["warc-record-id"]), "record_type": kind,
                                 "refers_to": _from_urn(fields.get("warc-refers-to")), "payload": payload,
                                 "payload_digest": digest})
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
    return run


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """page_id, record_type, refers_to, payload (null for revisits), payload_digest of each record of an index."""
    return index.mapInArrow(_read(folder), _READ)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write, normalise and read back; a revisit's payload is that of the response it refers to, by id and digest."""
    spark = pages.sparkSession
    whole, single = shared_folder(spark, "warc-whole"), shared_folder(spark, "warc-single")
    new = normalise(write_archives(plan_records(pages), whole), single)
    if new.isEmpty():
        return spark.createDataFrame([], "page_id bigint, payload_bytes bigint, payload_digest string, "
                                         "record_type string, refers_to bigint")
    back = pin(read_archives(read_index(new, single), single)
               .withColumn("payload_bytes", F.length("payload").cast("long")).drop("payload"), "warc-read")
    used = pin(back.filter("record_type = 'response'")
               .groupBy(F.col("page_id").alias("refers_to"), "payload_digest")
               .agg(F.max("payload_bytes").alias("full_bytes")), "warc-responses")
    return (back.join(used, ["refers_to", "payload_digest"], "left")
            .select("page_id", F.coalesce("payload_bytes", "full_bytes").alias("payload_bytes"), "payload_digest",
                    "record_type", "refers_to"))
