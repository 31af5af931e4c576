"""Merkle manifest of a dataset: a tree over the rows of each group, one tree over the groups, and inclusion proofs.

Only every ``stride``-th level of a tree is stored (a band: one row per node). Above it, a node of the next band closes an aligned
subtree of ``fanout ** stride`` stored nodes. Extracting proofs walks the bands from the root down: the subtree below each node of a
band is regenerated in memory from its stored descendants, every stored node gets the siblings on its way up (those of the
subtree, then the path of the subtree's own node), and the interior nodes are discarded.

Digests are lowercase hex SHA-256; a node's digest is that of its children's digests as hex text, one after another. A run of
fewer children than ``fanout``, even of one, is a node all the same, until one node remains.

Scale: places within a group come from one range sort of narrow rows (digests, never texts), so a group that holds most rows is
many tasks; a subtree is one row of bounded size. Paths of upper levels travel once per subtree, not once per row. What the driver
learns is the largest group's size and the root.

Edge cases: a null counts as ``-`` and so differs from an empty text; rows without a key come first in their group; rows of equal keys
follow their leaf digest, and repeated rows are leaves of their own; the group of null comes first; an empty table has no root and no proofs. Further columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import pin, row_key
from tidepool.operators.ranking import global_row_number

FANOUT = 8
STRIDE = 3
#: Up to so many groups their table is sent to every task; beyond, rows and groups are shuffled, and skewed ones split at run time.
BROADCAST_GROUPS = 200_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"


def leaf_digest(*values: Column) -> Column:
    """Digest of one row: each value as ``-`` if null, else its UTF-8 byte count, ``:`` and itself."""
    parts = []
    for v in values:
        v = v.cast("string")
        parts.append(F.when(v.isNull(), "-").otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v)))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _node(run: list[str]) -> str:
    return hashlib.sha256("".join(run).encode()).hexdigest()


def _levels(nodes: list[str], n: int, fanout: int, stride: int) -> list[list[str]]:
    """The levels from ``nodes`` up: at most ``stride`` more, none above a level of the group that has one node."""
    out = [nodes]
    for _ in range(stride):
        if n == 1:
            break
        out.append([_node(out[-1][k:k + fanout]) for k in range(0, len(out[-1]), fanout)])
        n = -(-n // fanout)
    return out


@dataclass
class Tree:
    """Stored bands of the trees of all groups: grp, place, n (nodes of the group on that level), digest, row."""

    fanout: int
    stride: int
    bands: list[DataFrame] = field(default_factory=list)

    def _subtrees(self, band: DataFrame) -> DataFrame:
        """A row per aligned subtree: grp, block, n, nodes in order."""
        block = F.floor(F.col("place") / F.lit(self.fanout ** self.stride)).cast("long").alias("block")
        extra = ["row"] if "row" in band.columns else []
        return band.groupBy("grp", block).agg(
            F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("place", "digest", *extra))).alias("nodes"))

    def grow(self, leaves: DataFrame) -> Tree:
        """Store ``leaves`` (grp, place, n, digest and a struct ``row``) and the bands above them."""
        fanout, stride = self.fanout, self.stride
        self.bands = [pin(leaves, "merkle-band")]
        most = self.bands[0].agg(F.max("n")).first()[0] or 1

        def close(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                tops = [_levels(nodes.values.field("digest").to_pylist(), n, fanout, stride)[-1][0]
                        for nodes, n in zip(batch.column("nodes"), batch.column("n").to_pylist())]
                less = [max(1, -(-n // fanout ** stride)) for n in batch.column("n").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("grp"), batch.column("block"), pa.array(less, pa.int64()),
                                                  pa.array(tops, pa.string())], ["grp", "place", "n", "digest"])

        while most > 1:
            up = self._subtrees(self.bands[-1].drop("row")).mapInArrow(close, "grp string, place long, n long, digest string")
            self.bands.append(pin(up, "merkle-band"))
            most = -(-most // fanout ** stride)
        return self

    def tops(self) -> DataFrame:
        """grp, digest of each group's last node."""
        return self.bands[-1].select("grp", "digest")

    def paths(self, above: DataFrame) -> DataFrame:
        """grp, row, digest and path of every leaf; ``above`` (grp, path) is the way on from each group's last node."""
        fanout, stride = self.fanout, self.stride
        kind = self.bands[0].schema["row"].dataType.simpleString()

        def descend(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    nodes, path = batch.column("nodes")[k].values, batch.column("path")[k].values
                    on = [path.field(side).to_pylist() for side in ("left", "right")]
                    digests = nodes.field("digest")
                    levels = _levels(digests.to_pylist(), batch.column("n")[k].as_py(), fanout, stride)
                    lefts, rights, ends = [], [], [0]
                    for i in range(len(nodes)):
                        for level in levels[:-1]:
                            begin = i - i % fanout
                            lefts.append("".join(level[begin:i]))
                            rights.append("".join(level[i + 1:begin + fanout]))
                            i //= fanout
                        lefts += on[0]
                        rights += on[1]
                        ends.append(len(lefts))
                    sides = pa.StructArray.from_arrays([pa.array(lefts, pa.string()), pa.array(rights, pa.string())], ["left", "right"])
                    grp = pa.array([batch.column("grp")[k].as_py()] * len(nodes), pa.string())
                    out = [grp, nodes.field("place"), digests, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), sides)]
                    names = ["grp", "place", "digest", "path"]
                    if nodes.type.get_field_index("row") >= 0:
                        out, names = [*out, nodes.field("row")], [*names, "row"]
                    yield pa.RecordBatch.from_arrays(out, names)

        known = above.select("grp", F.lit(0).cast("long").alias("place"), "path")
        for at in range(len(self.bands) - 1, -1, -1):
            if at == len(self.bands) - 1:  # the top nodes themselves: one a group
                own = self.bands[at].join(known, ["grp", "place"])
                known = own.select("grp", "place", "digest", "path", *(["row"] if at == 0 else []))
                continue
            up = known.select("grp", F.col("place").alias("block"), "path")
            schema = f"grp string, place long, digest string, path {PATH}" + (f", row {kind}" if at == 0 else "")
            known = self._subtrees(self.bands[at]).join(up, ["grp", "block"]).mapInArrow(descend, schema)
        return known.select("grp", "row", "digest", "path")


@dataclass
class Manifest:
    """The stored trees: of the rows within each group, and of the groups' last nodes."""

    rows: Tree
    groups: Tree
    root: str | None
    n_groups: int


def build(leaves: DataFrame, group: str, key: str, digest: str = "leaf", fanout: int = FANOUT, stride: int = STRIDE) -> Manifest:
    """The manifest of ``leaves``: rows of a group ascend by ``key``, groups by their name, nulls first."""
    base = pin(leaves.select(F.struct("*").alias("row"), F.col(group).alias("name"), row_key(group).alias("grp"),
                             F.col(key).alias("key"), F.col(digest).alias("digest")), "merkle-leaves")
    numbered = global_row_number(base, [F.col("name").asc_nulls_first(), F.col("key").asc_nulls_first(), F.col("digest")])
    spans = base.groupBy("grp", "name").agg(F.count(F.lit(1)).alias("n"))
    ordered = pin(global_row_number(spans, [F.col("name").asc_nulls_first()]), "merkle-groups")
    first = numbered.groupBy("grp").agg(F.min("rn").alias("first"))
    count = ordered.count()
    spans = ordered.select("grp", "n").join(first, "grp")
    placed = numbered.join(F.broadcast(spans) if count <= BROADCAST_GROUPS else spans, "grp")
    rows = Tree(fanout, stride).grow(placed.select("grp", (F.col("rn") - F.col("first")).alias("place"), "n", "digest", "row"))
    tops = rows.tops().join(ordered.select("grp", "rn"), "grp")
    groups = Tree(fanout, stride).grow(tops.select(
        F.lit("").alias("grp"), (F.col("rn") - 1).alias("place"), F.lit(count).cast("long").alias("n"), "digest",
        F.struct(F.col("grp").alias("of")).alias("row")))
    root = groups.tops().first()
    return Manifest(rows, groups, root["digest"] if root else None, count)


def proofs(manifest: Manifest) -> DataFrame:
    """row (the leaf's columns), leaf, path, subroot and root of every leaf.

    ``path`` has an entry per level from the leaf up to the root: the digests of the siblings before (left) and behind (right) it.
    """
    none = F.array().cast(PATH)
    top = manifest.groups.tops().select("grp", none.alias("path"))
    whole = manifest.groups.paths(top).select(F.col("row.of").alias("grp"), "path", F.col("digest").alias("subroot"))
    above = pin(whole, "merkle-paths")
    tops = above.select("grp", "subroot")
    found = manifest.rows.paths(above.select("grp", "path")).join(
        F.broadcast(tops) if manifest.n_groups <= BROADCAST_GROUPS else tops, "grp")
    return found.select("row", F.col("digest").alias("leaf"), "path", "subroot",
                        F.lit(manifest.root).cast("string").alias("root"))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]).cast("binary"), 256))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda s: F.concat(s["left"], s["right"]))).cast("binary"), 256)


def verification(docs: DataFrame, fanout: int = FANOUT, stride: int = STRIDE) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row.

    Where 3 divides the CRC-32 of the decimal doc_id, the folded leaf is that of the text with A-Z in lower case.
    """
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    leaves = docs.select(*FIELDS).select(
        "doc_id", "lang", leaf_digest(*map(F.col, FIELDS)).alias("leaf"),
        F.when(hit, leaf_digest(*map(F.col, FIELDS[:-1]), low)).alias("tampered"))
    found = proofs(build(leaves, "lang", "doc_id", fanout=fanout, stride=stride))
    folded = fold(F.coalesce("row.tampered", "leaf"), F.col("path"))
    return found.select("row.doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
