"""Training-order shards against the plain stream of ids."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest

from tests.llm.helpers import empty, messy
from tidepool.llm import token_output as out
from tidepool.llm.bpe import vocabulary
from tidepool.llm.common import pin, shared_folder


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000, 4097])
def test_slots_are_a_permutation(n):
    for key in (1, 2):
        assert sorted(out.slots(np.arange(n), n, key)) == list(range(n))
    if n >= 1000:
        assert list(out.slots(np.arange(n), n, 1)) != list(out.slots(np.arange(n), n, 2))
        assert abs(np.corrcoef(np.arange(n), out.slots(np.arange(n), n, 1))[0, 1]) < 0.2


@pytest.mark.parametrize("length, shard_slots, chunk_ids", [(64, 7, 100), (1024, 50, 1 << 19), (100_000, 3, 999)])
def test_shards_hold_the_stream(spark, length, shard_slots, chunk_ids):
    docs = pin(messy(spark).repartition(5), "test-docs")
    own = out._encoder(vocabulary(), public_tokenizers.PATTERN)
    end = own.max_token_value + 1
    stream = []                       # the scan's own order: rows of one task after another
    for r in docs.select("text").collect():
        stream += [*own.encode_ordinary(r["text"] or ""), end]
    n = -(-len(stream) // length)
    padded = np.array(stream + [end] * (n * length - len(stream)), dtype="<u2").reshape(n, length)
    want = {int(s): padded[k].tobytes() for k, s in enumerate(out.slots(np.arange(n), n))}
    folder = shared_folder(spark, "t-shards")
    manifest = out.materialise(docs, folder, length, shard_slots, chunk_ids=chunk_ids)
    got = {r["slot"]: (r["shard"], r["offset"], bytes(r["ids"])) for r in out.read_slots(manifest, folder).collect()}
    assert {s: i for s, (_, _, i) in got.items()} == want
    assert all((shard, at) == (s // shard_slots, s % shard_slots * 2 * length) for s, (shard, at, _) in got.items())
    resumed = out.read_slots(manifest, folder, first=n // 2).collect()
    assert {r["slot"] for r in resumed} == set(range(n // 2, n))


def test_query_columns_and_empty(spark):
    docs = pin(messy(spark), "test-docs")
    got = out.training_order(docs, 128, 16).collect()
    assert [r["slot"] for r in sorted(got, key=lambda r: r["slot"])] == list(range(len(got)))
    assert all(len(r["ids_sha256"]) == len(hashlib.sha256().hexdigest()) for r in got)
    assert out.training_order(pin(empty(spark), "none")).count() == 0
