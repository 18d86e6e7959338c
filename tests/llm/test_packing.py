"""Packed pieces of hashes."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from fundlens.llm import packing
from fundlens.llm.batches import mix, unmix


def test_unmix_undoes_mix():
    h = np.random.default_rng(1).integers(0, 1 << 64, 1000, np.uint64, endpoint=False)
    assert (unmix(mix(h)) == h).all()


@pytest.mark.parametrize("dtype", [np.uint8, np.uint32, np.int64, float])
def test_planes(dtype):
    x = np.random.default_rng(2).integers(0, 200, 77).astype(dtype)
    assert (packing.values(packing.planes(x), dtype) == x).all()
    assert len(packing.values(packing.planes(x[:0]), dtype)) == 0


@pytest.mark.parametrize("bits", [4, 9])
def test_pieces(bits):
    keys = np.sort(np.random.default_rng(3).integers(-1 << 63, (1 << 63) - 1, 5000))
    keys = np.sort(np.concatenate([keys, keys[:50], [-1 << 63, -1, 0, (1 << 63) - 1]]))
    beside = np.arange(len(keys), dtype=np.uint32)
    rows = list(packing.pieces(keys, [beside], bits))
    assert [r[0] for r in rows] == sorted({int(k) >> (64 - bits) for k in keys})
    assert (np.concatenate([packing.keys_of(r[1]) for r in rows]) == keys).all()
    assert (np.concatenate([packing.values(r[2], np.uint32) for r in rows]) == beside).all()
    assert not list(packing.pieces(keys[:0], [beside[:0]], bits))


@pytest.mark.parametrize("limit", [10, 300, 10**6])
def test_gathered_counts_equal_a_plain_count(limit):
    rng = np.random.default_rng(4)
    pool = rng.integers(-1 << 63, (1 << 63) - 1, 200)
    pool[0] = 0
    held, want, batches = packing.Gathered(["keys", "n", "other"], 5, limit), Counter(), []
    for _ in range(30):
        # one key in a third of all rows
        drawn = np.where(rng.random(100) < 1 / 3, pool[0], rng.choice(pool, 100))
        want.update(drawn.tolist())
        keys, n = np.unique(drawn, return_counts=True)
        batches += held.add([keys, n.astype(np.uint32), keys ^ 5])
    batches += held.rest()
    table = pa.Table.from_batches(batches)
    keys, n = packing.joined(table, "keys"), packing.joined(table, "n", np.uint32)
    assert (packing.joined(table, "other", np.int64) == keys ^ 5).all()
    got = Counter()
    for k, c in zip(keys.tolist(), n.tolist(), strict=True):
        got[k] += c
    assert got == want
    assert not list(packing.Gathered(["keys", "n"], 5).rest())


def test_buckets_grow_with_the_corpus():
    sizes = [packing.buckets(n) for n in (0, 10**6, 10**9, 10**12)]
    assert sizes == sorted(sizes) and sizes[0] == 4
    assert 10**12 / 2 ** sizes[-1] <= packing.SHARE


def test_bytes_of_few_values_take_little_room():
    counts = np.random.default_rng(4).integers(1, 4, 10_000).astype(np.uint32)
    assert len(packing.planes(counts)) < 5_000
    assert (packing.values(packing.planes(counts), np.uint32) == counts).all()
