"""Features are found as in a table of all hashes, in a small part of its memory."""

import numpy as np

from evigrade.llm import toxicity as T


def test_places_as_in_a_whole_table():
    rng = np.random.default_rng(3)
    size = (1 + len(T.BEGINNINGS)) << T._BITS
    features = [0, *rng.choice(np.arange(1, size - 1), 5000, replace=False).tolist(), size - 1]
    table = np.full(size, -1, np.int32)
    table[features] = np.arange(len(features))
    places = T.Places(features)
    for kind in range(1 + len(T.BEGINNINGS)):
        own = np.array([f & ((1 << T._BITS) - 1) for f in features if f >> T._BITS == kind], np.uint64)
        hashes = np.concatenate([own << np.uint64(64 - T._BITS), rng.integers(1, 1 << 63, 50_000, dtype=np.uint64), np.zeros(3, np.uint64)])
        found = table[T._short(hashes) + (kind << T._BITS)]
        at = np.flatnonzero((found >= 0) & (hashes != 0))
        where, which = places.find(kind, hashes)
        assert (where == at).all() and (which == found[at]).all()
    held = places.bits.nbytes + places.sorted.nbytes + places.order.nbytes
    assert held * 20 < table.nbytes


def test_no_features():
    at, which = T.Places([]).find(0, np.array([1, 2], np.uint64))
    assert not len(at) and not len(which)
