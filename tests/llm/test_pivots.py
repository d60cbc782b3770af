"""The pivot table in the pipeline's search for near copies."""

import numpy as np

from formloom.llm import near_copies
from formloom.llm.fingerprint import hamming
from formloom.llm.simhash import pivot_table, reference_fingerprints


def test_pivots_discard_before_fingerprints_are_compared(monkeypatch):
    reference = reference_fingerprints(24)
    fp = np.array([reference[0], ~reference[0], reference[0] ^ np.uint64(5)])
    table, n, sig = pivot_table(fp, reference), np.full(3, 50), np.arange(96, dtype="<u4").reshape(3, 32)
    monkeypatch.setattr(near_copies, "hamming", lambda a, b: np.zeros(np.broadcast(a, b).shape, int))  # fingerprints tell nothing
    met = lambda **more: [some.tolist() for _, _, some in near_copies.tiles(0, n[rows], fp[rows], sig[rows], 0.8, **more)]
    rows = [0, 1]
    assert met() == [[0, 1]] and met(table=table[:, rows]) == []
    rows = [0, 2]
    assert met(table=table[:, rows]) == [[0, 1]]
    n = np.full(3, near_copies.FEW - 1)  # few shingles: no fingerprint rules anything out
    rows = [0, 1]
    assert met(table=table[:, rows]) == [[0, 1]]


def test_pivots_lose_no_pair():
    r = np.random.default_rng(3)
    base = r.integers(0, 1 << 64, 40, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in r.choice(64, k, replace=False)) for k in r.integers(0, 40, 200)], np.uint64)
    fp = np.concatenate((base, ~base, base[r.integers(0, 40, 200)] ^ flips))
    at = np.arange(len(fp))
    found = near_copies.apart(pivot_table(fp, reference_fingerprints(24)), at, at)
    assert found.any() and (hamming(fp[:, None], fp)[found] > near_copies.RADIUS).all()
