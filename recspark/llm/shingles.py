"""Hashed word shingles and MinHash signatures of whole texts, in array operations.

Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z in lower case; shingles are five consecutive words, and a text with
fewer words is one shingle.  A word is hashed by its bytes, a shingle by its words, both to 64 bits.
"""

from __future__ import annotations

import hashlib

import numpy as np

from recspark.functions.shipping import ship_by_value

ship_by_value(__name__)

U = np.uint64
SIZE = 5
BASE = U(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U(33))
    h *= U(0xFF51AFD7ED558CCD)
    h ^= h >> U(33)
    h *= U(0xC4CEB9FE1A85EC53)
    h ^= h >> U(33)
    return h


class Shingler:
    """Shingle sets of texts: ``sets(texts)`` gives each text's sorted distinct shingle hashes."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        table = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
        table[65:91] = table[97:123]  # A-Z count as a-z
        space = np.zeros(256, bool)
        space[[32, 9, 10, 11, 12, 13]] = True
        self.table, self.space = table, space
        self.weights = rng.integers(0, 1 << 63, SIZE, dtype=np.uint64) * U(2) + U(1)
        self.powers = self.inverse = np.ones(1, U)

    def _reach(self, n: int) -> None:
        if len(self.powers) < n:
            size = 1 << (n - 1).bit_length()
            steps = np.full(size, BASE, U)
            steps[0] = U(1)
            self.powers = np.cumprod(steps, dtype=U)
            steps[1:] = U(pow(int(BASE), -1, 1 << 64))
            self.inverse = np.cumprod(steps, dtype=U)

    def words(self, texts: list[str]):
        """64-bit hashes of all words, and the number of words of each text."""
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
        self._reach(len(data) + 1)
        gap = self.space[data]
        edge = np.flatnonzero(np.diff(gap, prepend=True))
        starts, ends = edge[::2], edge[1::2]
        sums = np.concatenate([np.zeros(1, U), np.cumsum(self.table[data] * self.powers[:len(data)], dtype=U)])
        hashes = mix((sums[ends] - sums[starts]) * self.inverse[starts])
        limits = np.cumsum([len(r) + 1 for r in raw])
        counts = np.diff(np.searchsorted(starts, limits), prepend=0)
        return hashes, counts

    def sets(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        hashes, counts = self.words(texts)
        w = self.weights
        n = max(0, len(hashes) - SIZE + 1)
        rolled = np.zeros(n, U)
        for k in range(SIZE):
            rolled += hashes[k:k + n] * w[k]
        rolled = mix(rolled)
        out, at = [], 0
        for c in counts.tolist():
            if c >= SIZE:
                out.append(np.unique(rolled[at:at + c - SIZE + 1]))
            elif c:
                out.append(mix((hashes[at:at + c] * w[:c]).sum(dtype=U, keepdims=True) + U(c)))
            else:
                out.append(np.zeros(0, U))
            at += c
        return out


def set_digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


class Signer:
    """MinHash signatures: ``signatures(sets)`` gives a uint32 row of ``size`` minima per set."""

    def __init__(self, size: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.a = rng.integers(0, 1 << 63, size, dtype=np.uint64) * U(2) + U(1)
        self.b = rng.integers(0, 1 << 63, size, dtype=np.uint64)

    def signatures(self, sets: list[np.ndarray]) -> np.ndarray:
        out = np.full((len(sets), len(self.a)), 0xFFFFFFFF, np.uint32)
        some = [k for k, s in enumerate(sets) if len(s)]
        lo = 0
        while lo < len(some):  # about 64k shingles at a time, which stay in the cache
            hi, n = lo, 0
            while hi < len(some) and (not n or n + len(sets[some[hi]]) <= 65_536):
                n += len(sets[some[hi]])
                hi += 1
            rows = some[lo:hi]
            values = np.concatenate([sets[k] for k in rows])
            starts = np.cumsum([0] + [len(sets[k]) for k in rows[:-1]])
            part = np.empty((len(rows), len(self.a)), np.uint32)
            for j, (a, b) in enumerate(zip(self.a, self.b)):
                part[:, j] = np.minimum.reduceat(values * a + b, starts) >> U(32)
            out[rows] = part
            lo = hi
        return out


def band_keys(signatures: np.ndarray, bands: int) -> np.ndarray:
    """One int64 per band: a hash of the band's number and its rows of the signature."""
    n, size = signatures.shape
    rows = size // bands
    cells = signatures.reshape(n, bands, rows).astype(U)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=U) * BASE, (n, bands)).copy()
    for k in range(rows):
        key = mix(key ^ (cells[:, :, k] + U((k + 1) * int(BASE) % (1 << 64))))
    return key.view(np.int64)
