"""Adaptive context-mixing range coder for token ids below 65,536.

A block is coded on its own: all models start empty and a CRC-32 covers the whole block.  Its ids are dealt to
``lanes`` consecutive stretches which are coded in step, one id of every lane at a time, so that each step is a few
array operations.  Every lane has a carry-less 64-bit range coder that emits 16-bit words.

Prediction of the next id mixes three orders.  The order-2 and order-1 contexts each predict one id with a confidence
from their record so far; the order-0 model is the frequency table of the ids of the block.  The mixture's weights are adaptive
probabilities, learned per pair of confidences, of "order 2 was right", "order 1 was right", "an id that order 0
knows" and "a new id" (coded plainly).  Coder and decoder bring the models up to date after the same steps, from
all ids coded so far.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

from recspark.functions.shipping import ship_by_value

ship_by_value(__name__)

MAGIC = b"RSID"
HEAD = "<4sHHIIIII"  # magic, version, lanes, steps, ids, documents, words, crc32 of what follows
U = np.uint64
LOW, TOP, BOT, MIX_BITS, ID_BITS = U((1 << 32) - 1), U(1 << 48), U(1 << 32), 12, 16
ORDER2 = 1 << 18  # slots of the order-2 table
LEVELS = 6  # confidences
LEVEL_SHIFT = 17
NONE = (1 << LEVEL_SHIFT) - 1  # no prediction yet


class Models:
    """Order-0 to order-2 predictions and the mixture's weights; updated from whole steps."""

    def __init__(self):
        self.seen = np.zeros(1 << ID_BITS, np.int64)
        self.tables = [[np.full(n, NONE, np.int32), np.zeros(n, np.int32), np.zeros(n, np.int32)] for n in (1 << ID_BITS, ORDER2)]
        self.mix = np.zeros((2 * LEVELS * LEVELS, 4), np.int64) + np.array([1, 1, 4, 2])
        self.total = 0
        self._rebuild()

    def _rebuild(self):
        """The tables that coding reads: one gather per prediction, weight and frequency."""
        known = self.seen > 0
        room = 1 << ID_BITS
        freq = np.ones(room, np.int64)
        start = np.arange(room)
        self.lookup = start
        if self.total:
            ids = np.flatnonzero(known)
            share = 1 + self.seen[ids] * (room - len(ids)) // self.total
            share[np.argmax(share)] += room - share.sum()
            freq[ids] = share
            start = np.arange(room)
            start[ids] = np.cumsum(share) - share
            self.lookup = np.repeat(ids, share)
        self.kind = np.where(known, 2, 3)
        # rows: a predicted id takes the whole range, another one its own share
        freq = np.concatenate([np.full(room, room), freq])
        start = np.concatenate([np.zeros(room, np.int64), start])
        self.share = start.astype(np.uint64) << U(32) | freq.astype(np.uint64)  # one gather for both
        scale = (1 << MIX_BITS) - 4
        share = 1 + self.mix * scale // self.mix.sum(axis=1, keepdims=True)
        share[:, 2] += (1 << MIX_BITS) - share.sum(axis=1)
        floor = np.cumsum(share, axis=1) - share
        self.weight = share.reshape(-1).astype(np.uint64)
        self.floor = (floor << ID_BITS).reshape(-1).astype(np.uint64)
        self.bounds = [np.ascontiguousarray(floor[:, k] << ID_BITS).astype(np.uint64) for k in (1, 2, 3)]
        self.packed = [pred | _level(pred, hit, miss) << LEVEL_SHIFT for pred, hit, miss in self.tables]

    def predict(self, prev2: np.ndarray, prev: np.ndarray):
        """ids predicted by order 1 and order 2 (NONE: none), and the mixing context."""
        x, y = self.packed[0][prev], self.packed[1][order2_slot(prev2, prev)]
        a, b = x & NONE, y & NONE
        return a, b, ((x >> LEVEL_SHIFT) * LEVELS + (y >> LEVEL_SHIFT)) * 2 + (a == b)

    def update(self, prev2, prev, ids, kinds, contexts):
        self.total += len(ids)
        self.seen += np.bincount(ids, minlength=1 << ID_BITS)
        for (pred, hit, miss), ctx in zip(self.tables, (prev, order2_slot(prev2, prev))):
            right = pred[ctx] == ids
            wrong = ~right
            hit += np.bincount(ctx[right], minlength=len(pred)).astype(np.int32)
            miss += np.bincount(ctx[wrong], minlength=len(pred)).astype(np.int32)
            at = ctx[wrong]
            weak = hit[at] <= miss[at]
            pred[at[weak]] = ids[wrong][weak]  # the latest one stays
        self.mix += np.bincount(contexts * 4 + kinds, minlength=self.mix.size).reshape(self.mix.shape) * 2
        self._rebuild()


def order2_slot(prev2, prev):
    return ((prev2 * 40503 ^ prev * 2654435) * 2654435769 >> 11) & (ORDER2 - 1)


def _level(pred, hit, miss):
    h, m = hit + 1, miss + 1
    level = 1 + (4 * h > m) + (h > m) + (h > 3 * m) + ((h > 10) & (h > 8 * m))
    return np.where(pred == NONE, 0, level).astype(np.int32)


def refresh_steps(steps: int):
    """Stretches of steps between updates: short at first, then 64."""
    lo, size = 0, 2
    while lo < steps:
        yield lo, min(steps, lo + size)
        lo, size = lo + size, min(64, size * 2)


def _lanes(n: int) -> int:
    return int(max(1, min(4096, n // 256)))


def encode_ids(ids: np.ndarray):
    """(lanes, steps, words per lane, words of all lanes) for int64 ids in 0..65535."""
    n = len(ids)
    lanes = _lanes(n)
    steps = -(-n // lanes)
    grid = np.ones(lanes * steps, np.int64)
    grid[:n] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    before = np.zeros((steps + 2, lanes), np.int64)
    before[2:] = grid
    low, rng = np.zeros(lanes, U), np.full(lanes, ~U(0), U)
    out = np.zeros((2 * steps + 8, lanes), np.uint16)
    pos = np.zeros(lanes, np.int64)
    models = Models()
    shift = U(MIX_BITS + ID_BITS)
    for lo, hi in refresh_steps(steps):
        want, prev, prev2 = (x.reshape(-1) for x in (grid[lo:hi], before[lo + 1:hi + 1], before[lo:hi]))
        a, b, ctx = models.predict(prev2, prev)
        kind = np.where(b == want, 0, np.where(a == want, 1, models.kind[want]))
        cell, row = ctx * 4 + kind, want + (kind > 1) * (1 << ID_BITS)
        w = models.weight[cell]
        share = models.share[row]
        start = models.floor[cell] + w * (share >> U(32))
        freq = w * (share & LOW)
        start, freq = start.reshape(-1, lanes), freq.reshape(-1, lanes)
        for s, f in zip(start, freq):
            r = rng >> shift
            low += r * s
            rng = r * f
            _shift_out(low, rng, out, pos)
        models.update(prev2, prev, want, kind, ctx)
    for _ in range(4):  # the rest of low
        out[pos, np.arange(lanes)] = low >> U(48)
        low <<= U(16)
        pos += 1
    return lanes, steps, pos, np.concatenate([out[:k, j] for j, k in enumerate(pos.tolist())])


def _due(low, rng):
    """Lanes whose first word is settled, or whose range became too small."""
    return np.flatnonzero(((low ^ (low + rng)) < TOP) | (rng < BOT))


def _shifted(low, rng, at):
    lo, rg = low[at], rng[at]
    tight = (lo ^ (lo + rg)) >= TOP
    rg = np.where(tight, (~lo + U(1)) & (BOT - U(1)), rg)
    low[at], rng[at] = lo << U(16), rg << U(16)
    return lo


def _shift_out(low, rng, out, pos):
    at = _due(low, rng)
    while len(at):
        out[pos[at], at] = _shifted(low, rng, at) >> U(48)
        pos[at] += 1
        at = at[_due(low[at], rng[at])]


def decode_ids(lanes: int, steps: int, n: int, sizes: np.ndarray, words: np.ndarray) -> np.ndarray:
    words = np.concatenate([words.astype(U), np.zeros(8, U)])
    at = np.cumsum(sizes) - sizes
    code = np.zeros(lanes, U)
    for _ in range(4):
        code = code << U(16) | words[at]
        at = at + 1
    low, rng = np.zeros(lanes, U), np.full(lanes, ~U(0), U)
    grid = np.zeros((steps + 2, lanes), np.int64)
    models = Models()
    shift, ceiling = U(MIX_BITS + ID_BITS), U((1 << MIX_BITS + ID_BITS) - 1)
    for lo, hi in refresh_steps(steps):
        kinds, contexts = np.empty((hi - lo, lanes), np.int64), np.empty((hi - lo, lanes), np.int64)
        for k in range(lo, hi):
            a, b, ctx = models.predict(grid[k], grid[k + 1])
            r = rng >> shift
            v = np.minimum((code - low) // r, ceiling)
            kind = (models.bounds[0][ctx] <= v).astype(np.int64)
            kind += models.bounds[1][ctx] <= v
            kind += models.bounds[2][ctx] <= v
            cell = ctx * 4 + kind
            f0, w = models.floor[cell], models.weight[cell]
            got = np.where(kind == 0, b, a).astype(np.int64)
            at2 = np.flatnonzero(kind > 1)
            inner = ((v[at2] - f0[at2]) // w[at2]).astype(np.int64)
            got[at2] = np.where(kind[at2] == 2, models.lookup[inner], inner)
            row = got.copy()
            row[at2] += 1 << ID_BITS
            share = models.share[row]
            low += r * (f0 + w * (share >> U(32)))
            rng = r * (w * (share & LOW))
            due = _due(low, rng)
            while len(due):
                _shifted(low, rng, due)
                code[due] = code[due] << U(16) | words[at[due]]
                at[due] += 1
                due = due[_due(low[due], rng[due])]
            grid[k + 2], kinds[k - lo], contexts[k - lo] = got, kind, ctx
        models.update(grid[lo:hi].reshape(-1), grid[lo + 1:hi + 1].reshape(-1), grid[lo + 2:hi + 2].reshape(-1), kinds.reshape(-1),
                      contexts.reshape(-1))
    return grid[2:].T.reshape(-1)[:n]


def write_block(doc_ids: list, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """One block: header, validity and value of the document ids, ids per document, words per lane, words."""
    if len(ids) and int(ids.max()) >= 1 << ID_BITS:
        raise ValueError("ids must be below 65536")
    lanes, steps, sizes, words = encode_ids(ids.astype(np.int64))
    body = b"".join([np.array([d is not None for d in doc_ids], np.uint8).tobytes(), np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
                     lengths.astype("<u4").tobytes(), sizes.astype("<u4").tobytes(), words.astype("<u2").tobytes()])
    return struct.pack(HEAD, MAGIC, 1, lanes, steps, len(ids), len(doc_ids), len(words), zlib.crc32(body)) + body


def read_block(block: bytes):
    """(document ids, lengths, ids) of a block; ValueError where it is damaged."""
    if len(block) < struct.calcsize(HEAD):
        raise ValueError("block is too short")
    magic, version, lanes, steps, n, docs, words, crc = struct.unpack_from(HEAD, block)
    body = block[struct.calcsize(HEAD):]
    if magic != MAGIC or version != 1 or zlib.crc32(body) != crc or len(body) != 13 * docs + 4 * lanes + 2 * words:
        raise ValueError("block is damaged")
    valid = np.frombuffer(body, np.uint8, docs)
    values = np.frombuffer(body, "<i8", docs, docs)
    lengths = np.frombuffer(body, "<u4", docs, 9 * docs).astype(np.int64)
    sizes = np.frombuffer(body, "<u4", lanes, 13 * docs).astype(np.int64)
    ids = decode_ids(lanes, steps, n, sizes, np.frombuffer(body, "<u2", words, 13 * docs + 4 * lanes))
    return [int(v) if ok else None for v, ok in zip(values.tolist(), valid.tolist())], lengths, ids
