"""Exact, fast tokenisation of whole texts with the ``tokenizers`` library.

Both vocabularies used here split a text into words before any merge, so the ids of a text
are the ids of its words in order.  A batch is cut at places where that word split cannot change, every distinct
piece is encoded once by the library, and the ids of all texts are gathered by index.  Cuts are proposed before
spaces, after line ends and before full stops and commas; a proposed cut that the word split could see (inside runs of white space or of
punctuation) is undone.  The tests compare the ids with those of the library on whole texts, over random white space and scripts.

``style`` tells what a vocabulary does with white space: ``"kept"`` (a word holds its leading space, the rest of a
run is a token of its own) or ``"dropped"``.
"""

from __future__ import annotations

import os
import re
import sys
import types
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from recspark.functions.shipping import ship_by_value

ship_by_value(__name__)

MARK = "\x01"
PLAIN = re.compile(" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
CUTS = ((" ", MARK + " "), ("\n", "\n" + MARK), (".", MARK + "."), (",", MARK + ","))
MAX_PIECES, MAX_IDS = 600_000, 4_000_000  # of a worker's cache; beyond either it keeps the last batch's.  About 0.2 KB a piece
#: what a piece's ends look like
ENDS_WS, STARTS_WS, SPACE_WORD, ENDS_RUN, SENTENCE, STARTS_STOP, ENDS_WORD = 1, 2, 4, 8, 16, 32, 64


def byte_alphabet() -> dict[int, int]:
    """The character that stands for each byte in byte-level vocabularies: printable Latin-1 stands for itself, others follow from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {b: 256 + k for k, b in enumerate(rest)}


class _Codes(dict):
    """piece -> code; a piece that is looked up for the first time gets the next code and is noted as new."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self.new.append(piece)
        self[piece] = code = len(self)
        return code


class PieceEncoder:
    def __init__(self, path: str, style: str, max_pieces: int | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        if style not in ("kept", "dropped"):
            raise ValueError(f"unknown style {style!r}")
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True  # their strings in a text are ordinary text
        self.style = style
        self.max_pieces = MAX_PIECES if max_pieces is None else max_pieces
        self.alphabet = byte_alphabet()
        self._reset()

    def _reset(self):
        self.codes = _Codes()
        self.pool = np.zeros(0, np.uint32)
        self.lens = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)
        self.flags = np.zeros(0, np.uint8)
        self.recent = np.zeros(0, np.int64)  # codes of the last batch

    def _shrink(self) -> None:
        """Start the cache anew from the pieces of the last batch, which are the frequent ones."""
        keep, pieces, lens, starts, pool, flags = self.recent, [*self.codes], self.lens, self.starts, self.pool, self.flags
        self._reset()
        self.codes.update((pieces[k], n) for n, k in enumerate(keep.tolist()))
        n = lens[keep]
        self.lens, self.flags = n, flags[keep]
        self.starts = np.cumsum(n) - n
        self.pool = pool[np.repeat(starts[keep] - self.starts, n) + np.arange(int(n.sum()))]

    def _learn(self) -> None:
        """Encode the pieces that were met for the first time.

        A plain Latin word is one word for the vocabulary's split, so its merges are asked for directly; all other pieces
        go through the whole of the library's pipeline.
        """
        new, self.codes.new = self.codes.new, []
        if not new:
            return
        got, flags = [None] * len(new), np.full(len(new), ENDS_WORD, np.uint8)
        other = []
        merge, to_bytes, kept = self.tok.model.tokenize, self.alphabet, self.style == "kept"
        space = chr(to_bytes[32]) if kept else ""
        for k, p in enumerate(new):
            spaced = p[0] == " "
            word = p[1:] if spaced else p
            if word.isascii() and word.isalpha():  # most words: their bytes stand for themselves
                if spaced:
                    flags[k] |= STARTS_WS | SPACE_WORD
                    word = space + word
                got[k] = [x.id for x in merge(word if kept else word.lower())]
            elif PLAIN.fullmatch(p):
                if p[0] == " ":
                    flags[k] |= STARTS_WS | SPACE_WORD
                word = p if kept else p.lstrip(" ").lower()
                got[k] = [x.id for x in merge(word.encode().decode("latin-1").translate(to_bytes))]
            else:
                other.append(k)
        for k, e in zip(other, self.tok.encode_batch_fast([new[k] for k in other], add_special_tokens=False)):
            got[k], flags[k] = e.ids, _flags(new[k] if kept else unicodedata.normalize("NFC", new[k]).lower())
        lens = np.fromiter(map(len, got), np.int64, len(got))
        self.pool = np.concatenate([self.pool, np.fromiter(chain.from_iterable(got), np.uint32, int(lens.sum()))])
        self.lens = np.concatenate([self.lens, lens])
        self.starts = np.cumsum(self.lens) - self.lens
        self.flags = np.concatenate([self.flags, flags])

    def _pieces(self, text: str) -> list[str]:
        if MARK in text:
            return [text] if text else []
        if self.style == "dropped" and text.isascii():
            text = text.lower()  # as the vocabulary does; fewer distinct pieces
        for old, new in CUTS:
            text = text.replace(old, new)
        return [*filter(None, text.split(MARK))]

    def _split(self, texts: list[str]):
        """Number of pieces of each text, and the code of every piece."""
        if any(MARK in t for t in texts):  # a text that holds the mark itself stays whole
            split = [self._pieces(t) for t in texts]
            return self._codes(split)
        arr = pa.array(texts, pa.large_string())
        if self.style == "dropped":
            arr = pc.if_else(pc.string_is_ascii(arr), pc.ascii_lower(arr), arr)
        for old, new in CUTS:
            arr = pc.replace_substring(arr, pattern=old, replacement=new)
        lists = pc.split_pattern(arr, pattern=MARK)
        values = lists.values
        real = pc.greater(pc.binary_length(values), 0)
        some = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
        ends = lists.offsets.to_numpy()
        known = values.filter(real).dictionary_encode()
        words = known.dictionary.to_pylist()
        own = np.fromiter(map(self.codes.__getitem__, words), np.int64, len(words))
        self._learn()
        counts = some[ends[1:]] - some[ends[:-1]]
        return counts, own[known.indices.to_numpy()]

    def _codes(self, split: list[list[str]]):
        counts = np.array([len(p) for p in split], np.int64)
        code = np.fromiter(map(self.codes.__getitem__, chain.from_iterable(split)), np.int64, int(counts.sum()))
        self._learn()
        return counts, code

    def _unsafe(self, code: np.ndarray) -> np.ndarray:
        """Of each pair of neighbouring pieces, whether the cut between them could change the word split."""
        f = self.flags[code]
        a, b = f[:-1], f[1:]
        bad = (b & STARTS_STOP > 0) & (a & ENDS_WORD == 0)
        if self.style == "kept":
            bad |= (a & ENDS_WS > 0) & (b & STARTS_WS > 0) & (b & SPACE_WORD == 0)
            bad |= (a & ENDS_RUN > 0) & (b & STARTS_WS == 0)
        return bad

    def encode(self, texts: list[str]):
        """Flat uint32 ids, int64 number of ids per text, and per flat id whether a sentence ends with it."""
        if len(self.codes) > self.max_pieces or len(self.pool) > MAX_IDS:
            self._shrink()
        counts, code = self._split(texts)
        split = None
        while len(code) > 1:
            owner = np.repeat(np.arange(len(texts)), counts)
            bad = np.flatnonzero(self._unsafe(code) & (owner[1:] == owner[:-1]))
            if not len(bad):
                break
            split = split or {}
            first = np.cumsum(counts) - counts
            for k in np.unique(owner[bad]).tolist():
                split[k] = _joined(split.get(k) or self._pieces(texts[k]), {int(x) for x in bad[owner[bad] == k] - first[k]})
            redone, fixed = self._codes([split[k] for k in split])
            at = np.cumsum(redone)[:-1]
            parts = np.split(code, np.cumsum(counts)[:-1])
            for k, part in zip(split, np.split(fixed, at)):
                parts[k] = part
                counts[k] = len(part)
            code = np.concatenate(parts)
        used = np.zeros(len(self.codes), bool)
        used[code] = True
        self.recent = np.flatnonzero(used)
        n = self.lens[code]
        total = int(n.sum())
        ends = np.cumsum(n)
        ids = self.pool[np.repeat(self.starts[code] - (ends - n), n) + np.arange(total)]
        sentence = np.zeros(total, bool)
        sentence[ends[(n > 0) & (self.flags[code] & SENTENCE > 0)] - 1] = True
        cum = np.concatenate([[0], ends])
        last = np.cumsum(counts)
        return ids, cum[last] - cum[last - counts], sentence


def _joined(pieces: list[str], undo: set[int]) -> list[str]:
    """``pieces`` without the cuts after the positions in ``undo``."""
    out, run = [], []
    for k, p in enumerate(pieces):
        run.append(p)
        if k not in undo:
            out.append("".join(run))
            run = []
    return out


def _flags(p: str) -> int:
    """Of a piece as the word split sees it, so after a vocabulary's normalisation."""
    a, b = p[0], p[-1]
    out = ENDS_WS * b.isspace() | STARTS_WS * a.isspace() | SPACE_WORD * (a == " " and len(p) > 1 and not p[1].isspace())
    out |= ENDS_RUN * (len(p) > 1 and b.isspace() and p[-2].isspace())
    out |= STARTS_STOP * (a in ".,") | ENDS_WORD * (b.isalpha() or b.isdecimal())
    return out | SENTENCE * (b == "\n" or p.rstrip()[-1:] in (".", "!", "?"))


def worker_encoder(path: str, style: str, max_pieces: int | None = None) -> PieceEncoder:
    """One encoder per Python worker: its cache of pieces (``max_pieces``) serves all tasks that the worker runs."""
    here = sys.modules.setdefault("recspark_worker_state", types.ModuleType("recspark_worker_state"))
    known = here.__dict__.setdefault("encoders", {})
    key = (path, style, max_pieces)
    if key not in known:
        known.clear()  # one vocabulary at a time
        known[key] = PieceEncoder(path, style, max_pieces)
    pa.default_memory_pool().release_unused()  # what the tasks before have left
    return known[key]


def text_batches(texts: list[str], chars: int = 1_000_000):
    """Slices of a batch with about ``chars`` characters each (a longer text is a slice of its own)."""
    lo = size = 0
    for k, t in enumerate(texts):
        if size and size + len(t) > chars:
            yield lo, k
            lo, size = k, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)
