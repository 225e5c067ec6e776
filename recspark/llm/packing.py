"""Order-preserving packing of tokenised documents into fixed windows by dynamic programming.

The documents, in ascending id order, form one stream of tokens.  The stream is cut into windows of at most ``window``
tokens; a window is padded to ``window`` unless its length is a power of two (such windows go to buckets of their own
size).  Cuts are chosen among document ends (free) and sentence ends (``sentence_cost``); inside a
sentence longer than a window a forced cut every ``window`` tokens costs ``hard_cost``.  The program minimises

    sum over windows of (padding + cost of the cut that ends it + ``window_cost``).

With prefix positions x, a padded window (i, j] costs f(i) + x_i + (window - x_j): the best i of the last ``window`` tokens
is the front of a monotone queue over f(i) + x_i, so a boundary is handled in amortised constant time;
the at most log2(window) exact power-of-two windows are looked up by position.

Distribution: the rows are range-partitioned and sorted by id, so each task packs a contiguous stretch of
the stream, in runs of about ``run_tokens`` tokens (a run ends at a document end; its last window is its own).  Only one run is
in memory, and the ids never leave the task that made them.  sequence_id = (partition number << 32) + running number: unique,
ascending in stream order, not gapless.

Defined cases: a null text is empty (just the end token); null ids sort first; rows with equal ids are separate
documents, in the order of their text; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.functions.shipping import ship_by_value
from recspark.llm.common import col, in_id_order, input_slices, lean
from recspark.llm.pieces import text_batches, worker_encoder

ship_by_value(__name__)

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def best_cuts(at: np.ndarray, cost: np.ndarray, window: int, window_cost: int) -> np.ndarray:
    """Positions where windows end: the cheapest segmentation of (0, at[-1]] with cuts among ``at``.

    ``at`` ascends, neighbours (and the first and 0) are at most ``window`` apart; cost[j] is paid for a cut at at[j].
    """
    x = np.concatenate([[0], at])
    # windows without padding, as (end, begin) pairs of boundaries: those of a power of two
    ends, begins = [], []
    for p in (1 << k for k in range(window.bit_length()) if 1 << k <= window):
        k = np.minimum(np.searchsorted(x, x - p), len(x) - 1)
        j = np.flatnonzero(x[k] == x - p)
        ends.append(j)
        begins.append(k[j])
    ends, begins = np.concatenate(ends), np.concatenate(begins)
    order = np.argsort(ends, kind="stable")
    end, begin = ends[order].tolist(), begins[order].tolist()
    end.append(len(x))
    f, came = [0] * len(x), [0] * len(x)
    pos, paid = x.tolist(), [0, *(cost + window_cost).tolist()]
    queue, m = deque([0]), 0  # boundaries i whose f(i) + x_i ascends; the front is the best one in reach
    key = [0] * len(x)
    for j in range(1, len(pos)):
        here = pos[j]
        while pos[queue[0]] < here - window:
            queue.popleft()
        back = queue[0]
        best = key[back] + window - here
        while end[m] == j:
            y = f[begin[m]]
            if y < best:
                best, back = y, begin[m]
            m += 1
        f[j] = best = best + paid[j]
        came[j] = back
        key[j] = mine = best + here
        while queue and key[queue[-1]] >= mine:
            queue.pop()
        queue.append(j)
    out, j = [], len(pos) - 1
    while j:
        out.append(pos[j])
        j = came[j]
    return np.array(out[::-1], np.int64)


def boundaries(lengths: np.ndarray, sentence: np.ndarray, window: int, sentence_cost: int, hard_cost: int):
    """Candidate cuts of a run and their costs: document ends, sentence ends, and forced cuts in longer gaps."""
    docs = np.cumsum(lengths)
    at = np.union1d(docs, np.flatnonzero(sentence) + 1)
    gaps = np.diff(at, prepend=0)
    if (gaps > window).any():
        more = [np.arange(x - g + window, x, window) for x, g in zip(at[gaps > window], gaps[gaps > window])]
        at = np.union1d(at, np.concatenate(more))
    cost = np.full(len(at), hard_cost, np.int64)
    cost[np.isin(at, np.flatnonzero(sentence) + 1)] = sentence_cost
    cost[np.isin(at, docs)] = 0
    return at, cost


def pack_run(doc_ids: list, lengths: np.ndarray, ids: np.ndarray, sentence: np.ndarray, first_sequence: int, window: int,
             sentence_cost: int, hard_cost: int, window_cost: int):
    """Pieces (columns of PIECES) of one run, and the number of its windows."""
    cuts = best_cuts(*boundaries(lengths, sentence, window, sentence_cost, hard_cost), window, window_cost)
    ends = np.cumsum(lengths)
    stops = np.union1d(cuts, ends)  # a piece ends where its window or its document ends
    begins = np.concatenate([[0], stops[:-1]])
    doc = np.searchsorted(ends, begins, side="right")
    seq = np.searchsorted(cuts, begins, side="right")
    raw = memoryview(np.ascontiguousarray(ids, dtype="<u4").tobytes())
    crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(begins.tolist(), stops.tolist())]
    opens = np.concatenate([[0], cuts[:-1]])
    return pd.DataFrame({"doc_id": pd.array([doc_ids[k] for k in doc.tolist()], dtype="Int64"), "start": begins - (ends - lengths)[doc],
                         "length": stops - begins, "ids_crc32": np.array(crc, np.int64), "doc_tokens": lengths[doc],
                         "sequence_id": first_sequence + seq, "offset": begins - opens[seq]}), len(cuts)


def _packer(path: str, style: str, end_id: int, window: int, run_tokens: int, sentence_cost: int, hard_cost: int, window_cost: int,
            cached_pieces: int | None):
    def pack(batches):
        from pyspark import TaskContext

        enc = worker_encoder(path, style, cached_pieces)
        number = TaskContext.get().partitionId() << 32
        held, size = [], 0  # (doc ids, lengths, ids, sentence ends) of the run so far

        def flush():
            nonlocal held, size, number
            doc_ids = [d for h in held for d in h[0]]
            out, n = pack_run(doc_ids, *(np.concatenate([h[k] for h in held]) for k in (1, 2, 3)), number, window, sentence_cost,
                              hard_cost, window_cost)
            number += n
            held, size = [], 0
            return out

        for batch in batches:
            texts, doc_ids = batch["text"].tolist(), [None if pd.isna(d) else int(d) for d in batch["doc_id"].tolist()]
            for lo, hi in text_batches(texts):
                flat, counts, ends = enc.encode(texts[lo:hi])
                cuts = np.cumsum(counts)
                ids = np.insert(flat, cuts, np.uint32(end_id))  # every document gets its end token
                sentence = np.insert(ends, cuts, False)
                held.append((doc_ids[lo:hi], counts + 1, ids, sentence))
                size += len(ids)
                if size >= run_tokens:
                    yield flush()
        if held:
            yield flush()

    return pack


def pack_documents(docs: DataFrame, tokenizer: str, style: str = "kept", end_id: int = 1, window: int = 2048,
                   run_tokens: int = 1 << 20, sentence_cost: int = 4, hard_cost: int = 64, window_cost: int = 1,
                   slice_bytes: int = 16 << 20, cached_pieces: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``slice_bytes`` of text go to a task and ``cached_pieces`` distinct pieces stay in a worker (None: the encoder's default): smaller ones
    take less memory and more time.
    """
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0  # one number
    slices = input_slices(size, slice_bytes)
    ordered = in_id_order(rows, slices)
    return ordered.mapInPandas(lean(_packer(tokenizer, style, end_id, window, run_tokens, sentence_cost, hard_cost, window_cost, cached_pieces)),
                              PIECES)
