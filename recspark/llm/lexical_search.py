"""Ranked lexical search, reversed: the documents stream through an index of the items.

The few texts to be searched for (items) are turned into an inverted index, term -> items that hold it and how often, which is
broadcast.  Every document is cut into terms once; its counts of the items' terms are looked up in the index and update a
heap of at most ``k`` documents per item and task.  The heaps of all tasks are merged in two rounds, the first by item and a share of the
tasks, so no task reads all heaps of an item.  Documents are never indexed, joined or shuffled; what moves is k rows per item and task.

1. terms    one pass over the texts writes, per document, its number of terms and the counts of the items' terms
2. figures  number of documents, total terms, documents per term: aggregates of that table (the last with partial aggregation)
3. scores   one pass over that table updates the heaps

The broadcast is bounded: items are dealt into blocks of at most ``block_terms`` postings (checked by counting; more blocks are made
until it holds) and steps 1 to 3 run per block.  Only an item that alone has more postings is a larger block, of the size of its text.

Scores are exact integers.  Terms, weights and scores: see :func:`terms_of`, :func:`_weights` and :func:`_impact`.

Defined cases: a null text has no terms; documents without terms are not counted and never found; items are the distinct pairs of id and
text, an item without terms or without any document of positive score gets no row; equal scores are ranked by ascending document id, null ids last;
repeated documents are documents of their own; very long texts are counted whole; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import collections
import heapq
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recspark.functions.shipping import ship_by_value
from recspark.llm.common import col
from recspark.session import materialize

ship_by_value(__name__)

#: Bytes of a UTF-8 text that belong to terms stay (A-Z lowered), all others become spaces.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
LAST = np.iinfo(np.int64).max
CELLS = 4_000_000  # products and scores of a step


def terms_of(text: str) -> list[bytes]:
    """Runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in lower case."""
    return text.encode("utf-8").translate(_TABLE).split()


def _item_terms(batches):
    for batch in batches:
        rows = [(item, term.decode("utf-8"), n) for item, text in zip(batch["item"], batch["text"])
                for term, n in collections.Counter(terms_of(text)).items()]
        yield pd.DataFrame(rows, columns=["item", "term", "n"])


def _blocks(postings: DataFrame, block_terms: int) -> tuple[DataFrame, list[int]]:
    """``postings`` with a block number, and the numbers; a block has at most ``block_terms`` rows or a single item."""
    total = postings.count()
    n = max(1, -(-total // block_terms))
    while True:
        dealt = postings.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(n)).cast("int"))
        sizes = dealt.groupBy("block").agg(F.count(F.lit(1)).alias("rows"), F.min("item").alias("a"), F.max("item").alias("b")).collect()  # n rows
        if all(s["rows"] <= block_terms or s["a"] == s["b"] for s in sizes) or n > 2 * max(1, total):
            return dealt, sorted(s["block"] for s in sizes)
        n *= 2


class ItemIndex:
    """The inverted index of a block of items: ``vocabulary`` numbers the terms; term t's items are ``items[starts[t]:starts[t + 1]]``."""

    def __init__(self, postings: pd.DataFrame):
        postings = postings.sort_values(["term", "item"], kind="stable")
        terms, number = np.unique(postings["term"].to_numpy(object).astype(str) if len(postings) else np.zeros(0, str), return_inverse=True)
        self.vocabulary = {t.encode("utf-8"): k for k, t in enumerate(terms.tolist())}
        self.keys, self.items = np.unique(postings["item"].to_numpy(np.int64), return_inverse=True)
        self.counts = postings["n"].to_numpy(np.int64)
        order = np.argsort(number, kind="stable")
        self.items, self.counts = self.items[order], self.counts[order]
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(number, minlength=len(terms)))]).astype(np.int64)


def _counter(index):
    def count(batches):
        known = index.value.vocabulary
        for batch in batches:
            ids, n, terms, tfs = [], [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                found = terms_of(text.as_py())
                if not found:
                    continue
                tf = collections.Counter(found)
                own = sorted((known[t], tf[t]) for t in (known.keys() & tf.keys() if len(known) < len(tf) else [t for t in tf if t in known]))
                ids.append(doc_id)
                n.append(len(found))
                terms.append([t for t, _ in own])
                tfs.append([c for _, c in own])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))],
                names=["doc_id", "n", "terms", "tf"])

    return count


def _weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)


def _impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Heaps:
    """The k best documents of every item so far: (score, has an id, -id), the worst on top."""

    def __init__(self, items: int, k: int):
        self.k, self.heaps = k, [[] for _ in range(items)]
        self.least = np.ones(items, np.int64)  # a score below this changes nothing

    def offer(self, scores: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        """``scores``: documents x items."""
        doc, item = np.nonzero(scores >= self.least)
        if not len(doc):
            return
        s = scores[doc, item]
        order = np.lexsort((ids[doc], ~known[doc], -s, item))  # of a slice only the first k of an item can matter
        item, doc, s = item[order], doc[order], s[order]
        begin = np.flatnonzero(np.r_[True, item[1:] != item[:-1]])
        rank = np.arange(len(item)) - np.repeat(begin, np.diff(np.r_[begin, len(item)]))
        keep = rank < self.k
        for i, d, x in zip(item[keep].tolist(), doc[keep].tolist(), s[keep].tolist()):
            entry, heap = (x, bool(known[d]), -int(ids[d])), self.heaps[i]
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            else:
                heapq.heappushpop(heap, entry)
            if len(heap) == self.k:
                self.least[i] = heap[0][0]


def _scorer(index, weights, n_docs: int, n_terms: int, k: int):
    def score(batches):
        own, w = index.value, weights.value
        heaps = Heaps(len(own.keys), k)
        per_term = np.diff(own.starts)
        step_docs = max(1, CELLS // max(1, len(own.keys)))
        for batch in batches:
            ids, n = batch.column("doc_id"), batch.column("n").to_numpy()
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(LAST).to_numpy()
            ends = np.cumsum(np.asarray(batch.column("terms").value_lengths().to_numpy(zero_copy_only=False), np.int64))
            terms, tf = batch.column("terms").flatten().to_numpy(), batch.column("tf").flatten().to_numpy()
            doc = np.repeat(np.arange(len(n)), np.diff(np.r_[0, ends]))
            gain = w[terms] * _impact(tf, (25 + (75 * n * n_docs) // n_terms)[doc])
            work = np.r_[0, np.cumsum(per_term[terms])]  # products up to each posting
            lo = 0
            while lo < len(n):
                first = ends[lo - 1] if lo else 0
                within = np.searchsorted(work[ends], work[first] + CELLS, side="right")  # documents whose products fit in a step
                hi = int(min(len(n), max(lo + 1, within), lo + step_docs))
                scores = np.zeros((hi - lo) * len(own.keys), np.int64)
                for a in range(first, ends[hi - 1], CELLS):  # one very long document: its postings in slices
                    at = slice(a, min(a + CELLS, ends[hi - 1]))
                    reps = per_term[terms[at]]
                    pos = np.repeat(own.starts[terms[at]] - (np.cumsum(reps) - reps), reps) + np.arange(int(reps.sum()))
                    np.add.at(scores, np.repeat(doc[at] - lo, reps) * len(own.keys) + own.items[pos], np.repeat(gain[at], reps) * own.counts[pos])
                heaps.offer(scores.reshape(hi - lo, -1), ids[lo:hi], known[lo:hi])
                lo = hi
        rows = [(TaskContext.get().partitionId(), int(own.keys[i]), None if not has else -minus, s)
                for i, heap in enumerate(heaps.heaps) for s, has, minus in heap]
        cols = list(zip(*rows)) if rows else [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
                                          pa.array(cols[3], pa.int64())], names=["task", "item", "doc_id", "score"])

    return score


def _merged(heaps: DataFrame, k: int) -> DataFrame:
    """Merge of the tasks' heaps: by item and a share of the tasks first, then by item."""
    tasks = (heaps.agg(F.max("task")).first()[0] or 0) + 1
    best = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*best))
    shares = math.isqrt(tasks - 1) + 1
    some = heaps.withColumn("share", F.pmod(F.col("task"), F.lit(shares))).withColumn("rank", rank("item", "share")).where(F.col("rank") <= k)
    return some.withColumn("rank", rank("item")).where(F.col("rank") <= k).select("item", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10, block_terms: int = 1 << 20, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of highest positive score for each item."""
    spark = docs.sparkSession
    pairs = items.select(col(item_col).alias("item_id"), col(item_text_col).alias("text")).where("text IS NOT NULL").distinct()
    pairs = materialize(pairs.withColumn("item", F.monotonically_increasing_id()), "search-items")  # the numbers are fixed by writing them
    postings = materialize(pairs.select("item", "text").mapInPandas(_item_terms, "item long, term string, n long"), "search-postings")
    dealt, blocks = _blocks(postings, block_terms)
    texts = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).alias("text")).where("text IS NOT NULL")
    found = None
    for block in blocks:
        own = ItemIndex(dealt.where(F.col("block") == block).select("item", "term", "n").toPandas())  # at most block_terms rows
        index = spark.sparkContext.broadcast(own)
        counted = materialize(texts.mapInArrow(_counter(index), "doc_id long, n long, terms array<int>, tf array<long>"), "search-terms")
        n_docs, n_terms = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_docs:
            continue
        df = np.zeros(len(own.vocabulary), np.int64)
        for term, n in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # at most a row per term of the index
            df[term] = n
        weights = spark.sparkContext.broadcast(_weights(n_docs, df))
        heaps = materialize(counted.where(F.size("terms") > 0).mapInArrow(_scorer(index, weights, n_docs, n_terms, k),
                                                                          "task int, item long, doc_id long, score long"), "search-heaps")
        best = _merged(heaps, k)
        found = best if found is None else found.unionByName(best)
    if found is None:
        found = spark.createDataFrame([], "item long, rank int, doc_id long, score long")
    return found.join(pairs.select("item", "item_id"), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


SQL = r"""
    WITH docs AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents WHERE text IS NOT NULL),
    asked AS (SELECT row_number() OVER () AS item, item_id, regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM (SELECT DISTINCT item_id, text FROM benchmark) WHERE text IS NOT NULL),
    item_terms AS (SELECT item, term, count(*) AS q FROM (SELECT item, unnest(terms) AS term FROM asked) GROUP BY ALL),
    full_docs AS (SELECT row, doc_id, terms, len(terms) AS n FROM docs WHERE len(terms) > 0),
    figures AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM full_docs),
    counts AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM full_docs)
               WHERE term IN (SELECT term FROM item_terms) GROUP BY ALL),
    weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
                FROM counts, figures GROUP BY term, n_docs),
    scored AS (SELECT item, row, CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
               FROM counts JOIN full_docs USING (row) JOIN weights USING (term) JOIN item_terms USING (term), figures GROUP BY item, row),
    ranked AS (SELECT item, doc_id, score, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
               FROM scored JOIN full_docs USING (row) WHERE score > 0)
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked JOIN asked USING (item) WHERE rank <= 10"""
