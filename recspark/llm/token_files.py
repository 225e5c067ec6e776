"""Token-id files: whole texts as ids in document order, range-coded in independent blocks, and their reader.

Writing: the rows are range-partitioned and sorted by id; each task tokenises its slice, appends the end id to
every document and packs whole documents into blocks of about ``block_ids`` ids (``idcoder``: adaptive
order-0 to order-2 mixing, models reset and a CRC-32 per block).  A token file is a folder of Parquet files with one
row per block: slice, block, first (ids of the slice before it), n_ids, n_docs, data.  The coded block is self-contained; the other columns
let a reader find documents and offsets without decoding.

Reading: blocks are decoded independently, each checked against its CRC.  Offsets of documents need the totals of the
slices before: at most 2^18 rows (``input_slices``), which is what is broadcast.

Defined cases: a null text is empty (just the end id); null ids sort first and come back null; rows with equal ids are
separate documents, in the order of their text; an empty table gives a token file without blocks and an empty
result; extra columns are ignored.  A damaged block fails the job.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recspark.functions.shipping import ship_by_value
from recspark.llm.common import col, in_id_order, input_slices, lean
from recspark.llm.idcoder import read_block, write_block
from recspark.llm.pieces import text_batches, worker_encoder
from recspark.session import scratch_path

ship_by_value(__name__)

BLOCKS = "slice int, block int, first long, n_ids long, n_docs long, data binary"
DOCS = "slice int, doc_id long, local long, n_tokens long, ids_crc32 long"
MOST_SLICES = 1 << 18


def _writer(path: str, style: str, end_id: int, block_ids: int):
    def write(batches):
        from pyspark import TaskContext

        enc = worker_encoder(path, style)
        here, block, first = TaskContext.get().partitionId(), 0, 0
        held, size = [], 0

        def flush():
            nonlocal held, size, block, first
            doc_ids = [d for h in held for d in h[0]]
            lengths, ids = (np.concatenate([h[k] for h in held]) for k in (1, 2))
            row = (here, block, first, len(ids), len(doc_ids), write_block(doc_ids, lengths, ids))
            block, first, held, size = block + 1, first + len(ids), [], 0
            return pd.DataFrame([row], columns=["slice", "block", "first", "n_ids", "n_docs", "data"])

        for batch in batches:
            texts, doc_ids = batch["text"].tolist(), [None if pd.isna(d) else int(d) for d in batch["doc_id"].tolist()]
            for lo, hi in text_batches(texts):
                flat, counts, _ = enc.encode(texts[lo:hi])
                held.append((doc_ids[lo:hi], counts + 1, np.insert(flat, np.cumsum(counts), np.uint32(end_id))))
                size += len(held[-1][2])
                if size >= block_ids:
                    yield flush()
        if held:
            yield flush()

    return write


def _read(batches):
    for batch in batches:
        for row in batch.itertuples(index=False):
            doc_ids, lengths, ids = read_block(row.data)
            ends = np.cumsum(lengths)
            raw = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip((ends - lengths).tolist(), ends.tolist())]
            yield pd.DataFrame({"slice": np.full(len(ends), row.slice, np.int32), "doc_id": pd.array(doc_ids, dtype="Int64"),
                                "local": row.first + ends - lengths, "n_tokens": lengths, "ids_crc32": np.array(crc, np.int64)})


def write_token_file(docs: DataFrame, path: str, tokenizer: str, style: str, end_id: int = 1, block_ids: int = 1 << 20,
                     slice_bytes: int = 16 << 20, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of all texts, in ascending id order, as a token file at ``path``."""
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0  # one number
    slices = input_slices(size, slice_bytes, most=MOST_SLICES)
    ordered = in_id_order(rows, slices)
    (ordered.mapInPandas(lean(_writer(tokenizer, style, end_id, block_ids)), BLOCKS)
     .write.option("compression", "none").parquet(path))


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    blocks = spark.read.schema(BLOCKS).parquet(path)
    ahead = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)  # over the slices, at most MOST_SLICES rows
    base = (blocks.groupBy("slice").agg(F.sum("n_ids").alias("n"))
            .select("slice", F.coalesce(F.sum("n").over(ahead), F.lit(0)).cast("long").alias("base")))
    docs = blocks.select("slice", "first", "data").mapInPandas(lean(_read), DOCS)
    return (docs.join(F.broadcast(base), "slice")
            .select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"))


def token_file_round_trip(docs: DataFrame, tokenizer: str, style: str, **options) -> DataFrame:
    path = scratch_path(docs.sparkSession, "token-file")
    write_token_file(docs, path, tokenizer, style, **options)
    return read_token_file(docs.sparkSession, path)
