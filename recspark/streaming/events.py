"""Incremental event fetch and ingestion.

The event feed is a table with a monotonically increasing sequence
number.  ``fetch_since`` is the batch form (rows with seq >= n and the
next number to ask for); ``ingest`` is the streaming form: a file
source read with Structured Streaming, written by ``foreachBatch``.

Exactly-once effect: a micro-batch writes its rows to a folder of its own
and then commits it in the sink's log (``sources.commit_log``) under the
query id, which lives in the checkpoint, and the batch id.  A batch
replayed after a crash finds itself in the log and does nothing; a folder
without an entry is not read; a new checkpoint is a new run and replaces
nothing.  An entry holds the range of sequence numbers of its rows, so
events delivered again are looked for only in the folders whose range
overlaps the batch's, and only in their number column.

Events without a number cannot be told apart by it: all those of a batch
are stored, except ones whose whole content another batch has stored
(only folders that hold such events are read for that).
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recspark.sources.commit_log import CommitLog, LogState

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def fetch_since(events: DataFrame, n, seq: str = "event_id") -> DataFrame:
    """Rows with sequence number >= n (n: int or a one-value Column)."""
    bound = n if not isinstance(n, int) else F.lit(n)
    return events.where(F.col(seq) >= bound)


def next_sequence(events: DataFrame, n, seq: str = "event_id") -> DataFrame:
    """One row (since, next_seq, n_rows): next_seq = max(seq) + 1 of the new rows, or n if none."""
    bound = n if not isinstance(n, int) else F.lit(n)
    new = fetch_since(events, bound, seq)
    return new.agg(F.max(seq).alias("mx"), F.count(F.lit(1)).alias("n_rows")).select(
        bound.cast("long").alias("since"),
        F.coalesce(F.col("mx") + 1, bound.cast("long")).alias("next_seq"),
        "n_rows")


def for_each_batch(stream: DataFrame, write, checkpoint_location: str, trigger: str = "availableNow",
                   interval: str = "30 seconds", wait: bool = True):
    """Run ``write(batch, run, batch_id)`` per micro-batch; ``run`` is the query id, which lives in the checkpoint."""
    started, query_id = threading.Event(), []

    def each(df: DataFrame, batch_id: int) -> None:
        if not started.wait(300):
            raise RuntimeError("the query did not report its id")
        write(df, query_id[0], batch_id)

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if trigger == "availableNow" else w.trigger(processingTime=interval)
    q = w.start()
    query_id.append(q.id)
    started.set()
    if wait:
        q.awaitTermination()
    return q


def ingest(spark: SparkSession, source: str, sink: str, checkpoint_location: str,
           schema: T.StructType = EVENT_SCHEMA, fmt: str = "parquet", trigger: str = "availableNow",
           interval: str = "30 seconds", max_files_per_trigger: int | None = None, wait: bool = True,
           seq: str | None = "event_id"):
    """Stream files under ``source`` into ``sink`` (parquet), one folder per micro-batch and a log.

    ``seq`` is the sequence number by which events are told apart; None stores every row as it comes.

    trigger='availableNow' drains what is there and stops (tests, backfill);
    trigger='processingTime' polls every ``interval``.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    write = lambda df, run, batch_id: store_batch(df, sink, run, batch_id, seq)
    return for_each_batch(reader.load(source), write, checkpoint_location, trigger, interval, wait)


def store_batch(batch: DataFrame, sink: str, run: str, batch_id: int, seq: str | None = "event_id") -> None:
    """Store the events of a batch that the sink does not hold; nothing if the batch is in the log already."""
    spark, root = batch.sparkSession, sink.rstrip("/")
    log = CommitLog(spark, root)
    while True:
        state = log.state()
        if state.done(run, batch_id):
            return
        path = f"data/{uuid.uuid4().hex}"
        _unseen(batch, root, state, seq).write.parquet(f"{root}/{path}")
        rows = spark.read.schema(batch.schema).parquet(f"{root}/{path}")
        numbers = F.col(seq) if seq else F.lit(None).cast("long")
        found = rows.agg(F.min(numbers).alias("lo"), F.max(numbers).alias("hi"), F.count(F.lit(1)).alias("rows"),
                         F.count(numbers).alias("numbered")).first()  # one row
        item = {"path": path, "lo": found["lo"], "hi": found["hi"], "rows": found["rows"], "unnumbered": found["rows"] - found["numbered"]}
        if log.commit(state, run, batch_id, add=[item]):
            return  # else another run was first and may have stored some of these events: look again


def overlapping(state: LogState, lo, hi) -> list[str]:
    """Paths of the folders whose range of numbers overlaps lo..hi."""
    return [x["path"] for x in state.items.values() if x["lo"] is not None and x["lo"] <= hi and x["hi"] >= lo]


def _unseen(batch: DataFrame, root: str, state: LogState, seq: str | None) -> DataFrame:
    """The events of a batch, each number once, that no folder in the log holds."""
    if seq is None:
        return batch
    spark = batch.sparkSession
    read = lambda paths: spark.read.schema(batch.schema).parquet(*[f"{root}/{p}" for p in paths])
    numbered, rest = batch.where(F.col(seq).isNotNull()).dropDuplicates([seq]), batch.where(F.col(seq).isNull())
    span = batch.agg(F.min(seq).alias("lo"), F.max(seq).alias("hi"), F.count_if(F.col(seq).isNull()).alias("unnumbered")).first()  # one row
    paths = overlapping(state, span["lo"], span["hi"]) if span["lo"] is not None else []
    if paths:
        numbered = numbered.join(read(paths).select(seq).where(F.col(seq).between(span["lo"], span["hi"])), seq, "left_anti").select(*batch.columns)
    paths = [x["path"] for x in state.items.values() if x["unnumbered"]] if span["unnumbered"] else []
    if paths:
        content = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in batch.columns])), 256)
        stored = read(paths).where(F.col(seq).isNull()).select(content.alias("_content")).distinct()
        rest = rest.withColumn("_content", content).join(stored, "_content", "left_anti").select(*batch.columns)
    return numbered.unionByName(rest)


def read_sink(spark: SparkSession, sink: str, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """All ingested rows: those of the folders in the log."""
    root = sink.rstrip("/")
    paths = [f"{root}/{x['path']}" for x in CommitLog(spark, root).state().items.values() if x["rows"]]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
