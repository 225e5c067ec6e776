"""Streaming: availableNow over staged files, run twice from one checkpoint."""

from pyspark.sql import functions as F

from recspark.session import scratch_path
from recspark.streaming.events import EVENT_SCHEMA, fetch_since, ingest, next_sequence, read_sink

from conftest import SMOKE


def test_ingest_twice_from_one_checkpoint(spark):
    ev = spark.read.parquet(f"{SMOKE}/events.parquet")
    src = scratch_path(spark, "ev-src")
    ev.where(F.col("event_id") < 500).write.parquet(src)
    sink, ckpt = scratch_path(spark, "ev-sink"), scratch_path(spark, "ev-ckpt")
    ingest(spark, src, sink, ckpt, EVENT_SCHEMA)
    ingest(spark, src, sink, ckpt, EVENT_SCHEMA)          # restart: nothing new, nothing twice
    first = read_sink(spark, sink)
    assert first.count() == 500 and first.select("event_id").distinct().count() == 500
    ev.where(F.col("event_id") >= 500).write.mode("append").parquet(src)   # new files arrive
    ingest(spark, src, sink, ckpt, EVENT_SCHEMA)
    out = read_sink(spark, sink)
    assert out.count() == ev.count() and out.select("event_id").distinct().count() == ev.count()


def test_replayed_batch_is_idempotent(spark):
    """A crash between the sink write and the offset commit: the batch runs again from the same checkpoint."""
    import glob
    import os

    ev = spark.read.parquet(f"{SMOKE}/events.parquet")
    src, sink, ckpt = (scratch_path(spark, x) for x in ("ev-src", "ev-sink", "ev-ckpt"))
    ev.write.parquet(src)
    ingest(spark, src, sink, ckpt, EVENT_SCHEMA)
    commits = glob.glob(ckpt.replace("file:", "") + "/commits/*") + glob.glob(ckpt.replace("file:", "") + "/commits/.*.crc")
    assert commits
    for c in commits:
        os.remove(c)
    ingest(spark, src, sink, ckpt, EVENT_SCHEMA)
    assert read_sink(spark, sink).count() == ev.count() == read_sink(spark, sink).select("event_id").distinct().count()


def test_new_checkpoint_keeps_what_is_stored(spark):
    ev = spark.read.parquet(f"{SMOKE}/events.parquet")
    sink = scratch_path(spark, "ev-sink")
    for cond in (F.col("event_id") < 300, F.col("event_id") >= 200):
        src = scratch_path(spark, "ev-src")
        ev.where(cond).write.parquet(src)
        ingest(spark, src, sink, scratch_path(spark, "ev-ckpt"), EVENT_SCHEMA)
    out = read_sink(spark, sink)
    assert out.count() == ev.count() and out.exceptAll(ev.select(*out.columns)).count() == 0


def test_fetch_since_and_next(spark):
    ev = spark.read.parquet(f"{SMOKE}/events.parquet")
    mx = ev.agg(F.max("event_id")).first()[0]
    assert fetch_since(ev, mx + 1).count() == 0
    row = next_sequence(ev, mx + 1).first()
    assert (row.since, row.next_seq, row.n_rows) == (mx + 1, mx + 1, 0)
    row = next_sequence(ev, 10).first()
    assert row.next_seq == mx + 1 and row.n_rows == ev.where(F.col("event_id") >= 10).count()
