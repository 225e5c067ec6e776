"""Event feed and incremental model updates."""

from __future__ import annotations

from pyspark.sql import functions as F

from recspark.session import scratch_path
from recspark.sources.files import REVIEW_SCHEMA
from recspark.sources.tables import events as events_table
from recspark.streaming.events import EVENT_SCHEMA, fetch_since, ingest, next_sequence, read_sink
from recspark.streaming.incremental import compact, current_sums, start_state, stream_pair_updates
from recspark.plans import fixture as fx
from recspark.plans import core  # noqa: F401  (registers join_corated_pairs, whose SQL T3 reuses)
from recspark.plans.registry import REGISTRY, register

EV_COLS = "event_id, ts, user_id, event_type, value, props"
MID = "(SELECT (min(event_id) + max(event_id)) // 2 FROM events)"
NEW_SINCE, RESTART_SINCE = "1999-01-01", "2000-06-01"


def _mid(ev):
    """Resume point derived from the table itself: the middle sequence number."""
    return ev.agg(F.floor((F.min("event_id") + F.max("event_id")) / 2).cast("long").alias("m")).select("m").scalar()


@register("stream_fetch_since", f"SELECT {EV_COLS} FROM events WHERE event_id >= {MID}", ops="T1")
def q_fetch_since(spark, d):
    ev = events_table(spark, d)
    return fetch_since(ev, _mid(ev))


@register("stream_next_sequence", f"""
    SELECT CAST({MID} AS BIGINT) AS since, COALESCE(max(event_id) + 1, CAST({MID} AS BIGINT)) AS next_seq,
           count(*) AS n_rows FROM events WHERE event_id >= {MID}""", ops="T1")
def q_next_sequence(spark, d):
    ev = events_table(spark, d)
    return next_sequence(ev, _mid(ev))


@register("stream_ingest_events", f"SELECT {EV_COLS} FROM events", ops="T2 Q13")
def q_ingest(spark, d):
    sink = scratch_path(spark, "events-sink")
    # a glob, so the file source watches the folder for this table's file(s)
    ingest(spark, f"{d.rstrip('/')}/event[s].parquet", sink, scratch_path(spark, "events-ckpt"), EVENT_SCHEMA)
    return read_sink(spark, sink).select(*EV_COLS.split(", "))


def _incremental_state(spark, d, later=()):
    """A state begun with the ratings before ``NEW_SINCE``; the rest arrives in one or more sources, each read through a checkpoint of its own."""
    ratings = fx.fx_ratings(spark, d).select("review_id", "uid", "iid", "stars", "date")
    cuts = [F.lit(f"{x} 00:00:00").cast("timestamp_ntz") for x in (NEW_SINCE, *later)]
    state = scratch_path(spark, "pairs-state")
    start_state(ratings.where(F.col("date") < cuts[0]), state)
    for lo, hi in zip(cuts, [*cuts[1:], None]):
        source = scratch_path(spark, "new-ratings")
        new = ratings.where(F.col("date") >= lo)
        (new if hi is None else new.where(F.col("date") < hi)).write.parquet(source)   # the arriving files
        stream_pair_updates(spark, source, REVIEW_SCHEMA, state, scratch_path(spark, "pairs-ckpt"), max_files_per_trigger=3)
    return state


PAIR_COLS = ("i", "j", "n", "sx", "sy", "sxx", "syy", "sxy")


@register("stream_incremental_pairs", REGISTRY["join_corated_pairs"].sql, ops="T3")
def q_incremental_pairs(spark, d):
    return current_sums(spark, _incremental_state(spark, d)).select(*PAIR_COLS)


@register("stream_incremental_pairs_restarted", REGISTRY["join_corated_pairs"].sql, ops="T3")
def q_incremental_pairs_restarted(spark, d):
    """Two sources through two checkpoints: the second run continues from what the first has stored."""
    return current_sums(spark, _incremental_state(spark, d, (RESTART_SINCE,))).select(*PAIR_COLS)


@register("stream_pairs_compacted", REGISTRY["join_corated_pairs"].sql, ops="T3")
def q_pairs_compacted(spark, d):
    """All deltas and cell folders of a run replaced by one of each."""
    state = _incremental_state(spark, d)
    compact(spark, state)
    return current_sums(spark, state).select(*PAIR_COLS)


@register("stream_ingest_redelivered", f"SELECT {EV_COLS} FROM events", ops="T2")
def q_ingest_redelivered(spark, d):
    """The same events staged twice, read from two checkpoints: every event is stored once."""
    source, sink = scratch_path(spark, "events-staged"), scratch_path(spark, "events-sink")
    ev = events_table(spark, d).select(*EV_COLS.split(", "))
    ev.write.parquet(source)
    ev.where(F.col("event_id") >= _mid(ev)).write.mode("append").parquet(source)   # delivered again
    ingest(spark, source, sink, scratch_path(spark, "events-ckpt"), EVENT_SCHEMA, max_files_per_trigger=1)
    ingest(spark, source, sink, scratch_path(spark, "events-ckpt"), EVENT_SCHEMA)
    return read_sink(spark, sink).select(*EV_COLS.split(", "))
