"""Incremental pair sums and ingestion across runs, replays, conflicts and compaction."""

import random

import pytest
from pyspark.sql import functions as F

from recspark.operators.similarity import cross_pair_sums, pair_sums, rating_cells
from recspark.session import materialize, scratch_path
from recspark.sources import commit_log
from recspark.sources.commit_log import CommitLog, LogState
from recspark.streaming import events, incremental
from recspark.streaming.events import EVENT_SCHEMA, ingest, read_sink
from recspark.streaming.incremental import apply_batch, compact, current_sums, start_state, stored_cells, stream_pair_updates

RATINGS = "review_id long, uid long, iid long, stars int, date timestamp_ntz"


def ratings(spark, rows):
    return spark.createDataFrame([(k, u, i, s, None) for k, (u, i, s) in enumerate(rows)], RATINGS)


def sums(df):
    return sorted(tuple(r) for r in df.select("i", "j", "n", "sx", "sy", "sxx", "syy", "sxy").where("n > 0").collect())


def random_rows(rng, n, users=12, items=9):
    return [(rng.choice([0, 0, 0, *range(users)]), rng.randrange(items), rng.randint(1, 5)) for _ in range(n)]


@pytest.mark.parametrize("heavy", [2, 2048])
def test_cross_sums_are_the_missing_products(spark, heavy):
    rng = random.Random(3)
    a, b = random_rows(rng, 60), random_rows(rng, 150, users=20)
    cells = [materialize(rating_cells(ratings(spark, x))) for x in (a, b)]
    cross = {r[:2]: r[2:] for r in sums(cross_pair_sums(*cells, heavy_cells=heavy))}
    want = {}
    for u, i, x in a:
        for v, j, y in b:
            if u == v and i != j:
                (p, q), (x2, y2) = sorted((i, j)), (x, y) if i < j else (y, x)
                t = want.setdefault((p, q), [0] * 6)
                for k, z in enumerate((1, x2, y2, x2 * x2, y2 * y2, x2 * y2)):
                    t[k] += z
    assert cross == {k: tuple(v) for k, v in want.items()}


def test_two_checkpoints_add_up(spark):
    """The measured loss: a base and two sources through two checkpoints."""
    parts = [[(1, 1, 5), (2, 2, 3)], [(1, 2, 4), (2, 3, 1)], [(1, 3, 2), (2, 1, 5)]]
    state = scratch_path(spark, "state")
    start_state(ratings(spark, parts[0]), state)
    for part in parts[1:]:
        source = scratch_path(spark, "source")
        ratings(spark, part).write.parquet(source)
        stream_pair_updates(spark, source, ratings(spark, []).schema, state, scratch_path(spark, "ckpt"))
    assert sums(current_sums(spark, state)) == sums(pair_sums(ratings(spark, [r for p in parts for r in p])))
    assert stored_cells(spark, state, CommitLog(spark, state).state()).count() == 6


def test_runs_replays_and_compaction(spark):
    rng = random.Random(7)
    parts = [random_rows(rng, 40) for _ in range(5)]
    state = scratch_path(spark, "state")
    start_state(ratings(spark, parts[0]), state, buckets=4)
    with pytest.raises(ValueError):
        start_state(ratings(spark, parts[0]), state)
    for k, part in enumerate(parts[1:4]):
        for _ in range(2):  # replayed
            apply_batch(spark, ratings(spark, part), k // 2, state, run=f"run{k % 2}")
    whole = lambda n: sums(pair_sums(ratings(spark, [r for p in parts[:n] for r in p])))
    assert sums(current_sums(spark, state)) == whole(4)
    compact(spark, state)
    log = CommitLog(spark, state).state()
    assert [x["kind"] for x in log.items.values()] == ["cells", "deltas"] and sums(current_sums(spark, state)) == whole(4)
    apply_batch(spark, ratings(spark, parts[1]), 0, state, run="run0")  # replayed after compaction
    apply_batch(spark, ratings(spark, parts[4]), 5, state, run="run1")
    assert sums(current_sums(spark, state)) == whole(5)


def test_a_batch_reads_only_the_buckets_of_its_users(spark, monkeypatch):
    state, read = scratch_path(spark, "state"), []
    start_state(ratings(spark, [(u, i, 1 + u % 5) for u in range(100) for i in range(3)]), state, buckets=16)
    original = incremental.stored_cells

    def noted(spark_, root, log, buckets=None):
        df = original(spark_, root, log, buckets)
        if buckets is not None:
            read.append(df)
        return df

    monkeypatch.setattr(incremental, "stored_cells", noted)
    apply_batch(spark, ratings(spark, [(7, 5, 4), (7, 6, 1), (8, 9, 2)]), 0, state)
    assert len(read) == 1
    seen, users = read[0].count(), {r.uid for r in read[0].select("uid").distinct().collect()}
    buckets = {r[0] for r in read[0].select(F.pmod(F.xxhash64("uid"), F.lit(16))).distinct().collect()}
    assert {7, 8} <= users and len(buckets) <= 2 and seen == 3 * len(users) and seen < 100
    assert all(f.split("bucket=")[1].split("/")[0] in map(str, buckets) for f in read[0].inputFiles())


def test_a_batch_that_another_run_overtakes_counts_its_pairs(spark, monkeypatch):
    state = scratch_path(spark, "state")
    a, b = [(1, 2, 4), (2, 5, 1)], [(1, 3, 2), (2, 6, 5)]
    start_state(ratings(spark, [(1, 1, 5)]), state)
    commit, calls = CommitLog.commit, []

    def late(self, log_state, run, batch, **kw):
        if run == "slow" and not calls:
            calls.append(run)
            apply_batch(spark, ratings(spark, b), 0, state, run="fast")
        return commit(self, log_state, run, batch, **kw)

    monkeypatch.setattr(CommitLog, "commit", late)
    apply_batch(spark, ratings(spark, a), 0, state, run="slow")
    assert sums(current_sums(spark, state)) == sums(pair_sums(ratings(spark, [(1, 1, 5), *a, *b])))


def test_log_snapshots_and_conflicts(spark, monkeypatch):
    monkeypatch.setattr(commit_log, "SNAPSHOT", 4)
    log = CommitLog(spark, scratch_path(spark, "log"))
    state = log.state()
    assert state == LogState()
    for k in range(11):
        assert log.commit(state, "r", k, add=[{"path": f"p{k}"}], drop=[f"p{k - 1}"] if k % 3 == 2 else [], settings={"k": k})
    stale = LogState(version=5)
    assert not log.commit(stale, "other", 0) and log.state() == state and state.done("r", 10) and not state.done("r", 11)
    assert list(state.items) == ["p0", "p2", "p3", "p5", "p6", "p8", "p9", "p10"] and state.settings == {"k": 10}


# ---- events ----

def events_of(spark, rows):
    return spark.createDataFrame([(i, None, u, "x", float(u), None) for i, u in rows], EVENT_SCHEMA)


def deliver(spark, sink, *batches):
    for rows in batches:
        source = scratch_path(spark, "ev")
        events_of(spark, rows).coalesce(1).write.parquet(source)
        ingest(spark, source, sink, scratch_path(spark, "ev-ckpt"))
    return sorted(((r.event_id, r.user_id) for r in read_sink(spark, sink).collect()), key=repr)


def test_events_without_a_number_are_kept(spark):
    rows = [(5, 1), *[(None, k) for k in range(9)], (None, 3)]
    sink = scratch_path(spark, "sink")
    assert deliver(spark, sink, rows) == sorted(rows, key=repr)  # 11 of 11
    # delivered again with one more of each kind: what is stored is told by number, or else by content
    assert deliver(spark, sink, [*rows, (6, 1), (None, 77)]) == sorted([*rows, (6, 1), (None, 77)], key=repr)


def test_repeats_inside_and_across_batches(spark):
    sink = scratch_path(spark, "sink")
    got = deliver(spark, sink, [(1, 1), (1, 1), (2, 2)], [], [(2, 2), (3, 3)], [(1, 1)])
    assert got == [(1, 1), (2, 2), (3, 3)]
    assert read_sink(spark, scratch_path(spark, "no-sink")).count() == 0


def test_a_long_sink_reads_only_overlapping_folders(spark, monkeypatch):
    sink = scratch_path(spark, "sink")
    deliver(spark, sink, [(k, k) for k in range(500_000, 500_020)])
    log = CommitLog(spark, sink)
    state = log.state()
    missing = [{"path": f"data/gone{k}", "lo": 10 * k, "hi": 10 * k + 9, "rows": 10, "unnumbered": 0} for k in range(1000)]
    assert log.commit(state, "past", 999, add=missing)  # folders that are not there: reading one would fail
    assert events.overlapping(state, 25, 41) == ["data/gone2", "data/gone3", "data/gone4"]
    events.store_batch(events_of(spark, [(500_010, 1), (500_100, 2)]), sink, "now", 0)
    last = list(log.state().items.values())[-1]
    assert (last["lo"], last["hi"], last["rows"]) == (500_100, 500_100, 1)
