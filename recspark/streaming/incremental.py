"""Incremental co-rating sums: add new ratings to the model without a full recompute.

Pair sums are products of rating cells (user, item) -> (count, sum, sum of squares) added over users, so new ratings change
them by

    delta = new x new + new x old        (old: the stored cells of the batch's users)

and nothing that is stored is multiplied again.  The state is a folder with a commit log (``sources.commit_log``):

* cells: one folder per batch, cut into hash buckets of the user; a batch reads the buckets of its own users, no others;
* deltas: one table of pair sums per batch; the model is their sum.

A batch belongs to a run (the streaming query's id, which lives in its checkpoint): a replayed batch finds itself in the log, a new
checkpoint is a new run and continues from what all runs have stored.  When two runs commit at a time the second one finds the
log ahead of what it has read and computes its delta again, so no pair between their ratings is lost.  :func:`compact` replaces all
deltas by their sum and all cell folders by one; old files stay on disk for readers that have just opened them.

Ratings are told apart by nothing but the batch they come in (a repeated review counts again, as it would in one table);
:mod:`recspark.streaming.events` drops events that are delivered twice.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recspark.operators.similarity import SUM_COLS, pair_sum_updates, pair_sums_of_cells, rating_cells
from recspark.sources.commit_log import CommitLog, LogState
from recspark.streaming.events import for_each_batch

RATING_COLS = ("review_id", "uid", "iid", "stars", "date")
CELLS = "uid long, iid long, c long, s double, q double"
DELTAS = "i long, j long, n long, " + ", ".join(f"{c} long" for c in SUM_COLS)
BUCKETS = 64


def _bucket(buckets: int):
    return F.pmod(F.xxhash64(F.col("uid").cast("long")), F.lit(buckets)).cast("int")


def _write_cells(cells: DataFrame, root: str, buckets: int) -> dict:
    """Write cells by bucket; the log item names the buckets that have any."""
    path = f"cells/{uuid.uuid4().hex}"
    typed = cells.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(CELLS)])
    typed.withColumn("bucket", _bucket(buckets)).repartition("bucket").write.partitionBy("bucket").parquet(f"{root}/{path}")
    written = cells.sparkSession.read.schema(f"{CELLS}, bucket int").parquet(f"{root}/{path}")
    return {"path": path, "kind": "cells", "buckets": sorted(r[0] for r in written.select("bucket").distinct().collect())}  # at most ``buckets``


def _write_deltas(sums: DataFrame, root: str) -> dict:
    path = f"deltas/{uuid.uuid4().hex}"
    sums.select("i", "j", "n", *SUM_COLS).write.parquet(f"{root}/{path}")
    return {"path": path, "kind": "deltas"}


def stored_cells(spark: SparkSession, root: str, state: LogState, buckets=None) -> DataFrame:
    """The stored cells, those of some buckets only if ``buckets`` names them."""
    wanted = None if buckets is None else set(buckets)
    paths = [f"{root}/{x['path']}/bucket={b}" for x in state.items.values() if x["kind"] == "cells"
             for b in x["buckets"] if wanted is None or b in wanted]
    return spark.read.schema(CELLS).parquet(*paths) if paths else spark.createDataFrame([], CELLS)


def _added(parts: DataFrame) -> DataFrame:
    return parts.groupBy("i", "j").agg(*[F.sum(c).cast("bigint").alias(c) for c in ("n", *SUM_COLS)])


def _stored_deltas(spark: SparkSession, root: str, state: LogState) -> DataFrame:
    paths = [f"{root}/{x['path']}" for x in state.items.values() if x["kind"] == "deltas"]
    return spark.read.schema(DELTAS).parquet(*paths) if paths else spark.createDataFrame([], DELTAS)


def current_sums(spark: SparkSession, state_dir: str) -> DataFrame:
    """(i, j, n, sx, sy, sxx, syy, sxy) over all ratings that any run has added."""
    root = state_dir.rstrip("/")
    return _added(_stored_deltas(spark, root, CommitLog(spark, root).state())).where(F.col("n") > 0)


def start_state(base: DataFrame, state_dir: str, buckets: int = BUCKETS) -> None:
    """Begin a state with the ratings of ``base``; ``buckets`` should grow with the users (a batch reads whole buckets)."""
    root = state_dir.rstrip("/")
    log = CommitLog(base.sparkSession, root)
    state = log.state()
    if state.version >= 0:
        raise ValueError(f"{state_dir} holds a state already")
    cells = _write_cells(rating_cells(base), root, buckets)
    stored = stored_cells(base.sparkSession, root, LogState(items={"base": cells}))
    if not log.commit(state, "base", 0, add=[cells, _write_deltas(pair_sums_of_cells(stored), root)], settings={"buckets": buckets}):
        raise ValueError(f"{state_dir} was begun by another writer")


def apply_batch(spark: SparkSession, batch: DataFrame, batch_id: int, state_dir: str, run: str = "manual") -> None:
    """Add the ratings of a batch to the state; nothing if the run's batch is in the log already."""
    root = state_dir.rstrip("/")
    log = CommitLog(spark, root)
    cells = new = None
    while True:
        state = log.state()
        if state.version < 0:
            raise ValueError(f"{state_dir} holds no state: call start_state first")
        if state.done(run, batch_id):
            return
        if cells is None:  # the batch's own part does not depend on what others store
            cells = _write_cells(rating_cells(batch), root, state.settings["buckets"])
            new = stored_cells(spark, root, LogState(items={"new": cells}))
        old = stored_cells(spark, root, state, cells["buckets"])
        if log.commit(state, run, batch_id, add=[cells, _write_deltas(pair_sum_updates(new, old), root)]):
            return


def compact(spark: SparkSession, state_dir: str) -> None:
    """Replace the deltas by their sum and the cell folders by one; the model stays the same."""
    root = state_dir.rstrip("/")
    log = CommitLog(spark, root)
    state = log.state()
    old = list(state.items)
    if len(old) <= 2:
        return
    cells = stored_cells(spark, root, state).groupBy("uid", "iid").agg(*[F.sum(c).alias(c) for c in "csq"])
    add = [_write_cells(cells, root, state.settings["buckets"]), _write_deltas(_added(_stored_deltas(spark, root, state)), root)]
    run = f"compaction-{uuid.uuid4().hex}"
    while not log.commit(state, run, 0, add=add, drop=old):
        state = log.state()  # batches that came meanwhile stay as they are
        if not set(old) <= set(state.items):
            return  # another compaction was first


def stream_pair_updates(spark: SparkSession, source: str, schema: T.StructType, state_dir: str,
                        checkpoint_location: str, max_files_per_trigger: int | None = None,
                        trigger: str = "availableNow", interval: str = "30 seconds", wait: bool = True):
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    write = lambda df, run, batch_id: apply_batch(spark, df, batch_id, state_dir, run)
    return for_each_batch(reader.load(source), write, checkpoint_location, trigger, interval, wait)
