"""Exact deduplication by a tree merge of sorted digest runs.

Each input partition turns its rows into a run: one entry per distinct text, sorted by
digest, carrying the identifier that would stay, the number of rows and the verification
values (byte length and an independent 64-bit hash).  Runs are then merged in binomial rounds:
in round r the partitions whose numbers agree after dropping the lowest r digits (base
``fan_in``) exchange their runs and merge them multiway.  The digest space is cut into
shards (one per ``rows_per_shard`` rows, at least 64) and every shard has a tree of its own, so no task
ever holds the digests of the whole corpus: the last round leaves one run per shard.

Every level verifies what it merges: entries of one SHA-256 must agree on length and
second hash, otherwise the job fails instead of merging different texts.

Defined cases: a null text counts as empty; equality is of the exact text, nothing is
normalised; the row with the largest id stays (``keep="largest"``, or ``"smallest"``).  A null id never
wins over another one; in a group of null ids only, ``keep_id`` is null and all its rows are kept.
Repeated rows (same id and text) come back as often as they occur, with equal results.  An empty table gives an empty result.
Extra input columns are ignored by :func:`exact_dedup`, and kept by :func:`keep_first_copies`.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.llm.common import col, fresh, join_by_size, salted_left_join
from recspark.session import materialize


def _first_runs(digests: DataFrame, shards: int, keep: str) -> DataFrame:
    """Leaf runs: the rows of one text in one partition are one entry (summed in the task that read them)."""
    best = F.max if keep == "largest" else F.min
    return (digests
            .withColumn("shard", F.pmod(F.conv(F.substring("text_sha256", 1, 12), 16, 10).cast("long"), F.lit(shards)).cast("int"))
            .groupBy("shard", "run", "text_sha256")
            .agg(best("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"),
                 F.min(F.struct("n_bytes", "check")).alias("lo"), F.max(F.struct("n_bytes", "check")).alias("hi")))


def _merge_round(runs: DataFrame, fan_in: int, keep: str) -> DataFrame:
    """Runs whose numbers share all but their last base-``fan_in`` digit become one sorted run.

    The exchange brings the runs of one (shard, run) together, the sort merges them by digest, and the
    aggregate (sort-based, as its buffers hold structs) joins neighbours of one digest and leaves the run sorted.
    """
    best = F.max if keep == "largest" else F.min
    merged = (runs.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
              .repartition("shard", "run").sortWithinPartitions("shard", "run", "text_sha256")
              .groupBy("shard", "run", "text_sha256")
              .agg(best("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"),
                   F.min("lo").alias("lo"), F.max("hi").alias("hi")))
    differ = F.raise_error(F.concat(F.lit("different texts share the digest "), "text_sha256")).cast("boolean")
    return merged.where(F.when(F.col("lo") == F.col("hi"), F.lit(True)).otherwise(differ))


def digest_groups(digests: DataFrame, partitions: int, shards: int = 64, fan_in: int = 8, keep: str = "largest") -> DataFrame:
    """(text_sha256, keep_id, group_size): one row per distinct text, from the binomial merge.

    ``digests`` has doc_id, text_sha256, n_bytes, check and run (the partition number, below ``partitions``).
    """
    if keep not in ("largest", "smallest"):
        raise ValueError("keep must be 'largest' or 'smallest'")
    runs = _first_runs(digests, shards, keep)
    for _ in range(max(1, math.ceil(math.log(max(partitions, 2), fan_in) - 1e-9))):
        runs = _merge_round(runs, fan_in, keep)
    return runs.select("text_sha256", "keep_id", "group_size")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                rows_per_shard: int = 1_000_000, fan_in: int = 8, keep: str = "largest") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    text = F.coalesce(col(text_col), F.lit(""))
    digests = materialize(docs.select(
        col(id_col).alias("doc_id"), F.sha2(text.cast("binary"), 256).alias("text_sha256"),
        F.octet_length(text).cast("long").alias("n_bytes"), F.xxhash64(text).alias("check"),
        F.spark_partition_id().alias("run")), "digests")
    seen = digests.agg(F.max("run").alias("run"), F.count(F.lit(1)).alias("n")).first()  # two numbers
    groups = digest_groups(digests, (seen["run"] or 0) + 1, max(64, seen["n"] // rows_per_shard), fan_in, keep)
    copies = groups.where("group_size > 1")  # a text that occurs once needs no lookup
    out = salted_left_join(digests.select("doc_id", "text_sha256"), copies, ["text_sha256"], F.col("doc_id"))
    size = F.coalesce("group_size", F.lit(1).cast("long"))
    keep_id = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return (out.select("doc_id", keep_id.alias("keep_id"), size.alias("group_size"), "text_sha256")
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id"))))


def keep_first_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns (one row of each group of equal texts).

    Rows are matched by id and text digest; of repeated rows with equal id and text one stays.
    """
    key = fresh("copy_key", docs.columns)
    found = materialize(exact_dedup(docs, id_col, text_col, **options)
                        .select(_copy_key(F.col("doc_id"), F.col("text_sha256")).alias(key), "kept", "group_size"), "copies")
    sha = F.sha2(F.coalesce(col(text_col), F.lit("")).cast("binary"), 256)
    tagged = docs.withColumn(key, _copy_key(col(id_col), sha))
    left = join_by_size(tagged, found.where("NOT kept").select(key).distinct(), key, "left_anti", row_bytes=128)
    repeated = found.where("kept AND group_size > 1").groupBy(key).count().where("count > 1")
    return (left if repeated.isEmpty() else left.dropDuplicates([key])).drop(key)


def _copy_key(doc_id, sha):
    """One non-null string for id and text."""
    return F.concat_ws(":", sha, F.coalesce(doc_id.cast("string"), F.lit("-")))


SQL = """
    SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
           count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
           doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
           sha256(coalesce(text, '')) AS text_sha256
    FROM documents"""
