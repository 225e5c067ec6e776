"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.functions.shipping import ship_by_value

ship_by_value(__name__)

SALTS = 16


def fresh(stem: str, taken) -> str:
    """A column name that none of ``taken`` has (compared as Spark does, without case)."""
    low = {c.lower() for c in taken}
    return next(n for n in itertools.chain([stem], (f"{stem}_{k}" for k in itertools.count(1)))
                if n.lower() not in low)


def col(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def salted_left_join(left: DataFrame, right: DataFrame, keys: list[str], spread: Column,
                     salts: int = SALTS) -> DataFrame:
    """Left join for hot keys: every left row takes one of ``salts`` copies of its right row.

    ``right`` has one row per key and holds only keys that need a lookup (groups of at
    least two), so the copies stay small; a key with a third of all left rows is dealt
    to ``salts`` tasks.  ``spread`` decides the copy of a left row.  Keys compare by value: null keys match nothing.
    """
    salt = fresh("salt", [*left.columns, *right.columns])
    dealt = left.withColumn(salt, F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    copies = right.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(copies, [*keys, salt], "left").drop(salt)


def input_slices(rows_bytes: int, slice_bytes: int, least: int = 1, most: int = 1 << 16) -> int:
    """How many range slices an ordered job cuts its input into: by bytes, at most ``most``."""
    return int(max(least, min(most, -(-rows_bytes // slice_bytes))))


def join_by_size(rows: DataFrame, keys: DataFrame, key: str, how: str, row_bytes: int = 16, most_bytes: int = 32 << 20) -> DataFrame:
    """Semi or anti join of ``rows`` with a table of keys: by broadcast when the counted keys take at most ``most_bytes``, else by exchange."""
    small = keys.count() * row_bytes <= most_bytes
    return rows.join(F.broadcast(keys) if small else keys, key, how)


def in_id_order(rows: DataFrame, slices: int) -> DataFrame:
    """(doc_id, text) in range partitions by ascending id; the length parts rows that share an id or have none, so they fill several slices."""
    size = F.octet_length("text")
    return (rows.withColumn("size", size).repartitionByRange(slices, "doc_id", "size").sortWithinPartitions("doc_id", "size", "text")
            .select("doc_id", "text"))


def lean(task):
    """A function of mapInPandas or mapInArrow that gives unused memory back to the system when its partition ends.

    Spark keeps Python workers for the stages that follow; what a kernel has freed would otherwise stay with them.
    """
    def run(batches):
        try:
            yield from task(batches)
        finally:
            import ctypes

            import pyarrow

            pyarrow.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
            if trim is not None:
                trim(0)

    return run
