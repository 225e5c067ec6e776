"""Scans of the given parquet tables and the two fixture views.

reviews: one row per rating event (review_id, uid, iid, stars 1..5, date).
items:   one row per item (iid, name, brand, categories, state, is_open).

Only the columns a view needs are selected, so the parquet scan reads
just those (ReadSchema) and later filters reach the scan (PushedFilters).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem JOIN orders re-read as a review table.

    Both sides are large: a shuffle (sort-merge) join on the order key; if the
    tables are bucketed by order key on the cluster the exchange disappears.
    """
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate"])
    od = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    return li.join(od, li.l_orderkey == od.o_orderkey, "inner").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("review_id"),
        F.col("o_custkey").alias("uid"),
        F.col("l_partkey").alias("iid"),
        (F.lit(1) + F.floor((F.col("l_quantity") - 1) / 10)).cast("int").alias("stars"),
        F.col("l_shipdate").alias("date"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part JOIN nation; nation has 25 rows (fixed size), so it is broadcast."""
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    return part.join(F.broadcast(nation), F.col("p_partkey") % 25 == F.col("n_nationkey"), "inner").select(
        F.col("p_partkey").alias("iid"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("categories"),
        F.col("n_name").alias("state"),
        F.when(F.col("p_size") % 5 != 0, 1).otherwise(0).alias("is_open"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")
