"""Filtered review load (scan + pushed filter + join), replacing a chunked loader.

The item side is filtered first; Spark pushes the filters into the parquet
scan and AQE turns the join into a broadcast join at run time when the
filtered item side is below ``spark.sql.autoBroadcastJoinThreshold`` (a
size-checked broadcast); otherwise it stays a shuffle join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.functions.exprs import year_start


def load_reviews(reviews: DataFrame, items: DataFrame, category: str | None = None,
                 state: str | None = None, since_year: int | None = None,
                 how: str = "inner") -> DataFrame:
    """Reviews joined to the items of one category/state.

    ``how='inner'`` keeps matching reviews only (default); ``how='left'``
    keeps every review with nulls for items outside the selection.
    """
    sel = items
    if state is not None:
        sel = sel.where(F.col("state") == F.lit(state))
    if category is not None:
        sel = sel.where(F.col("categories").isNotNull() & F.col("categories").like(f"%{category}%"))
    r = reviews
    if since_year is not None:
        r = r.where(F.col("date") >= year_start(since_year))
    return r.join(sel, "iid", how)


def union_chunks(chunks: list[DataFrame]) -> DataFrame:
    """UNION ALL of per-chunk results, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b), chunks)
