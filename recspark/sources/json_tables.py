"""The five JSON-lines tables of a public reviews dataset, by name, with declared schemas (all ids are strings)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recspark.sources.files import read_json_lines

# Column names and types of the tables' records.
_FIELDS = {
    "business": "business_id string, name string, address string, city string, state string, postal_code string, latitude double, "
                "longitude double, stars double, review_count long, is_open int, categories string",
    "review": "review_id string, user_id string, business_id string, stars double, date timestamp_ntz, text string, useful long, "
              "funny long, cool long",
    "user": "user_id string, name string, review_count long, yelping_since timestamp_ntz, useful long, funny long, cool long, "
            "fans long, average_stars double, elite string, friends string",
    "checkin": "business_id string, date string",
    "tip": "user_id string, business_id string, text string, date timestamp_ntz, compliment_count long",
}
TABLES = tuple(_FIELDS)


def table_schema(name: str) -> T.StructType:
    if name not in _FIELDS:
        raise ValueError(f"unknown table {name!r}, one of {TABLES}")
    return T.StructType.fromDDL(_FIELDS[name])


def read_named_tables(spark: SparkSession, folder: str, tables=("business", "review"), category: str | None = None,
                      state: str | None = None, mode: str = "FAILFAST") -> dict[str, DataFrame]:
    """{name: table} from ``folder``/<name>.json (a file or a folder).

    With ``category`` and/or ``state`` the businesses are filtered, and every chosen table with a
    business_id keeps the rows of those businesses (a semi-join that AQE broadcasts by measured size).
    """
    root = folder.rstrip("/")
    out = {t: read_json_lines(spark, f"{root}/{t}.json", table_schema(t), mode) for t in tables}
    if category is None and state is None:
        return out
    items = out.get("business")
    if items is None:
        items = read_json_lines(spark, f"{root}/business.json", table_schema("business"), mode)
    if state is not None:
        items = items.where(F.col("state") == state)
    if category is not None:
        items = items.where(F.col("categories").contains(category))
    keys = items.select("business_id").distinct()
    chosen = {t: df.join(keys, "business_id", "left_semi") if "business_id" in df.columns else df for t, df in out.items()}
    return chosen | ({"business": items} if "business" in out else {})
