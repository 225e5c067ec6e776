"""Training-data pipeline operators (search, WARC, deduplication, mixing, token files,
language identification, packing, secret scans) and their registered queries.

Nothing outside this package imports it; ``__spark_entry__.py`` adds its queries
when it is present.
"""

from recspark.llm.queries import QUERIES, SQL  # noqa: F401

__all__ = ["QUERIES", "SQL"]
