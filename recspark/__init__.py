"""recspark: collaborative-filtering analytics on Spark DataFrames.

Every public function takes DataFrames (or a SparkSession plus a path) and
returns a lazy DataFrame; nothing is collected to the driver except
one-row sizing statistics.
"""

from recspark.session import build_session, checkpoint_dir, scratch_path

__all__ = ["build_session", "checkpoint_dir", "scratch_path"]
