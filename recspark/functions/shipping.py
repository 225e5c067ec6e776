"""Ship executor-side Python by value.

Functions that run inside ``applyInPandas`` / ``mapInPandas`` are pickled
with their module registered for pickle-by-value, so executors need only
numpy and pandas, not this package on their path.
"""

from __future__ import annotations

import sys


def ship_by_value(module_name: str) -> None:
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[module_name])
