"""Incident and demographics analytics expressed as Spark DataFrame/SQL plans.

Sub-packages:

* ``functions`` – column expressions (range bucketing, money cleaning,
  timestamp parsing, great-circle distance) and the Arrow UDF variant.
* ``operators`` – DataFrame -> DataFrame building blocks (share of total,
  top-k per group, feature flattening, keyed joins with a chosen strategy,
  nearest-site search).
* ``sources`` – readers and writers for CSV, text, multi-line JSON and
  Parquet, plus adapters from the bundled test tables.
* ``plans`` – the four analyses, each in DataFrame and SQL form.
"""

import sys

from pyspark import cloudpickle

from beatwise.session import get_session, staging_path

# Ship this package's functions by value with each task, so Python workers
# need not have the package installed or on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["get_session", "staging_path"]
