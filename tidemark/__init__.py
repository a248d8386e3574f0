"""tidemark: keep tables in sync, and query them, with PySpark DataFrames."""

import sys

from pyspark import cloudpickle

# Task functions travel by value, so executors need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
