"""tideline: near-real-time analytics as plain Spark DataFrames and streams."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so these need not have it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
