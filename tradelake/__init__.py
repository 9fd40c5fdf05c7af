"""A Spark-first engine for hierarchical, revisable monthly trade facts."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so they need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
