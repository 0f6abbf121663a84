"""Gazette-document analytics as composable Spark DataFrame transformations."""

import sys

from pyspark import cloudpickle

# Functions of this package that run in Python workers are shipped by value,
# so executors need no copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
