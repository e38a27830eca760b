"""Operators for preparing training data. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel by value, so executors need no copy of the library on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
