"""Operators for preparing training text. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so these need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
