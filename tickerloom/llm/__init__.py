"""Operators for preparing training text. Nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value: they need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
