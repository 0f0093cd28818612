"""Spark-native engine for building, auditing and scoring annotation datasets."""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions of this package travel to the executors by value, so these need not have it installed.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
