"""Spark-native engine for observation tables: export, taxonomy, deltas, annotations, entity resolution."""

from pyspark import cloudpickle as _cloudpickle

# Functions sent to Python workers travel by value, so executors need no copy of this package.
_cloudpickle.register_pickle_by_value(__import__(__name__))
