"""Operators for training-data pipelines, and the queries that apply them to whole tables.

Functions of this package travel to the executors by value, so that tasks don't need
the package installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
