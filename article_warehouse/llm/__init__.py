"""Operators for preparing training data.

All of them read columns ``doc_id`` and ``text`` and return columns of their own, so that other
columns of the input, whatever their names, neither clash nor matter. Null texts count as empty,
empty tables give empty results, rows that repeat are rows of their own.
"""

import sys

from pyspark import cloudpickle

# Functions go to the executors by value, so that the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
