"""Operators for building training data from a corpus, one module each."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel to the executors by value: nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
