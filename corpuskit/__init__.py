"""Corpus preparation and language-model application analytics on Spark."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors whole, so tasks that run them need
# no copy of the package there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
