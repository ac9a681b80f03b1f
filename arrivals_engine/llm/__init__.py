"""Operators of a training-data pipeline; nothing else in the library imports this."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to executors whole, so that these need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
