"""Operators of a training-data pipeline. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions travel to the executors whole, so these need not have the library installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
