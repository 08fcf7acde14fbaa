"""Operators of a training-data pipeline, built on Spark DataFrames.

Nothing else in the library imports this package. Its functions travel to the
executors by value, so a job needs no copy of the package on each machine.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
