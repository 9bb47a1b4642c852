"""Clip scoring and corpus preparation as Spark jobs."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so no package install is needed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
