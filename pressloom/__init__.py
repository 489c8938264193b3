"""Periodic news digests from large collections of articles, as Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job, so executors need no copy of this
# package and no import path of the driver.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
