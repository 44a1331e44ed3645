"""Bulk similarity search and evaluation over vector tables, on Spark."""

import sys

from pyspark import cloudpickle

# Task code travels with the job, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
