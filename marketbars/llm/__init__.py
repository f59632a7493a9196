"""Operators and queries for training-data pipelines."""

import sys

from pyspark import cloudpickle

# Tasks get the functions of this package themselves, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
