"""Operators for preparing training data at scale."""

from pyspark import cloudpickle

import gridtide

# worker functions travel by value: executors need no copy of the package
cloudpickle.register_pickle_by_value(gridtide)
