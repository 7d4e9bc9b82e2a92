"""Operators of a training-data pipeline over documents, pages and benchmark items."""

from pyspark import cloudpickle

import barloom

# Tasks get these functions by value, so executors need no copy of the package on their path.
cloudpickle.register_pickle_by_value(barloom)
