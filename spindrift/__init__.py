"""Clustering and cluster analysis on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# array kernels travel with the plan, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
