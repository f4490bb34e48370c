"""Operators for training-data pipelines; nothing else in the package imports this folder."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with their jobs, so executors need no copy of this folder.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
