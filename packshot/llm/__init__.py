"""Operators for training-data pipelines: each lives in a module of its own.

Task code of this package is pickled by value, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
