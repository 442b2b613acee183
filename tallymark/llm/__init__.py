"""Operators of a training-data pipeline: near copies, leaks, classifiers, archives, tokens, secrets and packing.

Nothing else in the library imports this package. Functions that run in Python workers travel by value, so that
executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
