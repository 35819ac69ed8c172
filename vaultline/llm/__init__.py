"""Operators of a training-data pipeline; nothing outside this folder needs it.

The functions that run in Python workers are shipped by value, so executors need no copy of
the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
