"""Operators for large text collections. Nothing else in the package imports them.

Functions that run in Python workers travel with their tasks, so executors need
no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
