"""Operators for preparing training text, each with the query that applies it to the given tables.

Nothing else in the library imports this package.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel by value, so a cluster needs no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
