"""Operators for preparing training text. Nothing else in the library imports this package.

Task functions are shipped by value, so executors need the installed libraries only.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
