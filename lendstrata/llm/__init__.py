"""Operators that prepare training text. Nothing outside this folder imports it.

Functions of this folder travel to the executors by value, so that only the driver needs the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
