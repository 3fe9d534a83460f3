"""Operators for preparing training text, apart from the rest of the library.

Functions that run in tasks are sent by value, so executors need numpy and
pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
