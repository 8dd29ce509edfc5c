"""Operators for preparing training text: dedup, filters, scores, mixing, encoding.

Functions of this subpackage that run in Python workers travel by value, so the
executors need numpy, pyarrow and the libraries named there, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
