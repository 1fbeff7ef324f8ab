"""Operators of a training-data pipeline over documents, pages and labels.

Functions that run in Python workers are sent by value, so that executors need
not have this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
