"""Operators of a training-data pipeline over ``documents`` and ``pages``. Nothing else in the library imports this package.

Functions of this package that run inside tasks are pickled by value, so executors need no copy of the package.
"""
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
