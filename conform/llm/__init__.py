"""Operators of a training-data pipeline, one module each; nothing else in the library imports them.

Functions that run in Python workers travel with the plan, so executors need not have the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
