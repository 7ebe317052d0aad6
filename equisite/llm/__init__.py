"""Operators for large text corpora; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# functions that run in Python tasks travel with the plan: executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
