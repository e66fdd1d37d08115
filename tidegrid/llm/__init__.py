"""Operators for training-data preparation: one module per operator, queries in ``queries``."""

import sys

from pyspark import cloudpickle

# functions of this subpackage travel to executors by value, so executors need no copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
