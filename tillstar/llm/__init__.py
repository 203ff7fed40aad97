"""Operators for preparing training data. Nothing else in the library imports this."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the plan: executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
