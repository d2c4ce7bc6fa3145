"""Operators for preparing training data. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions go to the executors as they are, so that these need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
