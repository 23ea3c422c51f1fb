"""Operators for preparing language-model training data."""

import sys

from pyspark import cloudpickle

# Functions of this package travel with the plan, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
