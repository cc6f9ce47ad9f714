"""Operators for preparing training text, and their registered queries."""

import sys

from pyspark import cloudpickle

# Functions travel to the executors with their code, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
