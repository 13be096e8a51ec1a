"""Operators for training-data pipelines."""

from pyspark import cloudpickle as _cloudpickle
import sys as _sys

# Functions of this package travel to executors with the job, so that it does
# not have to be installed there; what it imports (requirements.txt) does.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
