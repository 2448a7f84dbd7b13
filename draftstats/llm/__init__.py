"""Operators of a training-data pipeline. Nothing else in the package imports them."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
