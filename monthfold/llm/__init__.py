"""Operators of a training-data pipeline, each a Spark job of its own.

Functions that run inside tasks travel by value, so executors need only the
libraries they import, not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
