"""Take-off-weight analytics as Spark jobs: DataFrame in, DataFrame out."""

import sys

from pyspark import cloudpickle

from skyload.settings import Course, Settings

__all__ = ["Course", "Settings"]

# Functions that run in tasks travel whole, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
