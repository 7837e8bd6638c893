"""Advert analytics on Spark: pages in, listings, job codes and salary ranges out."""

import sys

from pyspark import cloudpickle

# The few Python functions travel to the executors by value, so those need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
