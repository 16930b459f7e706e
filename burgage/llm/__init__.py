"""Operators for preparing training data; nothing else in the library imports them.

Python inside these operators runs per Arrow batch; Spark partitions, shuffles and merges.
Functions of this package travel to the executors with the job, so the package need not be
installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
