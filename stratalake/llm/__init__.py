"""Operators of a training-data pipeline: search, archives, sharding, filters, joins and mixing.

Functions of these modules travel to the tasks by value, so executors need not have the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
