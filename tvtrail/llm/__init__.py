"""Operators for preparing training text; nothing else in the library imports them."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Functions of this package travel to the Python workers with the query, so executors
# need no copy of it.
register_pickle_by_value(sys.modules[__name__])
