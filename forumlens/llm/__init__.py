"""Operators for preparing text corpora; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# The helpers that run inside tasks travel with the task: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
