"""Operators and the query set for preparing training text at scale."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage run inside Python workers that may not have it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
