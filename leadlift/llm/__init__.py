"""Operators for preparing training text; nothing else in the library imports this."""

import sys

from pyspark import cloudpickle

# Tasks carry the code of this subpackage with them, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
