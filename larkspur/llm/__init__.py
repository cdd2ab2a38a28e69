"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage. Its functions travel to the
Python workers by value, so executors need Spark and numpy but no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
