"""larkspur: tabular analytics and machine learning on Spark DataFrames.

Every operator is a plain function over DataFrames (or a ``pyspark.ml`` stage).
Rows stay on the cluster; only fitted parameters, metrics and job-sized
bookkeeping ever reach the driver.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions that run in Python workers travel by value, so executors need no copy of the library.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
