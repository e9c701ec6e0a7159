"""gridloom: multi-source roster, rating and text processing on Spark DataFrames."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# functions travel to the executors by value: nothing needs to be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])
