"""newsrisk: daily news-event signals as Spark DataFrame jobs.

Every public operator takes and returns DataFrames (or Columns for the scalar
helpers in ``newsrisk.functions``). Sinks run jobs, and so do the operators that need an intermediate
result to be built (percentiles, heat map, model fits and what rests on them); the others are lazy.
"""

import sys

from pyspark import cloudpickle

from newsrisk.session import checkpoint_dir, get_spark

# Functions of this package travel to the Python workers whole, so that workers need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["get_spark", "checkpoint_dir"]
