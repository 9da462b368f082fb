"""quarry: DataFrame operators for follow graphs, sshd logs, HyperLogLog
sketches, nearest-neighbour search and source-tree statistics on Spark.

Every operator takes DataFrames and returns a DataFrame.  The driver only
sees parameter-sized constants (hyperplanes, bit positions), one-row
statistics, and a query matrix that passed an explicit size check before it
is broadcast.
"""

import sys

from pyspark import cloudpickle as _cloudpickle

from quarry.session import build_session, shared_dir

# Functions of this package that run inside Python workers (Arrow batch
# bodies) are pickled by value, so executors need no copy of the package on
# their path: a driver that imports quarry from anywhere can run every query.
_cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "shared_dir"]
