"""Analytics over time-stamped sensor and transaction records, on Spark.

Operators take a DataFrame and return a DataFrame.  Nothing is collected, and
an operator that has to follow one channel in time order splits a channel that
is too large for one task (see ``plans``).
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions of this package travel to the executors with the job itself, so it
# need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
