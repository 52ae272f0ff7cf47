"""Operators for text corpora: cleaning, deduplication, filtering, mixing, tokens.

Nothing else in the library imports this package. Its functions travel to the
executors by value, so that only the driver needs the package installed. What is
broadcast is made of plain values for the same reason.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
