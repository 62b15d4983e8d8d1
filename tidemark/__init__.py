"""Event analytics and table upkeep on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Executors need not have this package installed: what runs in tasks is sent along.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
