"""sentinela: monthly surveillance and weather-station tables on Spark.

Operators, functions and sources are DataFrame -> DataFrame (or Column ->
Column) and lazy. Runners write layers and fetch a few scalars (sizes, counts,
the faults they report); the landing step stamps rows with the current time.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Python workers (UDTFs, applyInPandas) receive our functions and classes
# by value, so executors need no copy of the package on their path.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

__version__ = "0.1.0"
