"""Training-data operators on Spark: filters, deduplication, mixing and packing.

Python functions of this package travel to the executors by value, so a job needs no
copy of the package on the worker machines.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
