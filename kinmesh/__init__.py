"""kinmesh: a Spark-native engine for entity linkage and the analytics around it.

Everything is declared with the DataFrame API.  The few Arrow functions travel
to the executors by value, so a cluster needs no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
