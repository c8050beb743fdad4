"""feedloom: feed ingestion, record linkage and table synchronisation on PySpark DataFrames."""

import sys

from pyspark import cloudpickle

# The few Arrow helpers travel to the executors by value, so no package has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
