"""Rolling-window risk statistics and training-data operators on Spark.

Python code that runs in tasks is pickled by value, so executors need no copy of
this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
