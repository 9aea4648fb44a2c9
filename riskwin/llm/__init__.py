"""Training-data operators: filtering, deduplication, mixing and storage of text.

Nothing else in the library imports this subpackage. Python code that runs in
tasks is pickled by value, so executors need the third-party packages only.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
