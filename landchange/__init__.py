"""landchange: land-change analytics on PySpark.

Functions of this package that run inside Python workers travel by value, so executors need no copy of the repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
