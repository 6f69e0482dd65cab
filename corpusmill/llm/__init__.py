"""Training-data operators (similarity joins, filters, classifiers, mixing,
sharding, archives). Nothing else in the library imports this package.

Functions that run in Python workers are shipped by value, so executors need
numpy, pandas and pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
