"""Training-data operators: formatting, filtering, deduplication, mixing and sharding of text corpora.

Nothing else in the library imports this subpackage.

Functions that run in Python workers are shipped with their code, so executors need Spark,
pyarrow, numpy, pandas and xxhash, but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
