"""Training-data operators: near and exact deduplication, HTML extraction, licence scans,
quality filters, line and substring deduplication, packing and SentencePiece coding.

Nothing else in the library imports this package. Functions that run inside Spark tasks
are shipped by value, so executors need no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
