"""Corpus curation, chunk indexing and context retrieval as Spark jobs."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the Python workers by value, so that a cluster needs no copy
# of the package on its machines.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
