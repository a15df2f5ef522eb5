"""Training-data operators: secrets, quality, extraction, mixing, fingerprints, URL rules, pieces, dedup, PII.

Every operator takes DataFrames and column names and returns a DataFrame.  Only the columns an operator names are read, so
further columns of its input, whatever they are called, never clash with its working or result columns.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors with each job, so these need the libraries but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
