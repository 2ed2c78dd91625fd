"""Operators of a training-data pipeline, each a Spark job.

The functions that run inside tasks are shipped by value, so executors need
numpy, pyarrow and the hashing and tokenizer libraries, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
